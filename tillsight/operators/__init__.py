"""DataFrame -> DataFrame operators: typing, cleaning, quality, result tables."""
