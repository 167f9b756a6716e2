"""Column-level functions: parsing, exact rounding, display formatting."""
