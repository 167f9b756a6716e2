"""Training-data operators: dedup, sharding, mixing, quality, PII, search, language id, decontamination."""
