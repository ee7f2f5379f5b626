"""Training-data operators: near-duplicates, scoring, mixing, sharding, token files."""
