"""Column functions: text normalisation, identities, rule values."""
