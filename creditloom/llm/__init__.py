"""Training-data operators: mixing, deduplication, search, fingerprints, tokens, models."""
