"""Training-data operators: deduplication, scans, fingerprints, archives, models, tokens, mixing."""
