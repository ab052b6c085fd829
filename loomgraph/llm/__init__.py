"""Training-data operators: tokenising, packing, fingerprints, near duplicates, scoring, extraction."""
