"""Operators that prepare training text: packing, fingerprints, near-duplicates, scans and classifiers."""
