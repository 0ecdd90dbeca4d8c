"""Training-data operators: near-duplicates, search, packing, tokenising,
scans and classifiers.  Nothing else in the library imports this package."""
