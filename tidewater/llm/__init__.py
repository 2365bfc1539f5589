"""Training-data operators: mixing, PII, language ID, secrets, chat formatting, packing,
near-duplicates, page extraction, fingerprints and nearest neighbours.

Nothing else in the library imports this subpackage.
"""
