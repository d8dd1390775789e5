"""Training-data operators: extraction, quality, dedup, secrets, tokenising, packing.

Self-contained: nothing else in the library imports this package.
"""
