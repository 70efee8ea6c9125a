"""Operators for building training corpora at scale: filters, near-duplicates, mixing, packing, search."""
