"""Whole jobs: the census, the prospect list, and their combination."""
