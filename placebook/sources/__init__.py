"""Source mappers: raw rows of one source in, canonical records out."""
