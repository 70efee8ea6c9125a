"""Looking up a value for every row when some keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join facts to a dim that holds each key once.

    A hot key, or the rows without a key, make a large partition of the facts; adaptive execution splits
    it by size and repeats the one dim row for each part (`session.SETTINGS` switch that on). Both sides
    should come from storage or a plain projection of it, so that their shuffles feed the join directly.
    """
    return facts.join(dim, on, how)
