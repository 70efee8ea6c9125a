"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placebook.session import materialise

# widths of the intervals in which the middle is sought, for values such as degrees; each interval
# splits into at most a thousand of the next, and the first level has a few thousand
WIDTHS = (0.1, 1e-4, 1e-7)


def medians(values: DataFrame, key: str, value: str, widths: tuple[float, ...] = WIDTHS) -> DataFrame:
    """The median of `value` per `key`, the mean of the two middle ones for an even count: key, n, median.

    Keys may each hold any share of the rows; `values` should be stored. Rows are counted by ever narrower
    intervals, and only those of the interval that holds the middle go on; they are never gathered.
    """
    sizes = materialise(values.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "sizes")
    middle = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    ranks = sizes.select(key, F.explode(middle).alias("rank")).withColumn("side", F.col("rank"))
    rows = values.select(key, F.col(value).alias("v"))
    for width in widths:
        rows = rows.withColumn("cell", F.floor(F.col("v") / width))
        found = materialise(_locate(rows, ranks, key), "ranks")
        # a row in the cell of both middle ranks goes on once for each
        on = [c for c in (key, "cell", "side") if c in rows.columns]
        rows = rows.join(found.select(key, "cell", "side"), on).drop("cell")
        ranks = found.drop("cell")
    last = _locate(rows.withColumn("cell", F.col("v")), ranks, key)
    return last.groupBy(key).agg(F.avg("cell").alias("median")).join(sizes, key)


def _locate(rows: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """Replace each wanted rank by the cell that holds it and the rank within that cell."""
    on = [key, "side"] if "side" in rows.columns else [key]
    counts = rows.groupBy(*on, "cell").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy(*on).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("lower", F.coalesce(F.sum("c").over(before), F.lit(0)))
    return (counts.join(ranks, on)
            .filter((F.col("lower") <= F.col("rank")) & (F.col("rank") < F.col("lower") + F.col("c")))
            .select(key, "side", "cell", (F.col("rank") - F.col("lower")).alias("rank")))
