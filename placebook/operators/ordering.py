"""Numbering rows in a global order, and the two export orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placebook.schema import CORE_ZONE
from placebook.session import materialise

_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Number rows 1, 2, 3, … in a global order, in parallel.

    A range-partitioned sort puts the partitions in order; each row then needs its place within its
    partition plus the sizes of the partitions before. Only those sizes, one row per partition, meet in
    one place. (A window without partitions would send every row to one task.)
    """
    placed = materialise(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col("_at"), _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + inside + 1).drop("_part", "_offset", "_at"))


def first_rows(df: DataFrame, key: list[Column], n: int, tie: str = "ord") -> DataFrame:
    """The n rows that come first by `key` (ascending, never NULL) and then by `tie` (unique), in no order.

    A limit after a sort gathers its n rows in one task, which a budget of half the table doesn't stand. Here
    the counts per key say where the cut falls, and only the ties at the cut are put in order, by `tie` alone.
    What comes out is a filter of the input: no row of it is sorted or moved. The counts, one row per
    distinct key, are the only thing that meets in one place; keys should be coarse, such as counts of reviews.
    """
    if n <= 0:
        return df.limit(0)
    place = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)])
    counts = df.groupBy(place.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
           .filter((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)).first())
    if cut is None:
        return df
    at = F.struct(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in zip(cut["_key"], counts.schema["_key"].dataType)])
    left = n - cut["_before"]
    if left == cut["_n"]:
        return df.filter(place <= at)
    last = number_rows(df.filter(place == at).select(tie), [F.col(tie)], "_nth").filter(F.col("_nth") == left).first()[tie]
    return df.filter((place < at) | ((place == at) & (F.col(tie) <= last)))


def census_order() -> list[Column]:
    """Core first, then area, group, subcategory, name; equal records keep their run order."""
    return [F.when(F.col("zone") == CORE_ZONE, 0).otherwise(1), F.col("area"), F.col("grp"), F.col("sub"),
            F.lower("name"), F.col("ord")]


def prospect_order() -> list[Column]:
    """Highest score first, then area and name."""
    return [F.coalesce("score", F.lit(0.0)).desc(), F.col("area"), F.lower("name"), F.col("ord")]
