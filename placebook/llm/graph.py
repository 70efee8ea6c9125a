"""Connected components of a table of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): the smallest id each id reaches over links (a, b); ids without links have no row.

    Large-star and small-star passes: every vertex hands its neighbours the smallest id it sees, so links
    bend towards the smallest id of their component; the number of links never grows, and rounds grow with
    the log of the diameter. Sums of a round that equal the last round's show that nothing moved.
    A vertex with very many links costs one partial minimum per task; no list of its links is built.
    """
    edges = scratch.keep(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    last = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        first = scratch.keep(large, "large")
        low = first.groupBy("a").agg(F.min("b").alias("low"))
        down = first.join(low, "a")
        small = (down.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct())
        new = scratch.keep(small, "small")
        scratch.drop(edges, first)
        edges = new
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    tops = edges.groupBy("a").agg(F.min("b").alias("component"))
    return tops.select(F.col("a").alias("id"), "component").union(
        tops.select(F.col("component").alias("id"), "component").distinct())
