"""MinHash near-duplicates: one permutation, optimal densification, banded buckets, stars, then a prefix join.

Method: a document's set is its distinct 5-word shingles. One hash deals the shingles into BINS bins; a bin's
signature is its smallest hash, and an empty bin copies a filled one found by its own random probes (optimal
densification). ROWS bins make a band; documents that agree in a band share a bucket. Equal sets count as
one. In a bucket the smallest id is the hub and every member is a candidate with the hub only, so a bucket
gives fewer pairs than members. Each candidate is confirmed on the full sets: 100 * intersection >= 75 * union.

A star alone would lose a link between two members that are both unlike the hub. So the members of every bucket
whose members, without the hub, are not yet in one component are joined exactly, whatever other buckets found: sets
are ordered by their rarest shingles, and two sets that are alike enough share one in their prefixes, at places after
which enough is left in both. Only pairs of different components that pass are confirmed. So no two documents that share
a bucket and are alike stay apart. A pair at similarity 0.75 shares no bucket with a probability of
(1 - 0.75^6)^42, about 3 in 10,000; at 0.8 it is 3 in a million.

Null and empty texts have no shingles and link with nothing; a null doc_id links with nothing and is kept;
rows with the same doc_id are one vertex
(a row without shingles is still a component of its own). Very long texts are worked through in pieces. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placebook.llm.common import Scratch, batches, mix64
from placebook.llm.graph import components
from placebook.llm.shingles import shingle_sets

BINS, ROWS = 256, 6
BANDS = BINS // ROWS
PERCENT = 75
_BIN_SHIFT = np.uint64(64 - 8)
_ODD = mix64(np.arange(1, BINS + 1, dtype=np.uint64)) | np.uint64(1)


def densify(signature: np.ndarray, filled: np.ndarray) -> None:
    """Fill the empty bins of each row in place: bin i tries random bins until it meets one filled at first."""
    row, col = np.nonzero(~filled & filled.any(1, keepdims=True))
    attempt = 0
    while len(row):
        attempt += 1
        probe = (mix64(col.astype(np.uint64) * np.uint64(0x10001) + np.uint64(attempt << 32)) % np.uint64(BINS)).astype(np.int64)
        hit = filled[row, probe]
        signature[row[hit], col[hit]] = signature[row[hit], probe[hit]]
        row, col = row[~hit], col[~hit]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, BANDS) bucket keys."""
    signature, filled = np.zeros((len(sets), BINS), np.uint64), np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        if len(s):
            bins = (s >> _BIN_SHIFT).astype(np.int64)            # sorted, so a bin's first is its smallest
            first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
            signature[i, bins[first]] = s[first]
            filled[i, bins[first]] = True
    densify(signature, filled)
    used = BANDS * ROWS
    bands = (mix64(signature + _ODD) * _ODD)[:, :used].reshape(len(sets), BANDS, ROWS).sum(2, dtype=np.uint64)
    return mix64(bands + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)


def _as_lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    two = np.array([mix64(s ^ _ODD[0]).sum(dtype=np.uint64) for s in sets], np.uint64)
    return one.view(np.int64), two.view(np.int64)


def _signatures(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for part in batches(batch, "text"):
            sets = shingle_sets(part.column("text"))
            one, two = _digests(sets)
            keys = band_keys(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))],
                names=["doc_id", "n", "s1", "s2", "bands"])


def _sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for part in batches(batch, "text"):
            sets = shingle_sets(part.column("text"))
            one, two = _digests(sets)
            own = (one == part.column("s1").to_numpy()) & (two == part.column("s2").to_numpy())
            yield pa.RecordBatch.from_arrays([part.column("id"), _as_lists(sets)], names=["id", "shingles"]).filter(pa.array(own))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, kept."""
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = scratch.keep(texts.mapInArrow(_signatures, "doc_id long, n long, s1 long, s2 long, bands array<long>"), "marks")
    real = marks.filter("n > 0 and doc_id is not null")
    classes = scratch.keep(real.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands")), "classes")

    # buckets with two members or more
    buckets = classes.select("id", "n", F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("id", "n")).alias("hub")).filter("size > 1")
    heads = scratch.keep(heads.select("key", "hub"), "heads")
    members = scratch.keep(buckets.join(heads, "key"), "members")
    ids = members.select("id").distinct().join(classes.select("id", "s1", "s2"), "id")
    sets = scratch.keep(texts.withColumnRenamed("doc_id", "id").join(ids, "id").mapInArrow(_sets, "id long, shingles array<long>"), "sets")

    def fits(n, m):
        return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)

    def confirm(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - both
        return (pairs.join(right, "b").join(left, "a").filter(F.lit(100) * both >= F.lit(percent) * union).select("a", "b").distinct())

    stars = members.filter((F.col("id") > F.col("hub.id")) & fits(F.col("n"), F.col("hub.n")))
    tested = scratch.keep(stars.select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    # one doc_id may hold several texts: its classes belong together
    shared = (real.select("doc_id", "n", "s1", "s2").distinct().join(classes.select("n", "s1", "s2", "id"), ["n", "s1", "s2"])
              .groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.collect_set("id").alias("all"))
              .filter("a <> b").select("a", F.explode("all").alias("b")).filter("a <> b"))
    links = scratch.keep(confirm(tested).union(shared), "links")
    labels = scratch.keep(components(links, scratch), "labels")

    # every bucket that is still split: its members but for the hub, which has been compared with all
    rest = (members.filter(F.col("id") != F.col("hub.id")).join(labels, "id", "left")
            .select("key", "id", F.coalesce("component", "id").alias("component")))
    split = rest.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    opened = scratch.keep(rest.join(split, "key").select("id", "component").distinct(), "open")
    pairs = scratch.keep(prefix_pairs(sets.dropDuplicates(["id"]).join(opened, "id"), percent, scratch).join(tested, ["a", "b"], "left_anti"), "pairs")
    more = scratch.keep(confirm(pairs), "links")
    labels = scratch.keep(components(links.union(more), scratch), "labels")

    places = scratch.keep(classes.join(labels, "id", "left").select("n", "s1", "s2", F.coalesce("component", "id").alias("component")), "places")
    out = marks.join(places, ["n", "s1", "s2"], "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    return scratch.finish(out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                     F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "result")


def prefix_pairs(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """sets (id, shingles, component) -> (a, b), a < b: all pairs of different components that can be alike, some that aren't.

    Shingles are ordered by how many sets hold them. If two sets of n and m are alike, they share
    at least percent * (n + m) / (100 + percent); so their first shared shingle stands where as many are left in both.
    """
    n = F.size("shingles").cast("long")
    each = sets.select("id", "component", n.alias("n"), F.explode("shingles").alias("shingle"))
    often = scratch.keep(each.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1"), "often")
    # those of one set only come first and are shared by none: their number is enough
    order = Window.partitionBy("id").orderBy("often", "shingle")
    placed = each.join(often, "shingle").withColumn("behind", F.count("*").over(Window.partitionBy("id")) - F.row_number().over(order))
    prefix = placed.filter(F.lit(100) * (F.col("behind") + 1) >= F.lit(percent) * F.col("n"))
    prefix = scratch.keep(prefix.select("shingle", "id", "component", "n", "behind"), "prefix")
    left, right = prefix.alias("x"), prefix.alias("y")
    most = F.least("x.behind", "y.behind") + 1
    return (left.join(right, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.id") < F.col("y.id"))
                      & (F.col("x.component") != F.col("y.component"))
                      & (F.lit(100 + percent) * most >= F.lit(percent) * (F.col("x.n") + F.col("y.n"))))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
