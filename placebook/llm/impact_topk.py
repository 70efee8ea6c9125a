"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Method: components become integers; a block of vectors is indexed by posting segments (impact band,
dimension), each holding the vectors whose component lies in the band. Segments are taken by descending
impact, for all queries of a block at once; every posting adds query weight times impact to its vector's
score. After each band, what is left of a vector can change a score by no more than a bound (the band's
lower edge times the query's absolute sum, or the two residual norms' product). A query stops only when the
bound proves that no vector outside its possible members can reach its k-th score; possible members are
scored again in full with integers.

Spark deals blocks of vectors against blocks of queries and merges the k best per block, so a task holds one
block of each whatever the table's size. Work is queries times vectors, which exact search over a stated
query set needs in the worst case; the bound is what saves work inside a block.

Vectors that are null, empty, or hold null or non-finite components take no part. Every row counts by itself, also such
as share a vec_id, which is its label only; a row is no candidate of its own query. Shorter vectors are filled up with zeros.
Components of any finite size are taken as they are: bounds allow for the rounding of sums, and scores that could
leave 63 bits are worked out in unbounded integers (one beyond a long is reported as the nearest long and
ordered by its double). Rows with a
null vec_id take no part. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from fractions import Fraction
from math import floor
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placebook.llm.common import Scratch

INDEX_ROWS, QUERY_ROWS = 4096, 512
#: Lower edges of the impact bands, highest first.
BANDS = [1 << b for b in range(20, 3, -1)] + [0]
#: Sums of products below this are exact in doubles, those below 2^62 in long integers.
EXACT = float(1 << 52)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def bounded(raw: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x), held where products of it stay finite, and the rows' absolute sums: unbounded where something was held."""
    with np.errstate(over="ignore"):
        x = np.floor(raw * scale)
    total = np.abs(x).sum(1) + 1.0
    total[(np.abs(x) > 1e120).any(1)] = np.inf
    return np.clip(x, -1e120, 1e120), total


def products(x: np.ndarray, q: np.ndarray, scale: float) -> list[int]:
    """Exact inner products of floor(scale * x) rows with floor(scale * q)."""
    with np.errstate(over="ignore"):
        a, b = np.floor(x * scale), np.floor(q * scale)
        most = max(np.abs(a).max(initial=0.0), 1.0) * max(np.abs(b).max(initial=0.0), 1.0) * max(x.shape[1], 1)
    if most < float(1 << 62):
        return (a.astype(np.int64) @ b.astype(np.int64)).tolist()
    whole = lambda row: [floor(Fraction(v) * Fraction(scale)) for v in row.tolist()]
    right = whole(q)
    return [sum(map(mul, whole(row), right)) for row in x]


def long_and_double(score: int) -> tuple[int, float]:
    """The nearest long, and a double to order scores beyond that by."""
    wide = float(score) if abs(score) < 1 << 1023 else float("inf") if score > 0 else -float("inf")
    return min(max(score, -(1 << 63)), (1 << 63) - 1), wide


class Index:
    """Posting segments of one block of vectors."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, raw: np.ndarray, scale: float):
        self.rows, self.ids, self.raw, self.scale = rows, ids, raw, scale
        x, self.size = bounded(raw, scale)
        size = np.abs(x)
        self.rounding = 1e-15 * (x.shape[1] + 2)
        self.bands = []
        high = np.inf
        rest = x.copy()
        for low in BANDS:
            inside = (size >= max(low, 1)) & (size < high)
            high = max(low, 1)
            if inside.any():
                rest = np.where(inside, 0.0, rest)
                dims = [(d, at, x[at, d]) for d in range(x.shape[1]) if len(at := np.flatnonzero(inside[:, d]))]
                self.bands.append((high, dims, np.sqrt((rest * rest).sum(1))))

    def search(self, qrows: np.ndarray, qids: np.ndarray, raw: np.ndarray, k: int) -> list[tuple[int, int, int, int, float]]:
        """The k best (query's row, query, vector, score, score as a double) of this block for each query; fewer if the block has fewer."""
        found, todo = [], np.arange(len(raw))
        weights, total = bounded(raw, self.scale)
        norm = np.sqrt((weights * weights).sum(1))
        score = np.zeros((len(self.raw), len(raw)))
        own = self.rows[:, None] == qrows[None, :]
        bands = self.bands or [(0, [], np.zeros(len(self.raw)))]
        for n, (low, dims, rest) in enumerate(bands):
            for d, at, impact in dims:
                score[at] += impact[:, None] * weights[:, d]
            last = n == len(bands) - 1
            # what unread postings can still change, and what sums may have lost by rounding
            slack = np.minimum(total[None, :] * max(low - 1, 0), norm[None, :] * rest[:, None]) * (1 + 1e-12) if not last else 0.0
            reach = total[None, :] * self.size[:, None]
            slack = slack + np.where(reach < EXACT, 0.0, reach * self.rounding)
            least = np.where(own, -np.inf, score - slack)
            keep = min(k, len(self.raw))
            kth = -np.partition(-least, keep - 1, axis=0)[keep - 1]
            possible = (score + slack >= kth[None, :]) & ~own
            done = (possible.sum(0) <= 4 * k) | last
            if done.any():
                for j in np.flatnonzero(done):
                    at = np.flatnonzero(possible[:, j])
                    exact = products(self.raw[at], raw[j], self.scale)
                    best = sorted(zip((-e for e in exact), self.ids[at].tolist(), strict=True))[:k]
                    found += [(int(qrows[j]), int(qids[j]), v, *long_and_double(-e)) for e, v in best]
                left = ~done
                todo, weights, raw, qids, qrows = todo[left], weights[left], raw[left], qids[left], qrows[left]
                total, norm, score, own = total[left], norm[left], score[:, left], own[:, left]
                if not len(todo):
                    break
        return found


def matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
          index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """vectors (vec_id, embedding) -> query_id, rank, vec_id, score: each query row's k highest, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = scratch.keep(rows, "vectors")                       # written, so a row keeps its number
    n, n_query = rows.agg(F.count("*"), F.count_if("is_query")).first()
    n_blocks, q_blocks = max(1, -(-n // index_rows)), max(1, -(-n_query // query_rows))
    block = lambda count, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")
    index = rows.select(block(n_blocks, "v").alias("vb"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"), "row", "vec_id", "x")
    queries = rows.filter("is_query").select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("vb"), block(q_blocks, "q").alias("qb"), "row", "vec_id", "x")

    def search(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(v) and len(q):
            width = max(v["x"].map(len).max(), q["x"].map(len).max())
            number = lambda t, c: t[c].to_numpy(np.int64)
            index = Index(number(v, "row"), number(v, "vec_id"), matrix(v["x"].tolist(), width), scale)
            found = index.search(number(q, "row"), number(q, "vec_id"), matrix(q["x"].tolist(), width), k)
        return pd.DataFrame(found, columns=["row", "query_id", "vec_id", "score", "wide"]).astype(
            {"row": "int64", "query_id": "int64", "vec_id": "int64", "score": "int64", "wide": "float64"})

    best = (index.groupBy("vb", "qb").cogroup(queries.groupBy("vb", "qb"))
            .applyInPandas(search, "row long, query_id long, vec_id long, score long, wide double"))
    order = Window.partitionBy("row").orderBy(F.col("wide").desc(), F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
