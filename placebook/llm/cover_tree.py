"""Embedding near-duplicates: exact pairs over a cosine threshold by dual traversal of cover trees.

Method: on the unit sphere a cosine of t is a distance of sqrt(2 - 2t). A cover tree nests levels with halving
radii: each node's points lie within its radius, its children cover them at half of it. Two trees are walked
together from their roots; a pair of nodes is dropped when the distance of the centres exceeds both covering
radii plus the threshold distance, else the wider node is opened. Leaf pairs are compared in double precision.

The top of the trees is laid over the cluster: a bounded sample of vectors (PIVOTS, MAX_PIVOTS) gives a net
per label; all vectors go to their nearest net point, cells know their real radius, and cells too far apart
never meet. Cells larger than BLOCK_ROWS are cut into blocks. A label without pivots is a cell without a
bound. The sample decides only which blocks meet, never which pairs are found.

Equal vectors of a label count as one with a weight, so copies cost nothing; a task returns, per vector, its
number of links and its links to local smallest members only, never all pairs.

Null labels, null or zero vectors and those with null or non-finite components link with nothing; a null
vec_id is returned, links with nothing and is kept; rows with the same vec_id are one vertex each time it
occurs in a group of equal vectors; vectors of different lengths don't link. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.llm.common import Scratch, bounded_sample
from placebook.llm.graph import components

PIVOTS, MAX_PIVOTS = 64, 2048
BLOCK_ROWS, LEAF, FAN = 2048, 24, 512
SLACK = 1e-7


class CoverTree:
    """Nested levels over unit vectors: centre, real covering radius, children or the points of a leaf."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre, self.radius, self.children, self.points = [], [], [], []
        at = np.arange(len(x))
        far = np.sqrt(np.maximum(2 - 2 * x @ x[0], 0))
        self._add(0, at, far, float(far.max()))

    def _add(self, centre: int, at: np.ndarray, far: np.ndarray, level: float) -> int:
        me = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.children.append([])
        self.points.append(at)
        if len(at) <= LEAF or self.radius[me] == 0.0:
            return me
        while level / 2 > self.radius[me]:
            level /= 2
        left, parts, half = np.arange(len(at)), [], level / 2
        rest = self.x[at]
        own = int(np.flatnonzero(at == centre)[0])
        while len(left):                                        # a net at half the radius; the centre goes first
            first = own if not parts else left[0]
            d = np.sqrt(np.maximum(2 - 2 * (rest[left] @ rest[first]), 0))
            d[left == first] = 0.0
            if len(parts) == FAN:                               # a wide net: the others form one more node of this level
                parts.append((first, left, d, level))
                break
            near = d <= half
            parts.append((first, left[near], d[near], half))
            left = left[~near]
        for first, members, d, of in parts:
            self.children[me].append(self._add(int(at[first]), at[members], d, of))
        return me


def pairs_within(a: CoverTree, b: CoverTree, distance: float, same: bool):
    """Pairs of leaves (node of a, node of b) that may hold points within the distance."""
    reach = distance + SLACK
    xa, xb = a.x[np.array(a.centre)], b.x[np.array(b.centre)]
    ra, rb = np.array(a.radius), np.array(b.radius)
    todo = [(0, 0)]
    while todo:
        p, q = todo.pop()
        down_a, down_b = a.children[p], b.children[q]
        if not down_a and not down_b:
            yield p, q
            continue
        twin = same and p == q
        open_a = bool(down_a) and (twin or not down_b or ra[p] >= rb[q])
        open_b = bool(down_b) and (twin or not open_a)
        na, nb = np.array(down_a if open_a else [p]), np.array(down_b if open_b else [q])
        d = np.sqrt(np.maximum(2 - 2 * xa[na] @ xb[nb].T, 0))
        near = d <= ra[na][:, None] + rb[nb][None, :] + reach
        i, j = np.nonzero(np.triu(near) if twin else near)
        todo += zip(na[i].tolist(), nb[j].tolist(), strict=True)


def _block(left: pd.DataFrame, right: pd.DataFrame, same: bool, cosine: float) -> pd.DataFrame:
    """Links of two blocks of distinct vectors: (id, links, other): other is one linked id, or the id itself."""
    xs, roots, weights, ids = [], [], [], []
    for side in (left, right):
        x = np.array(side["x"].tolist(), np.float64)
        xs.append(x)
        roots.append(np.sqrt((x * x).sum(1)))
        weights.append(side["copies"].to_numpy(np.int64))
        ids.append(side["id"].to_numpy(np.int64))
    trees = [CoverTree(x / n[:, None]) for x, n in zip(xs[:1] if same else xs, roots, strict=False)]
    trees = trees * 2 if same else trees
    count = [np.zeros(len(i), np.int64) for i in ids]
    parent = np.arange(len(ids[0]) + (0 if same else len(ids[1])))
    shift = 0 if same else len(ids[0])

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    distance = math.sqrt(max(2 - 2 * cosine, 0))
    for p, q in pairs_within(trees[0], trees[1], distance, same):
        i, j = trees[0].points[p], trees[1].points[q]
        close = (xs[0][i] @ xs[1][j].T) / (roots[0][i][:, None] * roots[1][j][None, :]) >= cosine
        if same and p == q:
            close &= i[:, None] < j[None, :]
        count[0][i] += close @ weights[1][j]
        if same:
            count[0][j] += weights[0][i] @ close
        else:
            count[1][j] += weights[0][i] @ close
        for s, t in zip(*np.nonzero(close), strict=True):
            u, v = top(int(i[s])), top(int(j[t]) + shift)
            parent[max(u, v)] = min(u, v)
    every = ids[0] if same else np.concatenate(ids)
    links = count[0] if same else np.concatenate(count)
    roots_of = np.array([top(i) for i in range(len(parent))], np.int64)
    out = pd.DataFrame({"id": every, "links": links, "other": every[roots_of]})
    return out[(out["links"] > 0)]


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "cover")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("x"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0)
              & F.forall("x", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))
              & F.exists("x", lambda y: y != 0))
    good = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are one value
    good = scratch.keep(good.withColumn("x", F.when(F.col("ok"), F.transform("x", lambda y: y + F.lit(0.0)))), "rows")
    # a width of its own is a group of its own: vectors of different lengths never meet
    classes = (good.filter("ok").withColumn("part", F.concat_ws("|", F.size("x"), "label"))
               .groupBy("part", "x").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    classes = scratch.keep(classes, "classes")

    # the top of the trees: a net of sampled points per label
    sample = bounded_sample(classes.select("id", "part", "x"), "id", MAX_PIVOTS).collect()
    total = classes.count()
    share = Counter(r["part"] for r in sample)
    nets: dict[str, list] = {}
    for r in sample:                                             # as many points as the label fills blocks
        net = nets.setdefault(r["part"], [])
        if len(net) < min(PIVOTS, math.ceil(share[r["part"]] / len(sample) * total / BLOCK_ROWS)):
            net.append(r["x"])
    names = {part: n for n, part in enumerate(nets)}
    unit = {}
    for part, net in nets.items():
        x = np.array(net, np.float64)
        unit[part] = x / np.sqrt((x * x).sum(1))[:, None]

    def assign(stream):
        for pdf in stream:
            cell, far = np.full(len(pdf), -1, np.int64), np.full(len(pdf), 2.0)
            for part, at in pdf.groupby("part").indices.items():
                if part in unit:
                    x = np.array(pdf["x"].iloc[at].tolist(), np.float64)
                    d = 2 - 2 * (x / np.sqrt((x * x).sum(1))[:, None]) @ unit[part].T
                    best = d.argmin(1)
                    cell[at] = names[part] * PIVOTS + best
                    far[at] = np.sqrt(np.maximum(d[np.arange(len(at)), best], 0))
            pdf["cell"], pdf["far"] = cell, far
            yield pdf

    placed = classes.mapInPandas(assign, "part string, x array<double>, id long, copies long, cell long, far double")
    placed = scratch.keep(placed, "cells")
    cells = placed.groupBy("part", "cell").agg(F.max("far").alias("radius"), F.count("*").alias("n"))
    cells = scratch.keep(cells.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")), "sizes")

    # which cells may hold links: at most PIVOTS^2 pairs a label, from the sampled net
    reach = math.sqrt(max(2 - 2 * cosine, 0)) + 2 * SLACK
    near = []
    for part, net in unit.items():
        d = np.sqrt(np.maximum(2 - 2 * net @ net.T, 0))
        near += [(names[part] * PIVOTS + i, names[part] * PIVOTS + j, float(d[i, j])) for i in range(len(net)) for j in range(i, len(net))]
    near_df = spark.createDataFrame(near or [(-2, -2, 0.0)], "c long, e long, d double")
    one = cells.select(F.col("part"), F.col("cell").alias("c"), F.col("radius").alias("r"), F.col("blocks").alias("kb"))
    two = cells.select(F.col("part").alias("part2"), F.col("cell").alias("e"), F.col("radius").alias("s"), F.col("blocks").alias("lb"))
    met = one.join(near_df, "c").join(two, "e").filter(F.col("d") <= F.col("r") + F.col("s") + F.lit(reach))
    alone = cells.filter("cell = -1").select("part", F.col("cell").alias("c"), F.col("cell").alias("e"), F.col("blocks").alias("kb"), F.col("blocks").alias("lb"))
    met = met.select("part", "c", "e", "kb", "lb").union(alone)
    tasks = met.select("part", "c", "e", F.explode(F.sequence(F.lit(0), F.col("kb") - 1)).alias("k"), "lb").select(
        "part", "c", "e", "k", F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("l"))
    tasks = tasks.filter("c <> e or k <= l").withColumn("task", F.xxhash64("part", "c", "k", "e", "l"))
    tasks = scratch.keep(tasks, "tasks")
    blocked = placed.join(cells.select("part", "cell", "blocks"), ["part", "cell"]).select(
        "part", "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("k"), "id", "copies", "x")
    left = blocked.join(tasks.select("part", F.col("c").alias("cell"), "k", "task", ((F.col("c") == F.col("e")) & (F.col("k") == F.col("l"))).alias("same")), ["part", "cell", "k"])
    right = blocked.join(tasks.filter("c <> e or k <> l").select("part", F.col("e").alias("cell"), F.col("l").alias("k"), "task"), ["part", "cell", "k"])

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) and bool(a["same"].iloc[0]):
            return _block(a, a, True, cosine)
        if len(a) and len(b):
            return _block(a, b.rename(columns=lambda c: c.removeprefix("_")), False, cosine)
        return pd.DataFrame({"id": [], "links": [], "other": []}).astype("int64")

    found = (left.select("task", "id", "copies", "x", "same").groupBy("task")
             .cogroup(right.select(*[F.col(c).alias(f"_{c}") for c in ("task", "id", "copies", "x")]).groupBy("_task"))
             .applyInPandas(compare, "id long, links long, other long"))
    found = scratch.keep(found, "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    # a vec_id in several groups of equal vectors ties them together
    members = good.filter("ok").withColumn("part", F.concat_ws("|", F.size("x"), "label")).join(classes, ["part", "x"])
    members = scratch.keep(members.select("vec_id", "id", "copies"), "members")
    shared = members.groupBy("vec_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b")
    shared = members.join(shared.select("vec_id", "a"), "vec_id").select("a", F.col("id").alias("b"))
    labels = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")).union(shared), scratch)
    out = (members.join(counts, "id", "left").join(labels, "id", "left")
           .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    rest = good.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    return scratch.finish(out, "result")
