"""Mixing sources to target weights along a time-varying curriculum.

Method: each source has a weight schedule over training time 0 to 1 (linear from `start` to `end`). Its
integral is the share of the source's demand that is due by a time; inverting the integral at a document's
place in the cumulative demand gives the time at which the document is trained on. The mix is the documents
range-sorted by that position.

Targets: sources share `budget` times all sizes by weight; a target stops at `cap` times its source's size
and the excess is shared again by weight until none is above. Documents are taken whole, in a hashed order:
as many passes over the source as fit its target, then those documents whose middle lies below the rest, so
a source misses its target by half a document at most.

Nulls and empty texts have size 0 and are placed but add no words; a null source is a source of its own,
last; repeated rows are documents of their own; an empty table gives an empty mix. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placebook.llm.common import WORD, Scratch, fresh
from placebook.operators.ordering import number_rows

WEIGHTS = (3.0, 1.0, 2.0)
#: Start and end of each weight's schedule, as a factor of the weight: heavy sources early, middling ones late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BLOCK_ROWS = 20_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, cap: float = 2.0, name: str = "") -> DataFrame:
    """(source, size) -> source, source_size, documents, weight, slot, target. Sources are a table, not a list."""
    scratch = Scratch(sizes.sparkSession, "mix")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    ranked = number_rows(per, [F.col("source").asc_nulls_last()], "rank")
    slot = ((F.col("rank") - 1) % len(weights)).cast("int")
    at = scratch.keep(ranked.select(
        "source", "source_size", "documents", slot.alias("slot"),
        F.array(*map(F.lit, weights))[slot].alias("weight"), F.lit(False).alias("full")), "targets")
    total = at.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:                                       # each round fills one more source at least
        full, open_weight = at.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))), F.lit(0)),
                                   F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0.0))).first()
        left = max(budget * total - cap * full, 0.0)
        share = F.col("weight") * F.lit(left / open_weight if open_weight else 0.0)
        over = ~F.col("full") & (share > F.col("source_size") * cap)
        target = F.when(F.col("full") | over, F.col("source_size") * F.lit(cap)).otherwise(share)
        new = scratch.keep(at.drop("target").withColumns({"target": target, "full": F.col("full") | over, "newly": over}), "targets")
        more = new.filter("newly").limit(1).count()
        scratch.drop(at)
        at = new.drop("newly")
        if not more:
            return at.drop("full")


def due(share: Column, start: Column, end: Column) -> Column:
    """The time by which `share` (0 to 1) of a demand with a weight going linearly from start to end is due."""
    slope, area = end - start, (start + end) / 2
    return F.when(slope == 0, share).otherwise(
        (F.sqrt(F.greatest(start * start + 2 * slope * share * area, F.lit(0.0))) - start) / slope)


def plan(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, budget: float = 1.5, cap: float = 2.0) -> tuple[DataFrame, str]:
    """The rows with one more column, whose name is returned: struct(size, source_size, target, copies, taken, positions)."""
    size, col = fresh(docs, "_size"), fresh(docs, "_mix")
    at, block, below, u = (fresh(docs, x) for x in ("_at", "_block", "_below", "_u"))
    narrow = docs.select("source", words_in(F.col("text")).alias("size"))
    targets = source_targets(narrow, weights, budget, cap)
    targets = targets.select(F.col("source").alias(at), F.struct(
        "source_size", "target", "documents",
        F.array(*[F.lit(a) for a, _ in schedules])[F.col("slot")].alias("start"),
        F.array(*[F.lit(b) for _, b in schedules])[F.col("slot")].alias("end")).alias(col))
    # a place in [0, 1) by hash cuts every source into blocks of some BLOCK_ROWS documents
    place = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("mix")), 11)) / F.lit(float(1 << 53))
    rows = (docs.withColumns({size: words_in(F.col("text")), u: place})
            .join(targets, docs["source"].eqNullSafe(targets[at])).drop(at)
            .withColumn(block, F.floor(F.col(u) * F.ceil(F.col(f"{col}.documents") / BLOCK_ROWS))))
    blocks = rows.groupBy("source", block).agg(F.sum(size).alias("s"))
    before = Window.partitionBy("source").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(F.col("source").alias(at), F.col(block).alias("b"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias(below))
    starts = Scratch(docs.sparkSession, "mix").keep(starts, "blocks")
    rows = (rows.join(starts, rows["source"].eqNullSafe(starts[at]) & (rows[block] == starts["b"])).drop(at, "b"))
    order = Window.partitionBy("source", block).orderBy(u, "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    mid = F.col(below) + F.sum(size).over(order) - F.col(size) / 2
    rows = rows.withColumn(below, mid)
    s, target, have = F.col(size), F.col(f"{col}.target"), F.col(f"{col}.source_size")
    passes = F.when(have > 0, F.floor(target / have)).otherwise(0)
    copies = (passes + F.when(F.col(below) < target - passes * have, 1).otherwise(0)).cast("int")
    positions = F.transform(F.sequence(F.lit(1), copies), lambda k: due(
        F.least(((k - 1) * have + F.col(below)) / target, F.lit(1.0)), F.col(f"{col}.start"), F.col(f"{col}.end")))
    out = rows.withColumn(col, F.struct(
        s.alias("size"), have.alias("source_size"), target.alias("target"), copies.alias("copies"),
        (s * copies).alias("taken"),
        F.when((copies > 0) & (target > 0), positions).otherwise(F.array().cast("array<double>")).alias("positions")))
    return out.drop(size, u, block, below), col


def mix(docs: DataFrame, number: str | None = None, **how) -> DataFrame:
    """The training order: documents as often as they are taken, range-sorted by position; columns as given, and if
    `number` names one more, their places 1, 2, 3, ... in that order."""
    rows, col = plan(docs, **how)
    at = fresh(rows, "_position")
    rows = rows.withColumn(at, F.explode(f"{col}.positions"))
    if number is None:
        return rows.orderBy(at, "doc_id").select(*docs.columns)
    return number_rows(rows.select(*docs.columns, at), [F.col(at), F.col("doc_id")], number).select(*docs.columns, number)


def schedule(docs: DataFrame, **how) -> tuple[DataFrame, str, str]:
    """The rows of `plan` without their texts, with one more column: the places (1, 2, 3, ...) that the mix has for each row.

    Only a row's number and position are sorted. Rows that share position and id go by size; what is alike in all of that is
    interchangeable. Returned are the rows, the name of the plan's struct and that of the places.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows, col = plan(docs, **how)
    row, at, places = (fresh(rows, x) for x in ("_row", "_position", "_places"))
    rows = scratch.keep(rows.drop("text").withColumn(row, F.monotonically_increasing_id()), "planned")
    taken = rows.select(row, "doc_id", F.col(f"{col}.size").alias("size"), F.col(f"{col}.source_size").alias("source_size"),
                        F.explode(f"{col}.positions").alias(at))
    order = number_rows(taken, [F.col(at), F.col("doc_id"), F.col("size"), F.col("source_size")], "place")
    found = order.groupBy(row).agg(F.array_sort(F.collect_list("place")).alias(places))
    out = rows.join(found, row, "left").withColumn(places, F.coalesce(places, F.array().cast("array<bigint>")))
    return out.drop(row), col, places
