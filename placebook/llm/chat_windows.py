"""Chat formatting in budgeted windows of whole turns.

Method: a turn's tokens are its words (WORD) and MARKUP for its marks. Turns stand in blocks of BLOCK turn numbers of their
conversation; prefix sums of tokens over a block choose its spans: the room that the budget leaves beside the system turn
and the history is a ruler laid along the sums, turns that lie within one of its marks are a span, a turn across a mark is one
of its own. So no span is above the room unless a single turn is. A window shows the conversation's first system turn, the
last `history` turns before its span if they fit HISTORY_TOKENS, and the span. Only the span's assistant texts are targets:
repeated ones are masked, so each is learned once. Copies of the last turn numbers of a block, and of the system turn of a
conversation of several blocks, are sent to the next ones, so a conversation of any length never meets in one task.

The template is `<|im_start|>role\\ntext<|im_end|>\\n` for each turn. Inside texts and roles `<|` becomes `<||`, so no mark can
stand there, and the way back is exact; in roles `%` and line ends become `%25` and `%0A`.

Null texts and roles are empty. Null conversations are one; null turns come first, in a block of their own; equal turns go by
role, then text, repeated rows stay. A long text is a window of its own that exceeds the budget (`tokens` tells). Any turn
numbers are good; blocks are well filled where they number turns. An empty table gives none. Columns besides the four named
are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placebook.llm.common import WORD

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY, HISTORY_TOKENS, MARKUP = 512, 2, 128, 4
BLOCK_BITS = 8
BLOCK = 1 << BLOCK_BITS


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)) + MARKUP


def _turns(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"), tokens(text).cast("long").alias("tokens"),
        F.shiftright(F.col("turn").cast("long"), BLOCK_BITS).alias("block"))


def _with_context(turns: DataFrame, history: int) -> DataFrame:
    """The turns (kind 2), and what later blocks repeat of earlier ones: system turns (0) and last turns (1)."""
    place = F.struct("block", "turn", "text", "tokens")
    first = turns.filter("role = 'system'").groupBy("conv_id").agg(F.min(place).alias("s"))
    later = turns.groupBy("conv_id", "block").agg(F.lit(1).alias("_")).drop("_")
    same = F.col("f.conv_id").eqNullSafe(F.col("l.conv_id"))
    system = (later.alias("l").join(first.alias("f"), same & (F.coalesce("l.block", F.lit(-1 << 62)) > F.coalesce("s.block", F.lit(-1 << 62))))
              .select("l.conv_id", "s.turn", F.lit("system").alias("role"), "s.text", "s.tokens", "l.block", F.lit(0).alias("kind")))
    last = (turns.filter(F.col("turn") - F.col("block") * BLOCK >= BLOCK - history)
            .select("conv_id", "turn", "role", "text", "tokens", (F.col("block") + 1).alias("block"), F.lit(1).alias("kind")))
    return turns.withColumn("kind", F.lit(2)).unionByName(system).unionByName(last)


def _render(x: Column) -> Column:
    return F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"), escape(x["text"]), F.lit(f"{END}\n"))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """rows (conv_id, turn, role, text) as windows (conv_id, block, n, formatted, repeated, targets, tokens).

    block and n order a conversation's windows; repeated: how many turns at the window's start are repeated;
    targets: (start, length) in code points of `formatted` of what is under the loss mask.
    """
    every = _with_context(_turns(rows), history)
    here = Window.partitionBy("conv_id", "block")
    order = here.orderBy("kind", "turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("kind") == 2, F.col("tokens")).otherwise(0)
    system = F.coalesce(F.max(F.when(F.col("role") == "system", F.col("tokens"))).over(here), F.lit(0))
    every = every.select("*", F.row_number().over(order).alias("at"), F.sum("tokens").over(upto).alias("sum"), F.sum(own).over(upto).alias("end"),
                         F.greatest(F.lit(budget - history_tokens) - system, F.lit(1)).alias("room"))
    mark, last_mark = F.floor((F.col("end") - F.col("tokens")) / F.col("room")), F.floor((F.col("end") - 1) / F.col("room"))
    span = F.when(F.col("kind") == 2, 2 * mark + F.when(mark == last_mark, 0).otherwise(1))
    item = F.struct("at", "role", "text", "tokens", "sum", span.alias("span"))
    blocks = (every.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(item)).alias("t"))
              .withColumn("t", F.transform("t", lambda x, i: x.withField("first", x["span"].isNotNull() & ~x["span"].eqNullSafe(F.get("t", i - 1)["span"])))))
    firsts = F.transform(F.filter("t", lambda x: x["first"]), lambda x: x["at"])
    cut = blocks.select("conv_id", "block", "t", F.posexplode(firsts).alias("n", "begin"), firsts.alias("firsts"))
    stop = F.coalesce(F.get("firsts", F.col("n") + 1), F.size("t") + 1)
    before = F.slice("t", F.lit(1), F.col("begin") - 1)
    room = F.get("t", F.col("begin") - 2)["sum"] - history_tokens
    head = F.slice(F.filter(before, lambda x: x["role"] == "system"), 1, 1)
    recent = F.filter(before, lambda x: (x["at"] >= F.col("begin") - history) & (x["sum"] - x["tokens"] >= room)
                      & ~x["at"].eqNullSafe(F.get("head", F.lit(0))["at"]))
    parts = (cut.withColumn("head", head).withColumn("old", F.concat("head", recent))
             .withColumn("new", F.slice("t", F.col("begin"), stop - F.col("begin"))))
    texts = parts.select("conv_id", "block", "n", F.size("old").alias("repeated"), F.concat("old", "new").alias("all"))
    shown = texts.withColumn("shown", F.transform("all", _render)).withColumn("lengths", F.transform("shown", F.length))
    target = F.transform("all", lambda x, i: F.when((i >= F.col("repeated")) & (x["role"] == "assistant"), F.struct(
        (F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0), lambda a, b: a + b) + len(START) + len("assistant\n")).alias("start"),
        F.length(escape(x["text"])).alias("length"))))
    return shown.select("conv_id", "block", "n", F.array_join("shown", "").alias("formatted"), "repeated", F.filter(target, F.isnotnull).alias("targets"),
                        F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a window shows."""
    shown = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda x: x != "")
    body = F.transform(shown, lambda x: F.substr(x, F.lit(len(START) + 1)))
    return F.transform(body, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substr(x, F.locate("\n", x) + 1)).alias("text")))


def masked(formatted: Column, targets: Column) -> Column:
    """The texts under the loss mask, joined."""
    return F.array_join(F.transform(targets, lambda x: unescape(F.substr(formatted, x["start"] + 1, x["length"]))), "")


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: the one place where a conversation's text meets, as its hash asks."""
    whole = formatted.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "n", "formatted", "repeated", "targets"))).alias("w"))
    turns = F.flatten(F.transform("w", lambda x: F.slice(read_back(x["formatted"]), x["repeated"] + 1, F.size(read_back(x["formatted"])))))
    loss = F.array_join(F.transform("w", lambda x: masked(x["formatted"], x["targets"])), "")
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return whole.withColumns({"turns": turns, "loss": loss}).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x["formatted"])).alias("formatted_chars"),
        F.size("w").cast("long").alias("n_windows"))
