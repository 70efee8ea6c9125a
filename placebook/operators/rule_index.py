"""Classification with rule tables of any size: every distinct text meets only the keys that may be in it.

The same results as `functions.rules.classify_records`, which tries the keys one after another inside an expression. Here
the texts that decide (label and name, the tagline of a listing without a category, label and name alone for the
flat category) are gathered, made distinct and held against an inverted index of the keys (`key_index`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.rules import early_category, legacy_text, retries, rule_text, unclassified
from placebook.functions.text import blank
from placebook.operators.key_index import first_match
from placebook.operators.skew import lookup
from placebook.schema import UNCLASSIFIED_GROUP, UNCLASSIFIED_SUB
from placebook.session import materialise


def _hits(records: DataFrame, texts: list[Column], rules: DataFrame, order: str) -> DataFrame:
    """text beside the columns of the first rule whose key it holds."""
    asked = records.select(F.explode(F.array_compact(F.array(*texts))).alias("text")).distinct()
    found = first_match(materialise(asked, "rule-texts"), rules, order)
    return found.join(rules, order).drop(order)


def classify_records(records: DataFrame, rules: DataFrame, legacy: DataFrame) -> DataFrame:
    """Fill grp, sub and, where empty, legacy18.

    rules (rule_ord, grp, sub, key) and legacy (legacy_ord, category, key), in order of precedence.
    """
    keys = rules.select("rule_ord", F.col("grp").alias("g"), F.col("sub").alias("s"), F.lower("key").alias("key"))
    flat = legacy.select("legacy_ord", "category", F.regexp_replace("key", r"(?U)^\s+|\s+$", "").alias("key")).filter("key <> ''")
    named = {"_first": rule_text("label", "name"),
             "_again": F.when(retries(), rule_text(F.substring("notes", 1, 160), "name")),
             "_label": F.when(blank("legacy18"), legacy_text("label")), "_name": F.when(blank("legacy18"), legacy_text("name"))}
    rows = materialise(records.withColumns(named), "rule-rows")
    hits = _hits(rows, [F.col("_first"), F.col("_again")], keys, "rule_ord").select("text", F.struct("g", "s").alias("hit"))
    flat_hits = _hits(rows, [F.col("_label"), F.col("_name")], flat, "legacy_ord").select("text", F.col("category").alias("hit"))
    out = rows
    for column, found in (("_first", hits), ("_again", hits), ("_label", flat_hits), ("_name", flat_hits)):
        out = lookup(out, found.select(F.col("text").alias(column), F.col("hit").alias(f"{column}_hit")), [column])
    open_ = F.col("_first_hit").isNull() | unclassified(F.col("_first_hit.g"), F.col("_first_hit.s"))
    hit = F.when(open_, F.coalesce("_again_hit", "_first_hit")).otherwise(F.col("_first_hit"))
    category = F.coalesce(early_category("label", "name"), "_label_hit", "_name_hit", F.lit(""))
    return out.withColumns({
        "grp": F.coalesce(hit["g"], F.lit(UNCLASSIFIED_GROUP)), "sub": F.coalesce(hit["s"], F.lit(UNCLASSIFIED_SUB)),
        "legacy18": F.when(blank("legacy18"), category).otherwise(F.col("legacy18"))}).select(
        *dict.fromkeys([*records.columns, "grp", "sub", "legacy18"]))
