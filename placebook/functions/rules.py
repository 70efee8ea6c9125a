"""Ordered keyword rules: the first rule with a key inside the text decides."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.provenance import source_kind
from placebook.functions.text import blank, column, let
from placebook.schema import UNCLASSIFIED_GROUP, UNCLASSIFIED_SUB
from placebook.taxonomy import LEGACY_FIRST, Taxonomy


def _literal(rows: list[dict], ddl: str) -> Column:
    """A constant array of structs; folded once into the plan, whatever its length."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<{ddl}>")


# rules are tried in blocks, so that a text that meets an early rule is not held against all of them
BLOCK = 50


def first_hit(text: Column, rows: list[dict], ddl: str) -> Column:
    """The first rule whose key `k` occurs in the text; NULL if none does."""
    def look(t: Column) -> Column:
        blocks = [_literal(rows[i:i + BLOCK], ddl) for i in range(0, len(rows), BLOCK)]
        return F.coalesce(*[F.get(F.filter(b, lambda r: F.contains(t, r["k"])), F.lit(0)) for b in blocks])
    return let(text, look)


def rule_text(label: Column | str, name: Column | str) -> Column:
    """' label name ', in which keys are looked for: slashes count as blanks, runs of blanks as one."""
    text = F.concat_ws(" ", F.coalesce(column(label), F.lit("")), F.coalesce(column(name), F.lit("")))
    # most texts have single plain blanks only: a search in classes of Unicode costs as much as all keys
    spaced = let(F.replace(F.lower(text), F.lit("/"), F.lit(" ")), lambda t: F.when(
        t.rlike("  |[^ -~]"), F.regexp_replace(t, r"(?U)\s+", " ")).otherwise(t))
    return F.concat(F.lit(" "), spaced, F.lit(" "))


def classify(label: Column | str, name: Column | str, taxonomy: Taxonomy) -> Column:
    """struct(grp, sub, key) of the first rule whose key occurs in ' label name '.

    Keys are substrings and are not trimmed, so a key may ask for a word end ('park ').
    """
    hit = first_hit(rule_text(label, name), [{"g": g, "s": s, "k": k.lower()} for g, s, k in taxonomy.rules],
                    "struct<g:string,s:string,k:string>")
    nothing = F.struct(F.lit(UNCLASSIFIED_GROUP).alias("g"), F.lit(UNCLASSIFIED_SUB).alias("s"), F.lit("").alias("k"))
    return F.coalesce(hit, nothing).cast("struct<grp:string,sub:string,key:string>")


def legacy_text(text: Column | str) -> Column:
    """The text in which keys of the flat category are looked for."""
    return F.concat(F.lit(" "), F.translate(F.lower(F.coalesce(column(text), F.lit(""))), "/-", "  "), F.lit(" "))


def early_category(label: Column | str, name: Column | str) -> Column:
    """The flat category by the early keys, which look at both texts; NULL without one."""
    both = F.lower(F.concat_ws(" ", F.coalesce(column(label), F.lit("")), F.coalesce(column(name), F.lit(""))))
    return F.coalesce(*[F.when(F.contains(both, F.lit(key)), F.lit(category)) for key, category in LEGACY_FIRST])


def legacy_category(label: Column | str, name: Column | str, taxonomy: Taxonomy) -> Column:
    """The flat category: early keys over both texts, then the rules over the label, then over the name."""
    rows = [{"c": c, "k": k.strip()} for c, k in taxonomy.legacy if k.strip()]

    def by_rules(text: Column | str) -> Column:
        return first_hit(legacy_text(text), rows, "struct<c:string,k:string>")["c"]

    return F.coalesce(early_category(label, name), by_rules(label), by_rules(name), F.lit(""))


def unclassified(grp: Column | str = "grp", sub: Column | str = "sub") -> Column:
    return (column(grp) == UNCLASSIFIED_GROUP) & (column(sub) == UNCLASSIFIED_SUB)


def retries() -> Column:
    """Whether a record is classified a second time, if the first finds nothing: a directory listing without a category."""
    return blank("label") & (source_kind("source") == "directory") & ~blank("notes")


def classify_records(records: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Fill grp, sub and, where empty, legacy18.

    A directory listing without a category is classified a second time, from its tagline. The first
    result is worked out once. Every key is part of the expression: tables of
    many hundred keys go through `operators.rule_index`, with the same results.
    """
    again = classify(F.substring("notes", 1, 160), "name", taxonomy)
    found = let(classify("label", "name", taxonomy), lambda first: F.when(
        unclassified(first["grp"], first["sub"]) & retries(), again).otherwise(first))
    legacy = F.when(blank("legacy18"), legacy_category("label", "name", taxonomy)).otherwise(F.col("legacy18"))
    # what holds lambdas is worked out in one step, so that wide rows are copied once
    return records.withColumns({"_found": found, "_flat": legacy}).withColumns({
        "grp": F.col("_found.grp"), "sub": F.col("_found.sub"), "legacy18": F.col("_flat")}).drop("_found", "_flat")
