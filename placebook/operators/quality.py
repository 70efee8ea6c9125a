"""Reconciliation: recount every published number by another route, and check the records themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placebook.areas import Area
from placebook.functions.rules import unclassified
from placebook.functions.scoring import BAND_NAMES
from placebook.functions.text import PHONE_FORMAT, blank
from placebook.operators.priority import GOOGLE_VERIFIED, PRIORITY_A, PRIORITY_B, PRIORITY_C
from placebook.schema import (BASIS_FULL, COMPONENTS, CORE_ZONE, MULTI_SOURCE, OUTSIDE, RECORD, RING_ZONE, UNASSIGNED,
                              UNCLASSIFIED_GROUP, UNCLASSIFIED_SUB)
from placebook.taxonomy import Taxonomy

TOTAL = "TOTAL"
MAX_UNCLASSIFIED = 0.05


def recount_census(records: DataFrame) -> DataFrame:
    """The headline numbers by filtering records into (kpi, 1) rows and counting those.

    The reports count with conditional aggregates; this counts exploded memberships, so a condition on
    the wrong column in one of them shows as a difference.
    """
    zones = F.create_map(*[F.lit(x) for pair in ((CORE_ZONE, "core"), (RING_ZONE, "ring"), (OUTSIDE, "outside"),
                                                 (UNASSIGNED, "unassigned")) for x in pair])
    priorities = F.create_map(*[F.lit(x) for pair in ((PRIORITY_A, "prio_a"), (PRIORITY_B, "prio_b"),
                                                      (PRIORITY_C, "prio_c")) for x in pair])
    belongs = F.array_compact(F.array(
        F.lit("total"), F.try_element_at(zones, F.col("zone")), F.try_element_at(priorities, F.col("priority")),
        F.when(F.length("phone") > 0, F.lit("phone")),
        F.when(F.col("verification") == GOOGLE_VERIFIED, F.lit("google_verified")),
        F.when(F.col("source") == MULTI_SOURCE, F.lit("cross_verified"))))
    return (records.select(F.explode(belongs).alias("kpi")).groupBy("kpi")
            .agg(F.count(F.lit(1)).alias("recount")))


def reconcile(published: DataFrame, recounted: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Every published cell beside its recount; `ok` is false where they differ or one is missing."""
    both = published.select(*keys, F.col(value).alias("published")).join(
        recounted.select(*keys, "recount"), keys, "full")
    return both.select(*keys, F.coalesce("published", F.lit(0)).alias("published"),
                       F.coalesce("recount", F.lit(0)).alias("recount")).withColumn(
        "ok", F.col("published") == F.col("recount"))


def recount_groups(records: DataFrame) -> DataFrame:
    """The group table's cells, recounted: grp, col, recount."""
    inside = F.col("zone").isin(CORE_ZONE, RING_ZONE)
    cells = F.array_compact(F.array(
        F.when(F.col("zone") == CORE_ZONE, F.lit("core")), F.when(F.col("zone") == RING_ZONE, F.lit("ring")),
        F.when(inside, F.lit("total")), F.when(inside & (F.length("phone") > 0), F.lit("phone")),
        F.when(F.col("priority") == PRIORITY_A, F.lit("prio_a"))))
    return records.select("grp", F.explode(cells).alias("col")).groupBy("grp", "col").agg(
        F.count(F.lit(1)).alias("recount"))


def long_form(table: DataFrame, key: str, cols: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("bigint").alias("value")) for c in cols])
    return table.select(key, F.explode(cells).alias("c")).select(key, "c.*")


# ------------------------------------------------------------------------ the ledger: every number of every report as a cell

def _cells(name: str, table: DataFrame, row: Column, cols: list[str]) -> DataFrame:
    """A report as rows (tbl, row, col, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("bigint").alias("value")) for c in cols])
    return table.select(F.lit(name).alias("tbl"), row.alias("row"), F.explode(cells).alias("c")).select("tbl", "row", "c.col", "c.value")


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def census_cells(published: dict[str, DataFrame]) -> DataFrame:
    """Every number of the census reports: tbl, row, col, value."""
    matrix = published["group_area"]
    pair = F.concat_ws(" > ", "area", "grp")
    return _united([
        _cells("kpis", published["kpis"], F.col("kpi"), ["value"]),
        _cells("groups", published["group_table"], F.col("grp"), ["core", "ring", "total", "phone", "prio_a"]),
        _cells("areas", published["area_summary"], F.col("area"), ["total", "phone", "google_verified", "prio_a", "prio_b", "prio_cd"]),
        _cells("matrix", matrix, F.col("grp"), [c for c in matrix.columns if c not in ("group_ord", "grp")]),
        _cells("tree", published["tree_coverage"], F.concat_ws(" > ", "grp", "sub"), ["found", "core", "ring"]),
        _cells("research", published["research_matrix"], pair, ["found"])])


def prospect_cells(published: dict[str, DataFrame]) -> DataFrame:
    """Every number of the prospect reports: tbl, row, col, value."""
    areas = published["area_category"]
    return _united([
        _cells("kpis", published["kpis"], F.col("kpi"), ["value"]),
        _cells("areas", areas, F.col("area"), [c for c in areas.columns if c not in ("area_ord", "area")]),
        _cells("components", published["components"], F.col("component"), ["prospects"]),
        _cells("bands", published["bands"], F.col("band"), ["n"]), _cells("basis", published["basis"], F.col("score_basis"), ["n"])])


def _recount(records: DataFrame, memberships: list[Column]) -> DataFrame:
    """How many records are members of each cell; a membership is struct(tbl, row, col) or NULL. Combined before the shuffle."""
    return (records.select(F.explode(F.array_compact(F.array(*memberships))).alias("m")).groupBy("m.tbl", "m.row", "m.col")
            .agg(F.count(F.lit(1)).alias("recount")))


def _member(tbl: str, row: Column | str, col: Column | str, test: Column | None = None) -> Column:
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    cell = F.struct(F.lit(tbl).alias("tbl"), as_col(row).alias("row"), as_col(col).alias("col"))
    return cell if test is None else F.when(test, cell)


def recount_cells(records: DataFrame, taxonomy: Taxonomy, areas: list[Area], core: list[str]) -> DataFrame:
    """The cells of the census reports, counted anew from what each record is a member of: tbl, row, col, recount."""
    grp, area, zone, prio = F.col("grp"), F.col("area"), F.col("zone"), F.col("priority")
    is_core, is_ring, phone = zone == CORE_ZONE, zone == RING_ZONE, F.length("phone") > 0
    inside, checked, lead = is_core | is_ring, F.col("verification") == GOOGLE_VERIFIED, prio == PRIORITY_A
    where = F.array(*[F.lit(a.name) for a in areas])
    out = [_member("kpis", k, "value", test) for k, test in (
        ("total", F.lit(True)), ("core", is_core), ("ring", is_ring), ("outside", zone == OUTSIDE), ("unassigned", zone == UNASSIGNED), ("phone", phone),
        ("google_verified", checked), ("prio_a", lead), ("prio_b", prio == PRIORITY_B), ("prio_c", prio == PRIORITY_C), ("cross_verified", F.col("source") == MULTI_SOURCE))]
    for row in (grp, F.lit(TOTAL)):
        out += [_member("groups", row, c, test) for c, test in (
            ("core", is_core), ("ring", is_ring), ("total", inside), ("phone", inside & phone), ("prio_a", lead))]
        out += [_member("matrix", row, c) for c in (area, F.lit("total"))]
    for row in (area, F.lit(TOTAL)):
        out += [_member("areas", row, c, test) for c, test in (
            ("total", None), ("phone", phone), ("google_verified", checked), ("prio_a", lead), ("prio_b", prio == PRIORITY_B),
            ("prio_cd", ~F.coalesce(prio.isin(PRIORITY_A, PRIORITY_B), F.lit(False))))]
    subs = F.concat_ws(" > ", "grp", "sub")
    out += [_member("tree", subs, c, test) for c, test in (("found", None), ("core", is_core), ("ring", is_ring))]
    out.append(_member("research", F.concat_ws(" > ", "area", "grp"), "found", F.array_contains(where, area)))
    return _recount(records, out)


def recount_prospects(records: DataFrame) -> DataFrame:
    """The cells of the prospect reports, counted anew."""
    parts, band, area = F.col("components"), F.col("band"), F.col("area")
    out = [_member("kpis", k, "value", test) for k, test in (
        ("total", F.lit(True)), *[(k, band == b) for k, b in zip(("hot", "warm", "cool", "cold"), BAND_NAMES)],
        *[(k, parts[k] > 0) for k in ("delivery_flag", "catering", "chain")], *[(k, F.length(k) > 0) for k in ("phone", "whatsapp", "website", "email", "instagram")],
        ("full_basis", F.col("score_basis") == BASIS_FULL))]
    for row in (area, F.lit(TOTAL)):
        out += [_member("areas", row, F.col("delivery_category")), _member("areas", row, "total"), _member("areas", row, "hot", band == BAND_NAMES[0])]
    out += [_member("components", label, "prospects", parts[c] > 0) for c, label, _ in COMPONENTS]
    out += [_member("bands", band, "n"), _member("basis", F.col("score_basis"), "n")]
    return _recount(records, out)


def reconcile_cells(published: DataFrame, recounted: DataFrame) -> DataFrame:
    """Every cell beside its recount: tbl, row, col, published, recount, ok. A cell that only one side has counts 0 on the other."""
    return reconcile(published, recounted, ["tbl", "row", "col"])


def schema_problems(records: DataFrame, taxonomy: Taxonomy, areas: list[Area]) -> DataFrame:
    """Counts of records that break the schema: one row, all zeros when well."""
    known = F.array(*[F.lit(a.name) for a in areas], F.lit(OUTSIDE), F.lit(UNASSIGNED))
    groups = F.array(*[F.lit(g) for g in taxonomy.groups])
    text = [f.name for f in RECORD.fields if f.dataType.typeName() == "string"]
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in text if c in records.columns])
    tree = taxonomy.tree_df(records.sparkSession).select("grp", "sub", F.lit(True).alias("in_tree"))
    checked = records.join(F.broadcast(tree), ["grp", "sub"], "left")
    special = (F.col("grp") == UNCLASSIFIED_GROUP) & (F.col("sub") == UNCLASSIFIED_SUB)
    return checked.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(nulls).alias("null_text"),
        F.count_if(~blank("phone") & ~F.col("phone").rlike(PHONE_FORMAT)).alias("bad_phone"),
        F.count_if(~F.array_contains(groups, F.col("grp"))).alias("unknown_group"),
        F.count_if(F.col("in_tree").isNull() & ~special).alias("unknown_sub"),
        F.count_if(~F.array_contains(known, F.col("area"))).alias("unknown_area"))


def unclassified_share(records: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    bad = F.count_if(unclassified())
    return records.agg(n.alias("records"), bad.alias("unclassified")).withColumn(
        "share", F.when(F.col("records") > 0, F.round(F.col("unclassified") / F.col("records"), 6)).otherwise(0.0)
    ).withColumn("ok", F.col("share") < MAX_UNCLASSIFIED)


def shared_phones(records: DataFrame) -> DataFrame:
    """Phones on several records: fine for distinct places only (branches of one owner).

    A row is `ok` when all its records have a place id and no two have the same. Distinct ids are counted
    by grouping on (phone, id) first, so that a hot number never gathers its records in one task.
    """
    per_id = (records.filter(~blank("phone")).groupBy("phone", "place_id").agg(F.count(F.lit(1)).alias("n")))
    return (per_id.groupBy("phone").agg(
        F.sum("n").alias("records"), F.count_if(~blank("place_id")).alias("distinct_ids"),
        F.sum(F.when(blank("place_id"), F.col("n")).otherwise(0)).alias("without_id"))
        .filter("records > 1")
        .withColumn("ok", (F.col("without_id") == 0) & (F.col("distinct_ids") == F.col("records"))))


def shared_place_ids(records: DataFrame) -> DataFrame:
    return (records.filter(~blank("place_id")).groupBy("place_id").agg(F.count(F.lit(1)).alias("records"))
            .filter("records > 1"))


def report_totals(totals: dict[str, DataFrame]) -> DataFrame:
    """Row counts that must agree across datasets: name, n, ok. Each input has one row with column n."""
    out = None
    for name, df in totals.items():
        part = df.select(F.lit(name).alias("name"), F.col("n").cast("bigint").alias("n"))
        out = part if out is None else out.unionByName(part)
    all_rows = Window.partitionBy(F.lit(0))          # one row per dataset
    return out.withColumn("ok", F.min("n").over(all_rows) == F.max("n").over(all_rows))


def spot_check(records: DataFrame, run_id: str, n: int = 10) -> DataFrame:
    """A fixed sample for a human to check; the same for the same run. Nothing here says it was checked."""
    return (records.withColumn("_h", F.md5(F.concat_ws(":", F.lit(run_id), F.col("ord")).cast("binary"))).orderBy("_h", "ord").limit(n)
            .select("ord", "name", "area", "grp", "sub", "phone", "addr", "source", "maps"))


def rules_outside_tree(taxonomy: Taxonomy, spark) -> DataFrame:
    """Rules that yield a subcategory the tree does not list; empty means consistent."""
    return taxonomy.rules_df(spark).select("grp", "sub").distinct().join(
        taxonomy.tree_df(spark), ["grp", "sub"], "left_anti")


def tree_counts(taxonomy: Taxonomy) -> dict[str, int]:
    return {"groups": len({g for g, _ in taxonomy.tree}), "subcategories": len(taxonomy.tree),
            "terms": len({t.lower() for _, t in taxonomy.terms})}
