"""Summary tables over finished records. Every dimension row is kept, at zero if need be.

The records are read once per run: `census_cube` and `prospect_cube` count them by all dimensions together, and
every table is a roll-up of that. A cube has at most one row per combination of registry values that occurs
(areas, subcategories, bands), however many records there are; so have the dimensions joined afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placebook.areas import Area, areas_df
from placebook.functions.provenance import source_kind
from placebook.functions.rules import unclassified
from placebook.functions.scoring import BAND_NAMES, CATEGORIES, OTHER
from placebook.functions.text import blank
from placebook.operators.priority import GOOGLE_VERIFIED, PRIORITY_A, PRIORITY_B, PRIORITY_C, programme
from placebook.schema import (BASIS_FULL, COMPONENTS, CORE_ZONE, MULTI_SOURCE, OUTSIDE, RING_ZONE, UNASSIGNED)
from placebook.taxonomy import Taxonomy

TOTAL = "TOTAL"
MARKERS = [OUTSIDE, UNASSIGNED]
# fixed values: research targets per zone
TARGET_CORE, TARGET_RING = 30, 15
PROSPECT_CHANNELS = ["phone", "whatsapp", "website", "email", "instagram"]
CATEGORY_NAMES = [name for name, _, _ in CATEGORIES]


def in_display_order() -> list[str]:
    return ["Restaurant / Food", "Supermarket / Grocery", "Pharmacy", OTHER]


def n_where(test: Column) -> Column:
    return F.count_if(test)


def census_cube(records: DataFrame) -> DataFrame:
    """Records counted by zone, area, group and subcategory: what all census tables are made of."""
    return records.groupBy("zone", "area", "grp", "sub").agg(
        F.count(F.lit(1)).alias("n"), n_where(F.col("contactable") == "Yes").alias("phone"),
        n_where(F.col("verification") == GOOGLE_VERIFIED).alias("google_verified"),
        n_where(F.col("priority") == PRIORITY_A).alias("prio_a"), n_where(F.col("priority") == PRIORITY_B).alias("prio_b"),
        n_where(F.col("priority") == PRIORITY_C).alias("prio_c"), n_where(F.col("source") == MULTI_SOURCE).alias("cross_verified"))


def prospect_cube(records: DataFrame) -> DataFrame:
    """Prospects counted by area, category, band and basis, with their channels and score components."""
    return records.groupBy("area", "delivery_category", "band", "score_basis").agg(
        F.count(F.lit(1)).alias("n"), *[n_where(~blank(c)).alias(c) for c in PROSPECT_CHANNELS],
        *[n_where(F.col("components")[c] > 0).alias(f"part_{c}") for c, _, _ in COMPONENTS])


def sum_where(measure: str, test: Column | None = None) -> Column:
    """The measure of the cells that pass the test, 0 if there are none."""
    value = F.col(measure) if test is None else F.when(test, F.col(measure))
    return F.coalesce(F.sum(value), F.lit(0))


def _unpivot(one_row: DataFrame, keys: list[str], name: str = "kpi") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(k).alias(name), F.col(k).cast("bigint").alias("value"))
                      for i, k in enumerate(keys)])
    return one_row.select(F.explode(pairs).alias("p")).select("p.*")


def area_rows(spark, areas: list[Area], core: list[str], markers: bool = True) -> DataFrame:
    """Report rows for areas: core areas first, then ring areas, then the two markers."""
    ordered = [a for a in areas if a.name in core] + [a for a in areas if a.name not in core]
    rows = areas_df(spark, ordered, core).select("area_ord", "area", "zone")
    if markers:
        extra = spark.createDataFrame([(len(ordered) + i, m, m) for i, m in enumerate(MARKERS)], rows.schema)
        rows = rows.unionByName(extra)
    return rows


def census_kpis(cube: DataFrame) -> DataFrame:
    """The eleven headline numbers: pos, kpi, value."""
    zones = {"core": CORE_ZONE, "ring": RING_ZONE, "outside": OUTSIDE, "unassigned": UNASSIGNED}
    one = cube.agg(
        sum_where("n").alias("total"), *[sum_where("n", F.col("zone") == z).alias(k) for k, z in zones.items()],
        *[sum_where(c).alias(c) for c in ("phone", "google_verified", "prio_a", "prio_b", "prio_c", "cross_verified")])
    return _unpivot(one, one.columns)


def group_table(cube: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Businesses by category group, inside the catchment, with a TOTAL row and each group's share."""
    inside = F.col("zone").isin(CORE_ZONE, RING_ZONE)
    counts = cube.groupBy("grp").agg(
        sum_where("n", F.col("zone") == CORE_ZONE).alias("core"), sum_where("n", F.col("zone") == RING_ZONE).alias("ring"),
        sum_where("phone", inside).alias("phone"), sum_where("prio_a").alias("prio_a"))
    cols = ["core", "ring", "total", "phone", "prio_a"]
    rows = (taxonomy.groups_df(cube.sparkSession).join(counts, "grp", "left")
            .select("group_ord", "grp", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("core", "ring", "phone", "prio_a")])
            .withColumn("total", F.col("core") + F.col("ring")))
    return _with_total(rows, "grp", "group_ord", cols)


def _with_total(rows: DataFrame, name: str, ord_col: str, cols: list[str]) -> DataFrame:
    """Add a TOTAL row (last) and each row's share of it; rows are one per dimension value."""
    sums = rows.agg(*[F.sum(c).alias(c) for c in cols], (F.max(ord_col) + 1).alias(ord_col))
    both = rows.select(ord_col, name, *cols).unionByName(sums.select(ord_col, F.lit(TOTAL).alias(name), *cols))
    # a window over the report, which has one row per dimension value
    everything = F.max(F.when(F.col(name) == TOTAL, F.col("total"))).over(Window.partitionBy(F.lit(0)))
    share = F.when(everything > 0, F.round(F.col("total") / everything, 6)).otherwise(F.lit(0.0))
    return both.select(ord_col, name, *cols, share.alias("share"))


def area_summary(cube: DataFrame, areas: list[Area], core: list[str]) -> DataFrame:
    """Coverage by area, with the two markers and a TOTAL row."""
    counts = cube.groupBy("area").agg(
        sum_where("n").alias("total"), *[sum_where(c).alias(c) for c in ("phone", "google_verified", "prio_a", "prio_b")])
    dims = area_rows(cube.sparkSession, areas, core)
    cols = ["total", "phone", "google_verified", "prio_a", "prio_b", "prio_cd"]
    rows = (dims.join(counts, "area", "left")
            .select("area_ord", "area", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols[:-1]])
            .withColumn("prio_cd", F.col("total") - F.col("prio_a") - F.col("prio_b")))
    zones = dims.select("area", "zone")
    return _with_total(rows, "area", "area_ord", cols).join(zones, "area", "left").withColumn(
        "zone", F.coalesce("zone", F.lit("")))


def group_area_matrix(cube: DataFrame, taxonomy: Taxonomy, areas: list[Area], core: list[str]) -> DataFrame:
    """Groups by areas, with totals both ways. The columns are known, so no pass looks for them."""
    names = [a.name for a in areas if a.name in core] + [a.name for a in areas if a.name not in core] + MARKERS
    counts = cube.groupBy("grp").agg(*[sum_where("n", F.col("area") == n).alias(f"a{i}") for i, n in enumerate(names)])
    cols = [f"a{i}" for i in range(len(names))]
    rows = (taxonomy.groups_df(cube.sparkSession).join(counts, "grp", "left")
            .select("group_ord", "grp", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols])
            .withColumn("total", reduce(lambda a, b: a + b, [F.col(c) for c in cols])))
    out = _with_total(rows, "grp", "group_ord", cols + ["total"])
    return out.select("group_ord", "grp", *[F.col(c).alias(n) for c, n in zip(cols, names)], "total")


def tree_coverage(cube: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Every subcategory of the tree, then the ones found outside it, with counts and a status."""
    counts = cube.groupBy("grp", "sub").agg(
        sum_where("n").alias("found"), sum_where("n", F.col("zone") == CORE_ZONE).alias("core"),
        sum_where("n", F.col("zone") == RING_ZONE).alias("ring"))
    tree = taxonomy.tree_df(cube.sparkSession)
    rows = tree.join(counts, ["grp", "sub"], "full")
    found = F.coalesce("found", F.lit(0))
    return rows.select(
        "grp", "sub", F.col("tree_ord").isNotNull().alias("in_tree"), found.alias("found"),
        F.coalesce("core", F.lit(0)).alias("core"), F.coalesce("ring", F.lit(0)).alias("ring"),
        F.when(found == 0, "No matches yet").when(found < 5, "Thin").when(found < 20, "Covered")
        .otherwise("Well covered").alias("status"))


def subs_outside_tree(cube: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    seen = cube.select("grp", "sub").distinct()
    return seen.join(F.broadcast(taxonomy.tree_df(cube.sparkSession)), ["grp", "sub"], "left_anti")


def research_matrix(cube: DataFrame, taxonomy: Taxonomy, areas: list[Area], core: list[str]) -> DataFrame:
    """Every area by every group: found, target, gap, coverage and what to do next."""
    spark = cube.sparkSession
    counts = cube.groupBy("area", "grp").agg(sum_where("n").alias("found"))
    # the full grid of two registries, not of data
    groups = F.array(*[F.struct(F.lit(i).alias("group_ord"), F.lit(g).alias("grp")) for i, g in enumerate(taxonomy.groups)])
    grid = (area_rows(spark, areas, core, markers=False).withColumn("g", F.explode(groups))
            .select("area_ord", "area", "zone", "g.*"))
    found = F.coalesce("found", F.lit(0))
    target = F.when(F.col("zone") == CORE_ZONE, TARGET_CORE).otherwise(TARGET_RING)
    return grid.join(counts, ["area", "grp"], "left").select(
        "area_ord", "group_ord", "area", "zone", "grp", found.alias("found"), target.alias("target"),
        F.greatest(F.lit(0), target - found).alias("gap"),
        F.round(F.least(F.lit(1.0), found / target), 6).alias("coverage"),
        F.when(found >= target, "Maintain - re-check quarterly")
        .otherwise(F.concat(F.lit("Canvass "), "area", F.lit(" for "), "grp")).alias("next_action"))


def prospect_kpis(cube: DataFrame) -> DataFrame:
    """The fourteen headline numbers of the prospect list."""
    bands = dict(zip(["hot", "warm", "cool", "cold"], BAND_NAMES))
    one = cube.agg(
        sum_where("n").alias("total"), *[sum_where("n", F.col("band") == b).alias(k) for k, b in bands.items()],
        *[sum_where(f"part_{c}").alias(c) for c in ("delivery_flag", "catering", "chain")],
        *[sum_where(c).alias(c) for c in PROSPECT_CHANNELS],
        sum_where("n", F.col("score_basis") == BASIS_FULL).alias("full_basis"))
    return _unpivot(one, one.columns)


def area_category(cube: DataFrame, areas: list[Area]) -> DataFrame:
    """Prospects by area and delivery category, with the hot ones and a TOTAL row."""
    cats = in_display_order()
    counts = cube.groupBy("area").agg(
        *[sum_where("n", F.col("delivery_category") == c).alias(f"c{i}") for i, c in enumerate(cats)],
        sum_where("n", F.col("band") == BAND_NAMES[0]).alias("hot"))
    cols = [f"c{i}" for i in range(len(cats))] + ["hot"]
    rows = (area_rows(cube.sparkSession, areas, []).join(counts, "area", "left")
            .select("area_ord", "area", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols])
            .withColumn("total", reduce(lambda a, b: a + b, [F.col(c) for c in cols[:-1]])))
    out = _with_total(rows, "area", "area_ord", cols + ["total"])
    return out.select("area_ord", "area", *[F.col(f"c{i}").alias(c) for i, c in enumerate(cats)], "total", "hot")


def component_counts(cube: DataFrame) -> DataFrame:
    """Per score component: most points and how many prospects have it."""
    one = cube.agg(*[sum_where(f"part_{c}").alias(c) for c, _, _ in COMPONENTS])
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(label).alias("component"), F.lit(most).alias("max_points"),
                               F.col(c).alias("prospects")) for i, (c, label, most) in enumerate(COMPONENTS)])
    return one.select(F.explode(items).alias("i")).select("i.*")


def count_by(records: DataFrame, column: str) -> DataFrame:
    return records.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cells_by(cube: DataFrame, column: str) -> DataFrame:
    return cube.groupBy(column).agg(sum_where("n").alias("n"))


def source_log(records: DataFrame) -> DataFrame:
    """Records per source text; a record counts once for each of its sources."""
    return (records.select(F.explode(F.array_distinct("sources_all")).alias("source"))
            .groupBy("source").agg(F.count(F.lit(1)).alias("records")))


def source_mentions_by_kind(records: DataFrame) -> DataFrame:
    """Mentions per kind of source: two sources of one kind count twice for a record."""
    return (records.select(F.explode(F.array_distinct("sources_all")).alias("s"))
            .groupBy(source_kind("s").alias("kind")).agg(F.count(F.lit(1)).alias("mentions")))


def channel_counts(records: DataFrame) -> DataFrame:
    fields = ["website", "email", "whatsapp", "instagram", "facebook"]
    one = records.agg(*[n_where(~blank(c)).alias(c) for c in fields])
    return _unpivot(one, fields, "channel")


def top_unclassified(records: DataFrame, n: int = 20) -> DataFrame:
    """The labels no rule knows, most frequent first."""
    return (records.filter(unclassified()).groupBy(first_label().alias("label")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "label").limit(n))


def first_label() -> Column:
    return F.when(blank("label"), "(no label)").otherwise(F.col("label"))


def geo_stats(records: DataFrame) -> DataFrame:
    return count_by(records, "area")


# ------------------------------------------------------------------------ export projections

def _empty_as_null(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def census_export(numbered: DataFrame, areas: list[Area], today: str) -> DataFrame:
    """The census list, one column per heading; blanks where a value is absent. `id` numbers the rows."""
    n = [a.name for a in areas]
    cols = [
        ("ID", F.col("id")), ("Business Name", "name"), ("Zone", "zone"), ("Catchment", "area"),
        ("Street / Cluster", "street"), ("Category Group", "grp"), ("Subcategory", "sub"), ("Source Category", "label"),
        ("Legacy 18-Category", "legacy18"), ("Full Address", "addr"), ("Phone", "phone"), ("Website", "website"),
        ("Google Maps", "maps"), ("Google Rating", F.col("rating")), ("Google Reviews", F.col("reviews")),
        ("Has Phone", "contactable"), ("Latitude", F.col("lat")), ("Longitude", F.col("lng")), ("Data Source", "source"),
        ("Date Added", "added"), ("Last Checked", F.lit(today)), ("Verification", "verification"),
        ("Prospect Priority", "priority"), ("Suggested Package", "package"), ("Sales Status", "sales_status"),
        ("Sales Notes", "notes"), ("WhatsApp", "whatsapp"), ("Email", "email"), ("Instagram", "instagram"),
        ("Facebook", "facebook"), ("Contact Channels", F.col("contact_channels")),
        ("All Sources", F.array_join("sources_all", "; ")), ("Programme", F.nullif(programme("area", n), F.lit(""))),
        ("Delivery Category", "delivery_category"), ("Delivery Score", F.col("score")), ("Delivery Band", "band"),
        ("Score Basis", "score_basis")]
    return numbered.select(*[(_empty_as_null(c) if isinstance(c, str) else c).alias(h) for h, c in cols])


def prospect_export(numbered: DataFrame, today: str) -> DataFrame:
    """The prospect list with one column per score component. `id` is the rank."""
    head = [("Rank", F.col("id")), ("Business Name", "name"), ("Area", "area"), ("Category", "delivery_category"),
            ("Google Category", "label"), ("Delivery Score", F.col("score")), ("Band", "band"), ("Score basis", "score_basis")]
    parts = [(label, F.coalesce(F.col("components")[c], F.lit(0.0))) for c, label, _ in COMPONENTS]
    tail = [("Google Rating", F.col("rating")), ("Reviews", F.col("reviews")), ("Phone", "phone"),
            ("All Phones", F.nullif(F.array_join("phones_all", "; "), F.lit(""))), ("WhatsApp", "whatsapp"),
            ("Website", "website"), ("Email", "email"), ("Instagram", "instagram"), ("Facebook", "facebook"),
            ("Twitter / X", "twitter"), ("LinkedIn", "linkedin"), ("TikTok", "tiktok"),
            ("Contact Channels", F.col("contact_channels")), ("Full Address", "addr"), ("Latitude", F.col("lat")),
            ("Longitude", F.col("lng")), ("Google Maps", "maps"), ("Data Source", "source"), ("Last Checked", F.lit(today)),
            ("Approach Status", F.lit("Not approached")), ("Notes", "notes")]
    return numbered.select(*[(_empty_as_null(c) if isinstance(c, str) else c).alias(h) for h, c in head + parts + tail])
