"""Queries on whole runs: stages stored and resumed, metrics, the ledger of every published number, and what is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.catalog import adapters as A
from placebook.catalog import large
from placebook.catalog.queries import PROFILE, TODAY, joined, prospects, query, resolution, stage
from placebook.operators import quality
from placebook.operators.resolve import list_items, united_lists
from placebook.plans import profiles
from placebook.plans.stages import read_metrics
from placebook.session import materialise, scratch_path
from placebook.sources import csv_import, raw_store
from placebook.taxonomy import Taxonomy

RUN = "catalog"


def run_root(spark, folder) -> str:
    """A census run stored below a folder of its own, started twice: the second time finds every stage finished."""
    def make() -> str:
        root = scratch_path(spark, "run")
        records = materialise(A.sightings(spark, folder), "mapped")
        for _ in range(2):
            profiles.run(spark, records, PROFILE, root, RUN, TODAY)
        return root
    return stage(spark, folder, "run", make)


@query
def stage_round_trip(spark, folder):
    """The businesses of a stored run, as the next run would read them."""
    return raw_store.read_stage(spark, run_root(spark, folder), "businesses").select(
        "ord", "name", "phone", "area", "zone", "grp", "sub", "priority", "contact_channels")


@query
def run_metrics(spark, folder):
    """What each record stage noted when it was stored."""
    done = read_metrics(spark, run_root(spark, folder)).filter("state = 'done'")
    names = ["geo", "classify", "dedupe", "decisions", "conflicts", "businesses"]
    return done.filter(F.col("stage").isin(names)).select(
        "stage", "run_id", F.col("counts")["rows"].alias("n"), F.coalesce(F.try_element_at("counts", F.lit("merged")), F.lit(0)).alias("merged"))


@query
def stored_reports(spark, folder):
    """Reports as they lie on storage."""
    return spark.read.parquet(f"{run_root(spark, folder)}/reports/area_summary").select("area", "total", "phone", "prio_a", "zone")


@query
def stored_decisions(spark, folder):
    return spark.read.parquet(f"{run_root(spark, folder)}/stages/decisions").select(
        "ord", "action", "key", "key_value", "cluster", "kept_name", "merged_name", "merged_source")


# ------------------------------------------------------------------------ the ledger

def _ledger(spark, folder, name: str) -> DataFrame:
    cells = spark.read.parquet(f"{run_root(spark, folder)}/checks/cells")
    return cells.filter(F.col("tbl") == name).select("row", "col", "published", "recount", "ok")


@query
def dq_reconcile_areas(spark, folder):
    return _ledger(spark, folder, "areas")


@query
def dq_reconcile_matrix(spark, folder):
    return _ledger(spark, folder, "matrix")


@query
def dq_reconcile_tree(spark, folder):
    return _ledger(spark, folder, "tree")


@query
def dq_reconcile_research(spark, folder):
    return _ledger(spark, folder, "research")


@query
def dq_reconcile_prospects(spark, folder):
    """Every number of the prospect reports beside its recount."""
    records = prospects(spark, folder)
    published = profiles.prospect_reports(records, PROFILE, TODAY)
    return quality.reconcile_cells(quality.prospect_cells(published), quality.recount_prospects(records))


# ------------------------------------------------------------------------ imports, lists, settings

@query
def csv_ledger(spark, folder):
    """A file for each brand of the part table; those of even brands stand in the ledger: the others are pending."""
    root = scratch_path(spark, "imports")
    part = A.read(spark, folder, "part")["part"]
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    lines = part.select(number.alias("brand"), "p_partkey", F.concat_ws(",", "p_partkey", "p_name", "p_type").alias("value"))
    (lines.repartition("brand").sortWithinPartitions("brand", "p_partkey").select("brand", "value")
     .write.partitionBy("brand").text(root))
    even = [f"{root}/brand={r['brand']}" for r in lines.select("brand").distinct().collect() if r["brand"] % 2 == 0]       # 25 brands
    nothing = spark.createDataFrame([], "term string")
    ledger = csv_import.pending_files(spark, even, nothing) if even else nothing
    pending = csv_import.pending_files(spark, [f"{root}/brand=*"], ledger)
    return pending.select(F.regexp_extract("path", "brand=([0-9]+)", 1).cast("int").alias("brand"), F.substring_index("term", ":", -1).alias("digest"))


@query
def merged_attributes(spark, folder):
    """Signals and chips of all sightings of a business, united."""
    i = F.col("ord")
    signals = (F.when(i % 7 == 2, F.array(F.lit("catering"), F.lit("online ordering")))
               .when(i % 5 == 1, F.array(F.lit("delivery"), F.lit("catering"))).otherwise(F.array().cast("array<string>")))

    def chip(test, group: str, key: str):
        return F.when(test, F.create_map(F.lit(group), F.array(F.create_map(F.lit(key), i % 2 == 0))))

    info = F.coalesce(chip(i % 3 == 0, "Service options", "Delivery"), chip(i % 10 == 1, "Dining options", "Catering"))
    found = resolution(spark, folder)
    members = found.members.withColumns({"delivery_text_signals": signals, "additional_info": info})
    lists = united_lists(list_items(members), members)

    def said(group: str, key: str):
        return F.get(F.try_element_at("all_info", F.lit(group)), F.lit(0))[key]

    return lists.select("cluster", joined("all_signals").alias("signals"), said("Service options", "Delivery").alias("delivery"),
                        said("Dining options", "Catering").alias("catering"))


def part_taxonomy(spark, folder) -> Taxonomy:
    """Settings made from the part table: terms in two cases, a tree that leaves out what every fourth rule yields."""
    keys = A._sql(spark, large.RULE_KEYS, part=A.read(spark, folder, "part")["part"]).orderBy("ord").collect()       # a project's settings
    return Taxonomy(tree=sorted({(r["grp"], r["sub"]) for r in keys if r["ord"] % 4}), rules=[(r["grp"], r["sub"], r["key"]) for r in keys],
                    legacy=[], terms=[(r["grp"], r["key"].lower() if r["ord"] % 3 else r["key"]) for r in keys])


@query
def search_terms(spark, folder):
    """Search terms without case duplicates."""
    return part_taxonomy(spark, folder).terms_df(spark).select("term_ord", "grp", "term")


@query
def rules_outside_tree(spark, folder):
    """What rules yield that the tree doesn't list."""
    return quality.rules_outside_tree(part_taxonomy(spark, folder), spark)


@query
def shapeless_areas(spark, folder):
    """Areas that only an address can name."""
    return large.area_registry(spark, folder).filter("kind = 'name'").select("ord", "area")
