"""Profiles and the stages they are made of.

A run is geo -> classify -> dedupe -> enrich -> score -> report -> verify, each stage stored (`stages`). Merging comes before
enrichment and scoring, so that look-ups are spent once per business and a business listed twice does
not pass for a chain.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS, CENSUS_CORE, PROSPECT_AREAS, Area
from placebook.functions.geo import assign_area, zone_of
from placebook.functions.rules import classify_records
from placebook.functions.scoring import in_scope, score_records
from placebook.functions.text import first_filled, street_of
from placebook.operators import area_index, enrich, quality, reports, rule_index
from placebook.operators.enrich import contact_channels
from placebook.operators.ordering import census_order, number_rows, prospect_order
from placebook.operators.priority import assign_priority, split_pois
from placebook.operators.resolve import Resolution
from placebook.plans.stages import Stages, files_of, read_metrics
from placebook.schema import conform
from placebook.session import materialise
from placebook.sources.raw_store import read_stage
from placebook.taxonomy import Taxonomy


@dataclass(frozen=True)
class Profile:
    """What a run covers. Unknown settings are refused by the constructor."""

    kind: str                                            # "census" or "prospects"
    areas: list[Area]
    core: list[str] = field(default_factory=list)
    taxonomy: Taxonomy = field(default_factory=Taxonomy.starter)
    terms: list[str] | None = None                       # None: every term of the taxonomy
    bands: tuple[float, float, float] = (60, 40, 25)

    def __post_init__(self) -> None:
        if self.kind not in ("census", "prospects"):
            raise ValueError(f"unknown profile kind {self.kind!r}")
        missing = [c for c in self.core if c not in {a.name for a in self.areas}]
        if missing:
            raise ValueError(f"core areas not in areas: {missing}")
        if tuple(self.bands) != (60, 40, 25):
            raise ValueError("the bands are 60, 40 and 25 by agreement; change them in scoring")
        if self.terms is not None and not self.terms:
            raise ValueError("a subset of terms needs terms")


def census_profile(taxonomy: Taxonomy | None = None) -> Profile:
    return Profile("census", CENSUS_AREAS, CENSUS_CORE, taxonomy or Taxonomy.starter())


def prospect_profile(taxonomy: Taxonomy | None = None) -> Profile:
    # fixed values: the prospect terms
    terms = ["restaurant", "fast food", "supermarket", "grocery store", "pharmacy", "chemist", "bakery", "catering",
             "mini mart", "provision store", "hypermarket", "food store"]
    return Profile("prospects", PROSPECT_AREAS, [], taxonomy or Taxonomy.starter(), terms)


def combined_profile(taxonomy: Taxonomy | None = None) -> Profile:
    return Profile("census", CENSUS_AREAS + PROSPECT_AREAS, CENSUS_CORE, taxonomy or Taxonomy.starter())


# ------------------------------------------------------------------------ stages

#: Areas that are tried one after another in an expression; a longer registry is looked up in an index, with the same areas.
LITERAL_AREAS = 64


def with_area(records: DataFrame, areas: list[Area]) -> DataFrame:
    """Records with their area."""
    if len(areas) <= LITERAL_AREAS:
        return records.withColumn("area", assign_area("lat", "lng", "addr", areas)["area"])
    index = area_index.build(area_index.registry(records.sparkSession, areas))
    return area_index.assign(records, index).withColumn("area", F.col("placed.area")).drop("placed")


def place(records: DataFrame, profile: Profile, today: str) -> DataFrame:
    """Area, zone, street and date of mapped records."""
    placed = with_area(records, profile.areas)
    return placed.withColumns({
        "zone": zone_of("area", profile.core), "street": first_filled("street", street_of("addr")),
        "added": first_filled("added", F.lit(today))})


#: Keys that are tried one after another in an expression; longer tables are looked up in an index, with the same results.
LITERAL_KEYS = 400


def classify(records: DataFrame, profile: Profile) -> DataFrame:
    """Group, subcategory and legacy category."""
    t, spark = profile.taxonomy, records.sparkSession
    if not t.keys_beyond(LITERAL_KEYS):
        return classify_records(records, t)
    return rule_index.classify_records(records, t.rules_df(spark), t.legacy_df(spark))


def warn_shapeless(profile: Profile) -> list[str]:
    """Areas without geometry: only an address can place a record there."""
    return [a.name for a in profile.areas if a.kind == "name"]


def finish_businesses(businesses: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(kept businesses with channels and priority, dropped landmarks)."""
    kept, dropped = split_pois(businesses)
    kept = kept.withColumn("contact_channels", contact_channels())
    return (assign_priority(kept, profile.core) if profile.kind == "census" else kept), dropped


def enrich_records(records: DataFrame, today: str, sites: DataFrame | None = None, details: DataFrame | None = None,
                   answers: DataFrame | None = None) -> DataFrame:
    """Apply what was found, in order: websites, detail pages, API answers. Each is optional.

    sites: per website (`enrich.site_contacts`), details: per place (`parse_details`), answers: per API
    id (`latest_answers`). Each step is stored, since a number given away in one is taken in the next.
    """
    if sites is not None:
        records = materialise(enrich.apply_site_contacts(records, sites), "sites")
    if details is not None:
        records = materialise(enrich.apply_details(records, details, today), "details")
    if answers is not None:
        label = f"Google Places API ({date.fromisoformat(today).strftime('%b %Y')})"
        records = materialise(enrich.apply_api(records, answers, label), "answers")
    return records


def score(records: DataFrame) -> DataFrame:
    """Scored prospects; records of other trades leave after scoring."""
    return in_scope(score_records(records))


def census_reports(records: DataFrame, profile: Profile, today: str) -> dict[str, DataFrame]:
    t, a, c = profile.taxonomy, profile.areas, profile.core
    cube = materialise(reports.census_cube(records), "census-cube")
    return {
        "kpis": reports.census_kpis(cube), "group_table": reports.group_table(cube, t),
        "area_summary": reports.area_summary(cube, a, c), "group_area": reports.group_area_matrix(cube, t, a, c),
        "tree_coverage": reports.tree_coverage(cube, t), "research_matrix": reports.research_matrix(cube, t, a, c),
        "source_log": reports.source_log(records),
        "master": reports.census_export(number_rows(records, census_order()), a, today)}


def prospect_reports(scored: DataFrame, profile: Profile, today: str) -> dict[str, DataFrame]:
    cube = materialise(reports.prospect_cube(scored), "prospect-cube")
    return {"kpis": reports.prospect_kpis(cube),
            "area_category": reports.area_category(cube, profile.areas), "components": reports.component_counts(cube),
            "bands": reports.cells_by(cube, "band"), "basis": reports.cells_by(cube, "score_basis"),
            "targets": reports.prospect_export(number_rows(scored, prospect_order()), today)}


def combine(runs: list[DataFrame], profile: Profile) -> tuple[Resolution, DataFrame]:
    """Finished runs as one master: areas assigned anew, scored records first, merged across runs."""
    union = None
    for i, run in enumerate(runs):
        part = conform(run.select(*[c for c in run.columns if c != "n_sightings"])).withColumn("_run", F.lit(i))
        union = part if union is None else union.unionByName(part)
    placed = with_area(union, profile.areas)
    order = [F.col("score").isNull(), F.col("_run"), F.col("ord")]
    numbered = number_rows(placed, order, "_ord").withColumn("ord", F.col("_ord")).drop("_ord", "_run")
    resolution = Resolution(numbered)
    kept = resolution.businesses().withColumn("zone", zone_of("area", profile.core))
    return resolution, assign_priority(kept, profile.core).withColumn("contact_channels", contact_channels())


def verify(records: DataFrame, profile: Profile, published: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The checks of a finished run, each a small table; `ok` columns say whether they hold.

    `cells` recounts every number of every report from the records.
    """
    t, a, c = profile.taxonomy, profile.areas, profile.core
    if profile.kind == "prospects":
        return {"cells": quality.reconcile_cells(quality.prospect_cells(published), quality.recount_prospects(records)),
                "schema": quality.schema_problems(records, t, a), "shared_phones": quality.shared_phones(records),
                "shared_ids": quality.shared_place_ids(records)}
    return {
        "cells": quality.reconcile_cells(quality.census_cells(published), quality.recount_cells(records, t, a, c)),
        "schema": quality.schema_problems(records, t, a), "unclassified": quality.unclassified_share(records),
        "shared_phones": quality.shared_phones(records), "shared_ids": quality.shared_place_ids(records),
        "row_counts": quality.report_totals({
            "records": records.agg(F.count(F.lit(1)).alias("n")),
            "area_summary": published["area_summary"].filter(F.col("area") == reports.TOTAL).select(F.col("total").alias("n")),
            "group_area": published["group_area"].filter(F.col("grp") == reports.TOTAL).select(F.col("total").alias("n"))})}


def _publish(stages: Stages, records: DataFrame, last: str, profile: Profile, today: str) -> dict[str, DataFrame]:
    """Reports and checks of a run's finished records, stored."""
    tables: dict[str, DataFrame] = {}

    def made() -> dict[str, DataFrame]:
        if not tables:                                           # reports and checks read one count of the records
            tables.update(census_reports(records, profile, today) if profile.kind == "census" else prospect_reports(records, profile, today))
        return tables

    stored = stages.keep_all("reports", lambda: {k: _storable(v) for k, v in made().items()}, (last,), today)
    checks = stages.keep_all("checks", lambda: verify(records, profile, made()), ("reports",))
    return stored | {f"check_{k}": v for k, v in checks.items()}


def run(spark: SparkSession, records: DataFrame, profile: Profile, root: str, run_id: str, today: str, sites: DataFrame | None = None,
        details: DataFrame | None = None, answers: DataFrame | None = None, inputs: str = "") -> dict[str, DataFrame]:
    """A whole run from mapped records to reports and checks: stage by stage, each stored below root (`stages.Stages`).

    sites, details and answers are what enrichment found (`enrich_records`). `inputs` names the version of the records, if the files
    they are read from don't tell it. Started again after a crash, the run goes on at the first stage that isn't finished.
    """
    stages = Stages(spark, root, run_id, profile, inputs, files_of(records))
    placed = stages.keep("geo", lambda: place(records, profile, today), settings=today, canonical=True)
    ready = stages.keep("classify", lambda: classify(placed, profile), ("geo",), canonical=True)
    resolved: list[Resolution] = []

    def resolution() -> Resolution:
        if not resolved:
            resolved.append(Resolution(ready))
        return resolved[0]

    merged = stages.keep("dedupe", lambda: resolution().businesses().drop("n_sightings"), ("classify",), canonical=True)
    decisions = stages.keep("decisions", lambda: resolution().decisions(), ("classify",),
                            counts={"merged": F.count_if(F.col("action") == "merged"), "dropped": F.count_if(F.col("action") == "dropped")})
    conflicts = stages.keep("conflicts", lambda: resolution().conflicts(), ("classify",))
    found = [files_of(sites), files_of(details), files_of(answers)]
    enriched = stages.keep("enrich", lambda: enrich_records(merged, today, sites, details, answers), ("dedupe",), [today, found], canonical=True)
    kept = stages.keep("businesses", lambda: finish_businesses(enriched, profile)[0], ("enrich",), canonical=True)
    dropped = stages.keep("dropped_pois", lambda: finish_businesses(enriched, profile)[1], ("enrich",))
    out = {"classified": ready, "decisions": decisions, "conflicts": conflicts, "businesses": kept, "dropped_pois": dropped}
    last = "businesses"
    if profile.kind == "prospects":
        out["scored"], last = stages.keep("scored", lambda: score(kept), ("businesses",), canonical=True), "scored"
    return out | _publish(stages, out[last], last, profile, today)


def run_combined(spark: SparkSession, roots: list[str], profile: Profile, root: str, run_id: str, today: str) -> dict[str, DataFrame]:
    """Finished runs as one: the last records stage of each (scored ones, or businesses), merged, published and checked."""
    runs = [_last_stage(spark, r) for r in roots]
    stages = Stages(spark, root, run_id, profile, *[files_of(r) for r in runs])
    resolved: list[tuple[Resolution, DataFrame]] = []

    def both() -> tuple[Resolution, DataFrame]:
        if not resolved:
            resolved.append(combine(runs, profile))
        return resolved[0]

    kept = stages.keep("businesses", lambda: both()[1].drop("n_sightings"), canonical=True)
    decisions = stages.keep("decisions", lambda: both()[0].decisions())
    return {"businesses": kept, "decisions": decisions} | _publish(stages, kept, "businesses", profile, today)


def _last_stage(spark: SparkSession, root: str) -> DataFrame:
    done = {r["stage"] for r in read_metrics(spark, root).filter("state = 'done'").select("stage").collect()}      # one row per stage
    return read_stage(spark, root, "scored" if "scored" in done else "businesses")


def _storable(df: DataFrame) -> DataFrame:
    """Parquet refuses some characters in column names; report headings become plain names."""
    import re

    return df.toDF(*[re.sub(r"[^0-9A-Za-z_]+", "_", c).strip("_").lower() for c in df.columns])
