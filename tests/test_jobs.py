"""Whole jobs over the smallest test tables: invariants, checks that must fail, combined runs."""

import os

import pytest
from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS
from placebook.catalog import adapters as A
from placebook.operators import quality, reports
from placebook.plans import profiles
from placebook.plans.stages import Stages, read_metrics
from placebook.schema import RECORD, conform
from placebook.session import materialise

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(FOLDER), reason="test tables not here")


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    raw = A.sightings(spark, FOLDER)
    pois = raw.limit(3).withColumns({"ord": F.col("ord") + 10_000_000, "name": F.concat(F.lit("Oworo Bus Stop "), "ord"), "label": F.lit(""),
                                     "place_id": F.lit(""), "phone": F.lit(""), "phones_all": F.array().cast("array<string>")})
    nameless = raw.limit(2).withColumns({"ord": F.col("ord") + 20_000_000, "name": F.lit("The Ltd")})
    records = raw.unionByName(pois).unionByName(nameless)
    profile = profiles.census_profile()
    root = str(tmp_path_factory.mktemp("run"))
    return profile, profiles.run(spark, materialise(records, "mapped"), profile, root, "r1", "2026-12-01"), root


@needs_tables
def test_every_record_is_accounted_for(spark, job):
    _, out, root = job
    n = {k: out[k].count() for k in ("classified", "businesses", "dropped_pois")}
    actions = {r.action: r["count"] for r in out["decisions"].groupBy("action").count().collect()}
    assert n["classified"] == n["businesses"] + actions["merged"] + n["dropped_pois"] + actions["dropped"]
    assert actions["dropped"] == 2 and n["dropped_pois"] >= 1
    kpi = {r.kpi: r.value for r in out["kpis"].collect()}
    assert kpi["core"] + kpi["ring"] + kpi["outside"] + kpi["unassigned"] == kpi["total"] == n["businesses"]
    total = out["area_summary"].filter("area = 'TOTAL'").first().total
    assert total == out["group_area"].filter("grp = 'TOTAL'").first().total == n["businesses"]
    ids = sorted(r.ID for r in out["master"].select("ID").collect())
    assert ids == list(range(1, n["businesses"] + 1)) and len(out["master"].columns) == 37
    stored = spark.read.parquet(f"{root}/reports/kpis")
    assert stored.count() == 11 and spark.read.schema(RECORD).parquet(f"{root}/stages/businesses").count() == n["businesses"]
    noted = {r.stage: r for r in read_metrics(spark, root).collect()}
    assert noted["businesses"].counts["rows"] == n["businesses"] and noted["decisions"].counts["merged"] == actions["merged"]
    assert {r.state for r in noted.values()} == {"done"} and {r.run_id for r in noted.values()} == {"r1"}


@needs_tables
def test_checks_hold_and_fail_when_they_must(spark, job):
    profile, out, _ = job
    kept = out["businesses"]
    published = profiles.census_reports(kept, profile, "2026-12-01")
    checks = profiles.verify(kept, profile, published)
    assert checks["cells"].filter("not ok").count() == 0 and checks["cells"].select("tbl").distinct().count() == 6
    assert checks["row_counts"].filter("not ok").count() == 0
    problems = checks["schema"].first()
    assert problems.records == kept.count() and problems[1:] == (0, 0, 0, 0, 0)
    assert checks["shared_phones"].filter("not ok").count() == 0 and checks["shared_ids"].count() == 0
    # a number taken from the wrong column, a bad phone, an unknown category, a true duplicate
    wrong = published | {
        "kpis": published["kpis"].withColumn("value", F.when(F.col("kpi") == "phone", 0).otherwise(F.col("value"))),
        "tree_coverage": published["tree_coverage"].filter("found = 0 or grp <> 'Hospitality'")}
    cells = quality.reconcile_cells(quality.census_cells(wrong), quality.recount_cells(kept, profile.taxonomy, profile.areas, profile.core))
    bad = {(r.tbl, r.row, r.col): r for r in cells.filter("not ok").collect()}
    assert bad["kpis", "phone", "value"].published == 0 < bad["kpis", "phone", "value"].recount
    assert {k[1].split(" > ")[0] for k in bad if k[0] == "tree"} == {"Hospitality"} and {k[0] for k in bad} == {"kpis", "tree"}
    spoiled = kept.withColumns({"phone": F.when(F.col("ord") == kept.first().ord, "0803").otherwise(F.col("phone")),
                                "sub": F.when(F.col("grp") == "Hospitality", "Castles").otherwise(F.col("sub"))})
    found = quality.schema_problems(spoiled, profile.taxonomy, CENSUS_AREAS).first()
    assert found.bad_phone == 1 and found.unknown_sub > 0
    twin = kept.filter("phone != ''").limit(1)
    doubled = kept.unionByName(twin.withColumn("place_id", F.lit("")))
    assert quality.shared_phones(doubled).filter("not ok").count() == 1
    assert quality.unclassified_share(kept.withColumns({"grp": F.lit("Other Local Services"), "sub": F.lit("Unclassified (needs review)")})).first().ok is False


@needs_tables
def test_resolving_again_changes_little_and_never_grows(spark, job):
    """A second pass may still merge (keys differ once fields moved), but ids stay distinct."""
    from placebook.operators.resolve import Resolution
    _, out, _ = job
    once = out["businesses"].drop("n_sightings")
    again = Resolution(once)
    assert again.clusters.select("cluster").distinct().count() <= once.count()


@needs_tables
def test_a_run_that_died_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    records = materialise(A.sightings(spark, FOLDER).filter("ord % 20 = 0"), "mapped")
    profile, root = profiles.census_profile(), str(tmp_path / "run")
    finish, made = profiles.finish_businesses, []
    monkeypatch.setattr(profiles, "finish_businesses", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError, match="died"):
        profiles.run(spark, records, profile, root, "r1", "2026-12-01")
    before = {r.stage: r for r in read_metrics(spark, root).collect()}
    assert set(before) == {"geo", "classify", "dedupe", "decisions", "conflicts", "enrich"}
    monkeypatch.setattr(profiles, "finish_businesses", finish)
    monkeypatch.setattr(profiles, "Resolution", lambda *a: made.append("resolved"))
    out = profiles.run(spark, records, profile, root, "r2", "2026-12-01")
    after = {r.stage: r for r in read_metrics(spark, root).collect()}
    assert not made and all(after[s] == before[s] for s in before)                              # not run again
    assert {s for s, r in after.items() if r.run_id == "r2"} == {"businesses", "dropped_pois", "reports", "checks"}
    assert out["check_cells"].filter("not ok").count() == 0 and after["reports"].counts["master"] == out["businesses"].count()


def test_stages_are_kept_until_something_changes(spark, tmp_path):
    root, made = str(tmp_path / "run"), []

    def go(run_id, base="b", today="1"):
        made.clear()
        stages = Stages(spark, root, run_id, base)

        def make(name, n):
            made.append(name)
            return spark.range(n)

        one = stages.keep("one", lambda: make("one", 3), counts={"even": F.count_if(F.col("id") % 2 == 0)})
        two = stages.keep("two", lambda: make("two", 4), ("one",), today)
        some = stages.keep_all("some", lambda: {"x": make("x", 1), "y": make("y", 2)}, ("two",))
        assert (one.count(), two.count(), some["x"].count(), some["y"].count()) == (3, 4, 1, 2)
        return list(made)

    assert go("r1") == ["one", "two", "x", "y"] and go("r2") == []
    assert go("r3", today="2") == ["two", "x", "y"] and go("r4", today="2") == []
    assert go("r5", base="other", today="2") == ["one", "two", "x", "y"]
    counts = {r.stage: r.counts for r in read_metrics(spark, root).collect()}
    assert counts == {"one": {"rows": 3, "even": 2}, "two": {"rows": 4}, "some": {"x": 1, "y": 2}}


@needs_tables
def test_a_prospect_run_with_enrichment(spark, job, tmp_path):
    from placebook.catalog import queries as Q
    from placebook.operators import enrich
    from placebook.sources import place_details

    records = materialise(A.sightings(spark, FOLDER), "mapped")
    sites = materialise(enrich.site_contacts(A.site_pages(spark, FOLDER)), "sites")
    details = materialise(place_details.parse_details(A.details(spark, FOLDER)), "details")
    answers = materialise(place_details.latest_answers(A.api_answers(spark, FOLDER)), "answers")
    root = str(tmp_path / "prospects")
    out = profiles.run(spark, records, profiles.Profile("prospects", CENSUS_AREAS), root, "p1", Q.TODAY, sites, details, answers)
    scored = out["scored"]
    n = scored.count()
    assert n > 0 and scored.filter("score is null or delivery_category = 'Other'").count() == 0
    assert out["kpis"].filter("kpi = 'total'").first().value == n and out["targets"].count() == n
    assert out["check_cells"].filter("not ok").count() == 0 and out["check_cells"].select("tbl").distinct().count() == 5
    assert out["businesses"].filter("email <> ''").count() > 0                                 # enrichment took effect
    both = profiles.run_combined(spark, [job[2], root], profiles.combined_profile(), str(tmp_path / "both"), "b1", Q.TODAY)
    assert both["businesses"].filter("score is not null").count() > 0 and both["check_cells"].filter("not ok").count() == 0
    assert both["decisions"].filter("action = 'merged'").count() > 0


def test_combined_runs(spark):
    """A scored run leads, whatever its place in the list; a business of both keeps the score and the better place."""
    found = "OpenStreetMap (Oct 2026)"

    def run(rows):
        full = [{"source": found, "sources_all": [found], **r} for r in rows]
        return conform(spark.createDataFrame([tuple(r.get(f.name) for f in RECORD.fields) for r in full], RECORD))

    takeout = {"Service options": [{"Takeout": True}]}
    plain = run([{"ord": 7, "name": "Corner Bakery Obanikoro", "addr": "Yaba market", "phone": "+2348055550101"},
                 {"ord": 9, "name": "Tailor at the Gate", "lat": 6.5600, "lng": 3.3695}])
    rated = run([{"ord": 3, "name": "Corner Bakery Obanikoro", "addr": "8 Close, Ikoyi", "score": 55.5, "phone": "+2348055550101", "additional_info": takeout},
                 {"ord": 4, "name": "Night Kiosk", "addr": "nowhere", "score": 31.0}])
    _, out = profiles.combine([plain, rated], profiles.combined_profile())
    by_name = {r.name: r for r in out.collect()}
    assert sorted(by_name) == ["Corner Bakery Obanikoro", "Night Kiosk", "Tailor at the Gate"]
    bakery, tailor = by_name["Corner Bakery Obanikoro"], by_name["Tailor at the Gate"]
    assert (bakery.ord, bakery.score, bakery.area, bakery.zone) == (1, 55.5, "Ikoyi", "Ring area") and bakery.additional_info == takeout
    assert bakery.priority.startswith("C") and (tailor.ord, tailor.zone, tailor.score) == (4, "Core catchment", None)


def test_profiles_refuse_nonsense():
    with pytest.raises(ValueError):
        profiles.Profile("census", CENSUS_AREAS, ["Nowhere"])
    with pytest.raises(ValueError):
        profiles.Profile("census", CENSUS_AREAS, bands=(50, 40, 25))
    with pytest.raises(ValueError):
        profiles.Profile("census", CENSUS_AREAS, terms=[])
    with pytest.raises(TypeError):
        profiles.Profile("census", CENSUS_AREAS, concurency=4)


def test_reports_keep_empty_rows(spark):
    empty = conform(spark.createDataFrame([], "name string"))
    p = profiles.census_profile()
    assert reports.group_table(reports.census_cube(empty), p.taxonomy).count() == 30
    assert reports.research_matrix(reports.census_cube(empty), p.taxonomy, CENSUS_AREAS, p.core).filter("gap = target").count() == 7 * 29


def test_a_run_counts_its_records_once(spark, tmp_path, monkeypatch):
    """Reports and checks are made of one cube and one numbering of the businesses."""
    rows = [(i, f"Shop {i}", "Bar" if i % 2 else "", f"+23480300000{i:02d}", "Google Maps (sweep, Oct 2026)", 6.56, 3.37) for i in range(20)]
    records = conform(spark.createDataFrame(rows, "ord long, name string, label string, phone string, source string, lat double, lng double"))
    made = []
    for module, name in ((reports, "census_cube"), (profiles, "number_rows")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name: (made.append(n), f(*a))[1])
    out = profiles.run(spark, materialise(records, "few"), profiles.census_profile(), str(tmp_path / "run"), "r", "2026-12-01")
    assert sorted(made) == ["census_cube", "number_rows"]
    assert out["check_cells"].filter("not ok").count() == 0 and out["check_cells"].filter("published > 0").count() > 0
    assert {r.kpi: r.value for r in out["kpis"].collect()}["total"] == 20
