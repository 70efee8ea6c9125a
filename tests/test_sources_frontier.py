"""Source mappers, stored raw rows, search planning, streams."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS, Area, with_centres
from placebook.operators import centroids, frontier
from placebook.operators.enrich import most_reviewed
from placebook.operators.ordering import first_rows, number_rows
from placebook.schema import conform
from placebook.sources import csv_import, directories, map_cards, osm, raw_store

CARD = "ord int, aria string, href string, stars string, leaves array<string>, website string, _kind string, _fetched string"


def test_cards(spark):
    href = ("https://www.google.com/maps/place/x/data=!4m7!3m6!1s0x103b8d404baa79c5:0xfae86733a56b4a1b!8m2!3d6.547964!4d3.4007149!16s")
    rows = [
        (1, "Medplus", href, "4.3 stars", ["Medplus", "4.3", "Pharmacy", "·", "45A Ogudu Rd", "Open 24 hours", "·", "+234 908 335 4474", "", "Website", ""], "https://m.example/", "sweep", "2026-10-06"),
        (2, "X", "", "4.1 stars 1,234 Reviews", ["X", "Pharmacy", "·", "", "·", "4, Diya street Ifako", "Open", "· Closes 10 PM"], "https://www.google.com/x", "sweep", "2026-10-06"),
        (3, "Y", "", "", ["Y", "4.0(12)", "₦₦"], "", "sweep", "2026-10-06"),
        (4, "J", "", "", ["J", "4.7", "(6)", "No reviews", "Pharmacy", "·", "16 Ajayi St", "·", "+234 904 999 4999", ""], "", "sweep", "2026-10-06"),
        (5, "Mama Put", "", "", ["Mama Put", "4.1", "(9)", "₦1–10,000", "·", "Restaurant", "·", "3 Fixture St"], "", "top-up", "2026-10-06"),
        (6, " ", "", "", [], "", "sweep", "2026-10-06")]
    out = {r.ord: r for r in map_cards.map_cards(spark.createDataFrame(rows, CARD)).collect()}
    a = out[1]
    assert (a.label, a.addr, a.phone, a.rating, a.reviews) == ("Pharmacy", "45A Ogudu Rd", "+2349083354474", 4.3, None)
    assert (a.lat, a.lng, a.place_id) == (6.547964, 3.4007149, "0x103b8d404baa79c5:0xfae86733a56b4a1b")
    assert (out[2].reviews, out[2].addr, out[2].website) == (1234, "4, Diya street Ifako", "")
    assert out[3].label == "" and out[4].reviews == 6 and out[4].addr == "16 Ajayi St"
    assert out[5].label == "Restaurant" and out[5].source == "Google Maps (top-up, Oct 2026)" and 6 not in out


def test_elements(spark):
    ddl = f"{osm.ELEMENT}, _fetched string"
    rows = [("node", 1, 6.56, 3.37, None, {"shop": "yes", "name:en": "A", "phone": "0803 123 4567; 0805 987 6543", "addr:street": "F Road", "addr:housenumber": "5", "addr:city": "Lagos"}, "2026-10-06"),
            ("way", 2, None, None, (6.57, 3.38), {"amenity": "fast_food;x", "brand": "B", "mobile": "0803-123-456"}, "2026-10-06"),
            ("node", 3, 6.5, 3.3, None, {"shop": "x"}, "2026-10-06")]
    df = spark.createDataFrame(rows, ddl)
    out = {r.name: r for r in osm.map_osm(df).collect()}
    assert set(out) == {"A", "B"} and out["A"].label == "shop" and out["A"].addr == "5 F Road, Lagos"
    assert out["A"].phones_all == ["+2348031234567", "+2348059876543"] and out["B"].phone == ""
    assert (out["B"].lat, out["B"].label, out["B"].maps) == (6.57, "fast food", "https://www.openstreetmap.org/way/2")
    assert {r.id for r in osm.select_elements(df, "prospects", (6.0, 3.0, 7.0, 4.0)).collect()} == set()
    assert {r.id for r in osm.select_elements(df, "census", (6.0, 3.0, 7.0, 4.0)).collect()} == {1, 3}


def test_csv_files_and_ledger(spark, tmp_path):
    f = tmp_path / "walk.csv"
    f.write_text("﻿Business Name,Phone,ADDRESS,Category,E-Mail,Lat\nAde Shop,0803 123 4567 / 0805 987 6543,\"5 Road, Yaba\",Shop,a@b.example,abc\n,0803,x,y,z,1\n", encoding="utf-8")
    got = csv_import.map_csv(csv_import.read_files(spark, [str(f)])).collect()
    assert len(got) == 1 and got[0].phones_all == ["+2348031234567", "+2348059876543"] and got[0].email == "a@b.example"
    assert got[0].lat is None and got[0].source == "Manual CSV (walk.csv)" and got[0].sales_status == "Not Contacted"
    empty = spark.createDataFrame([], "term string")
    todo = csv_import.pending_files(spark, [str(f)], empty)
    assert todo.count() == 1 and todo.first().term.startswith("csv:walk.csv:")
    assert csv_import.pending_files(spark, [str(f)], todo.select("term")).count() == 0


BOX = ('<div class="box-682 bg-none"><div class="box-headings new"><span>1</span><a href="/listing/A-Health/103201/">A &amp; Health</a></div>'
       '<div><div class="cmpny-lstng-1"><img src="/images/bldng.png" alt="">Deji Street, Anthony Village</div>'
       '<div class="cmpny-lstng-1"><img src="/images/phone-2.png">0818 157 9000, 0805 307 2221</div></div><div class="listing-desc"><p>Care <b>here</b></p></div></div>')
COMPANY = ('<div class="company g_0" data-cmpid="9"><div class="company_header"><h3><a href="/company/9/x">New Name Ltd</a></h3>'
           '<div class="address">Yaba</div><div class="tagline">Phone repairs</div></div><div class="cont"><div class="s"><i class="fa fa-phone"></i><span>0803 123 4567</span></div>'
           '<div class="mapmarker" data-ltd="6.5" data-lng="3.3"></div></div>%s</div>')


def pages(spark, rows):
    return spark.createDataFrame(rows, "site string, page_no int, url string, html string")


def test_directory_pages_with_odd_markup(spark):
    home = "https://www.finelib.com/x/y"
    links = ("<div class='wide category-list'><div><ul>" + "<li><p>open" * 2000 + "<a href='/x/y/a&amp;b'>1</a></ul></div><a href=/x/y/c>2</a></div>"
             "<a href='/x/y/outside'>3</a>")
    df = pages(spark, [("finelib", 1, home, links + BOX), ("finelib", 2, home + "/2", None), ("elsewhere", 3, "https://e", "<p>")])
    assert [r.link for r in directories.category_links(df).orderBy("pos").collect()] == [home + "/a&b", home + "/c"]
    assert directories.parse_listings(df).count() == 1
    assert [(r.url, r.error) for r in directories.unreadable_pages(df).collect()] == [("https://e", "KeyError: 'elsewhere'")]


def test_directory_layouts(spark):
    area = "https://www.finelib.com/cities/lagos/areas-and-suburbs/anthony-village"
    links = '<div class="category-list newlist"><ul><li><a href="/cities/lagos/areas-and-suburbs/anthony-village/health-services">x</a></li><li><a href="/other">y</a></li></ul></div>'
    df = pages(spark, [("finelib", 1, area + "/health-services", "<div class='box-682'>no</div>" + BOX),
                       ("businesslist", 2, "https://b/2", COMPANY % "" + COMPANY % "<i>Sponsored</i>"),
                       ("businesslist", 3, "https://b/3", '<div class="company"><div class="company_header"><h4>changed</h4></div></div>'),
                       ("finelib", 0, area, links)])
    got = directories.parse_listings(df)
    rows = got.orderBy("site", "page_no", "pos").collect()
    assert len(rows) == 3 and rows[2].name == "A & Health" and rows[2].listing_id == "103201" and rows[2].category == "health services"
    assert rows[2].url == "https://www.finelib.com/listing/A-Health/103201/" and rows[2].desc == "Care here"
    assert rows[0].lat == "6.5" and [r.sponsored for r in rows[:2]] == [False, True]
    assert directories.drop_sponsored(got).count() == 2
    assert [r.url for r in directories.broken_pages(df, got).collect()] == ["https://b/3"]
    assert [r.link for r in directories.category_links(df).collect()] == [area + "/health-services"]
    recs = directories.map_listings(got.withColumn("_fetched", F.lit("2026-10-06"))).collect()
    fl = next(r for r in recs if r.source.startswith("Finelib ("))
    assert fl.phones_all == ["+2348181579000", "+2348053072221"] and fl.lat is None and fl.label == "health services"


def test_a_listing_crawled_again_supersedes(spark):
    rows = [(1, "businesslist", "9", "Old Name"), (2, "businesslist", "9", "New Name"), (3, "businesslist", "", "Keyless"), (4, None, "9", "Keyless 2")]
    out = directories.latest_listing(spark.createDataFrame(rows, "ord bigint, site string, listing_id string, name string"))
    assert {r.name for r in out.collect()} == {"New Name", "Keyless", "Keyless 2"}


def test_latest_listing_parses_pages_once(spark):
    pages = spark.createDataFrame([("finelib", 1, "u", "<html></html>")], "site string, page_no int, url string, html string")
    raw = directories.parse_listings(pages).withColumn("ord", F.col("page_no").cast("bigint"))
    plan = directories.latest_listing(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    # rows without an id stay, equal ones and those without a number too; of an id whose rows have no number nothing is known
    rows = [(None, "a", None, "x"), (None, "a", None, "x"), (5, "", "7", "y"), (5, None, "7", "y"), (1, "a", "7", "old"), (2, "a", "7", "new"),
            (None, "a", "7", "none"), (None, "b", "7", "z")]
    out = directories.latest_listing(spark.createDataFrame(rows, "ord bigint, site string, listing_id string, name string"))
    assert out.columns == ["site", "listing_id", "ord", "name"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        ("a", None, None, "x"), ("a", None, None, "x"), ("", "7", 5, "y"), (None, "7", 5, "y"), ("a", "7", 2, "new"), ("b", "7", None, None)], key=str)


def test_raw_rows_and_stages(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a",), ("b",)], "name string").coalesce(1)
    raw_store.append_raw(rows, root, "osm", 1)
    raw_store.append_raw(rows, root, "osm", 0)
    raw_store.append_raw(rows, root, "osm", 1)                       # a retried batch replaces itself
    raw = {s: raw_store.read_raw(spark, root, s, rows.schema) for s in ("osm", "directories")}
    assert raw["osm"].count() == 4 and raw["directories"].count() == 0
    ordered = raw_store.in_run_order(raw)["osm"].orderBy("ord").collect()
    assert [(r.ord, r.batch, r.name) for r in ordered] == [(1, 0, "a"), (2, 0, "b"), (3, 1, "a"), (4, 1, "b")]
    with pytest.raises(ValueError):
        raw_store.write_stage(rows.withColumn("nonsense", F.lit(1)), root, "geo")
    raw_store.write_stage(rows, root, "geo")
    assert raw_store.read_stage(spark, root, "geo").count() == 2
    assert conform(rows).first().sales_status == "Not Contacted"


def test_numbering_in_parallel(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"))
    got = [(r.v, r.n) for r in number_rows(df, [F.col("v")], "n").collect()]
    assert sorted(got) == [(i, i + 1) for i in range(1000)]


def test_centroids_are_medians(spark):
    rows = [(6.5 + i / 1000, 3.3, "1 Road, Alpha, Lagos", "Google Maps") for i in range(21)]
    rows += [(9.9, 9.9, "Alpha and Beta", "Google Maps")] * 3 + [(1.0, 1.0, "Alpha", "OpenStreetMap")] * 50
    df = conform(spark.createDataFrame(rows, "lat double, lng double, addr string, source string"))
    areas = [Area("Alpha / Al"), Area("Beta"), Area("Gamma"), Area("Drawn", polygon=((0, 0), (0, 1), (1, 1)))]
    got = {r.area: r for r in centroids.derive_centroids(df, areas).collect()}
    assert set(got) == {"Alpha / Al", "Beta", "Gamma"}
    assert (got["Alpha / Al"].n, got["Alpha / Al"].lat, got["Alpha / Al"].low_confidence) == (24, 6.5115, False)
    assert (got["Beta"].n, got["Beta"].low_confidence, got["Gamma"].n, got["Gamma"].lat) == (3, True, 0, None)
    new = with_centres(areas, [r.asDict() for r in got.values()])
    assert new[0].kind == "disc" and new[0].radius_km == 1.3 and new[2].kind == "name" and new[3].kind == "polygon"
    south, west, north, east = centroids.catchment_box(CENSUS_AREAS, 0)
    assert all(south <= a.lat <= north and west <= a.lng <= east for a in CENSUS_AREAS)


LOG = "event_id bigint, source string, term string, area string, status string, raw_count int, error string, happened_at string"


def test_search_states_and_splits(spark):
    g, view = "gmaps_browser", "sweep 6.5600,3.3700,14z"
    rows = [(1, g, "pharmacy", view, "running", None, "", "t1"), (2, g, "pharmacy", view, "done", 120, "", "t2"),
            (3, g, "church", view, "done", 37, "", "t3"), (4, g, "bar", view, "running", None, "", "t4"),
            (5, g, "shop", "sweep 6.5600,3.3700,17z", "done", 120, "", "t5")]
    searches = frontier.current_searches(spark.createDataFrame(rows, LOG))
    assert {r.term: r.status for r in searches.collect()} == {"pharmacy": "done", "church": "done", "bar": "pending", "shop": "done"}
    kids = frontier.saturation_plan(searches, None)
    assert kids.count() == 4 and {r.term for r in kids.collect()} == {"pharmacy"} and all(r.area.endswith("15z") for r in kids.collect())
    # a quarter that hit the cap too is split again
    first = sorted(r.area for r in kids.collect())[0]
    more = rows + [(6, g, "pharmacy", first, "done", 130, "", "t6")]
    areas = [r.area for r in frontier.saturation_plan(frontier.current_searches(spark.createDataFrame(more, LOG)), None).collect()]
    assert len(areas) == 8 and sum(a.endswith("16z") for a in areas) == 4
    plan = frontier.sweep_plan(spark.createDataFrame([("pharmacy",), ("bar",)], "term string"), [(6.56, 3.37, 14)])
    assert [r.term for r in frontier.pending(plan, searches).collect()] == ["bar"]


def test_quarters_outside_the_catchment_are_skipped(spark):
    s = spark.createDataFrame([("g", "x", "sweep 6.5613,3.3721,15z"), ("g", "y", "topup Gbagada @6.5613,3.3721,15z")], "source string, term string, area string")
    got = {r.term: r.area for r in frontier.split_searches(s, (6.570, 3.390, 6.580, 3.400)).collect()}
    assert got == {"x": "sweep 6.5695,3.3868,16z", "y": "topup Gbagada @6.5695,3.3868,16z"}


def test_running_best_over_parts(spark):
    rng = random.Random(5)
    ids = sorted({int(10 ** rng.uniform(0, 15)) for _ in range(400)})                # gaps of any width, one term with nine rows of ten
    rows = [(i, rng.choice(["a"] * 9 + ["b", None]), rng.choice([None, 0, 1, 2, 5, rng.randrange(1 + n)])) for n, i in enumerate(ids)]
    best, want = {}, {}
    for i, term, count in rows:
        want[i] = best.get(term, 0)
        best[term] = max(best.get(term, 0), count or 0)
    df = spark.createDataFrame(rows, "event_id bigint, term string, raw_count int").repartition(7)
    with_parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")         # as many parts as a large log has
    try:
        got = frontier.running_best(df)
        assert got.columns == ["event_id", "term", "raw_count", "before"] and {r.event_id: r.before for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_parts)
    assert frontier.running_best(df.limit(0)).count() == 0


def test_first_rows_of_a_budget(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, None, 0, 0, 0, 3, 7, rng.randrange(50)])) for i in rng.sample(range(10_000), 300)]
    df = spark.createDataFrame(rows, "ord bigint, reviews bigint")
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for n in (-1, 0, 1, 7, 150, 299, 300, 301):
        got = first_rows(df, most_reviewed(), n)
        assert sorted(r.ord for r in got.collect()) == sorted(o for o, _ in order[:max(n, 0)])
    assert "TakeOrdered" not in first_rows(df, most_reviewed(), 150)._jdf.queryExecution().toString()


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    from placebook.streaming import ingest
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = spark.createDataFrame([], "k string, at int, v string").schema

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        ingest.append_log(ingest.read_files(spark, src, schema), out, mark).awaitTermination()

    feed([("a", 1, "old"), ("b", 1, "x")])
    feed([("a", 2, "new")])
    ingest.append_log(ingest.read_files(spark, src, schema), out, mark).awaitTermination()      # nothing new: no batch
    log = spark.read.parquet(out)
    assert log.count() == 3
    assert {(r.k, r.v) for r in ingest.current_rows(log, ["k"], ["at"]).collect()} == {("a", "new"), ("b", "x")}
    ingest.compact(spark, out, str(tmp_path / "compact"), ["k"], ["at"])
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2


def test_medians_of_large_groups(spark):
    import random
    import statistics

    from placebook.operators.medians import medians
    rng = random.Random(3)
    rows = [("even", rng.uniform(-7, 7)) for _ in range(400)] + [("odd", round(6.5 + rng.random() / 50, 5)) for _ in range(301)]
    rows += [("one", 3.25), ("same", 1.0), ("same", 1.0), ("same", 2.0), ("far", -80.0), ("far", 80.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.median, r.n) for r in medians(df, "k", "v").collect()}
    for k in {k for k, _ in rows}:
        vs = [v for key, v in rows if key == k]
        assert abs(got[k][0] - statistics.median(vs)) < 1e-12 and got[k][1] == len(vs)


def test_a_table_of_latest_rows(spark, tmp_path):
    """Late rows, equal keys in one batch, a batch run twice, a second stream that numbers its batches from 0 again."""
    import shutil

    from placebook.streaming import ingest
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = spark.createDataFrame([], "k string, at int, v string").schema

    def feed(rows, where=src):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where)

    def go(where=src, checkpoint=mark):
        ingest.upsert_latest(ingest.read_files(spark, where, schema), out, checkpoint, ["k"], ["at", "v"], 4).awaitTermination()
        return {r.k: (r.at, r.v) for r in ingest.read_current(spark, out).collect()}

    feed([("a", 5, "five"), ("a", 5, "tie"), ("b", 1, "x"), (None, 1, "no key")])
    assert go() == {"a": (5, "tie"), "b": (1, "x"), None: (1, "no key")}
    feed([("a", 4, "late"), ("b", 2, "y"), ("c", 1, "z")])
    want = {"a": (5, "tie"), "b": (2, "y"), "c": (1, "z"), None: (1, "no key")}
    assert go() == want
    files = lambda: sorted(str(f) for f in (tmp_path / "out" / "current").rglob("*.parquet"))
    before = files()
    def lose() -> None:
        for name in ("1", ".1.crc"):
            (tmp_path / "mark" / "commits" / name).unlink()

    lose()                                                                            # written, but the stream didn't know
    assert go() == want and files() == before                                         # the marker kept it from doing it again
    lose()
    shutil.rmtree(tmp_path / "out" / "applied" / f"stream={ingest.stream_name(mark)}" / "batch=1")
    assert go() == want and files() != before                                         # without one it is done again, to the same end
    feed([("b", 3, "other stream")], str(tmp_path / "in2"))
    assert go(str(tmp_path / "in2"), str(tmp_path / "mark2"))["b"] == (3, "other stream")
    assert ingest.apply_batch(spark.createDataFrame([], schema), out, "stream=empty/batch=0", ["k"], ["at", "v"], 4)


def test_search_states_go_on_from_the_checkpoint(spark, tmp_path):
    from placebook.streaming import ingest
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = spark.createDataFrame([], "source string, term string, area string, status string, happened_at int, event_id long").schema

    def feed(*rows):
        spark.createDataFrame([("s", *r) for r in rows], schema).coalesce(1).write.mode("append").parquet(src)
        ingest.keep_states(ingest.search_states(ingest.read_files(spark, src, schema)), out, mark, 2).awaitTermination()
        return {(r.term, r.area): r.status for r in ingest.read_current(spark, out).collect()}

    assert feed(("t", "a", "running", 1, 1), ("t", "b", "done", 5, 2)) == {("t", "a"): "running", ("t", "b"): "done"}
    assert feed(("t", "a", "error", 1, 3), ("t", "b", "running", 4, 9)) == {("t", "a"): "error", ("t", "b"): "done"}       # equal times: the later event
    assert feed(("t", "a", "stale", 1, 2)) == {("t", "a"): "error", ("t", "b"): "done"}


def test_a_page_that_cannot_be_read_stops_no_link(spark, monkeypatch):
    import time

    from placebook.sources import directories
    ok = '<div class="category-list"><a href="/x/food">Food</a><a href="/x/food">again</a></div>'
    pages = spark.createDataFrame([("https://s.example/x", ok), ("https://s.example/y", '<div class="category-list"><a href="/y/z"'), ("u", None)], "url string, html string")
    assert [(r.url, r.pos) for r in directories.category_links(pages).collect()] == [("https://s.example/x", 0)]
    assert directories.unreadable_links(pages).count() == 0
    start = time.monotonic()
    page = directories._Page("<b>" * 20_000 + "<i>" + "</u></i>" * 20_000)           # closing tags that close nothing, on a deep page
    assert page.root[2] and time.monotonic() - start < 5


def test_pages_come_out_in_bounded_batches(monkeypatch):
    """However many pages a task gets in one batch, it hands listings on page by page."""
    monkeypatch.setattr(directories, "BATCH_ROWS", 3)
    read = 0

    class Pages:
        def select(self, *_):
            return self

        def filter(self, _):
            return self

        def mapInArrow(self, fn, schema):
            return fn

    monkeypatch.setattr(directories.F, "contains", lambda *_: None)
    columns = {"finelib": ["finelib"] * 50, "page_no": list(range(50)), "url": ["https://x"] * 50, "html": [BOX + BOX] * 50}
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=["site", "page_no", "url", "html"])
    monkeypatch.setitem(directories._LAYOUTS, "finelib", lambda html, parse=directories._LAYOUTS["finelib"]: _counted(parse(html)))

    def _counted(rows):
        nonlocal read
        read += 1
        return rows

    out = directories._read_pages(Pages())(iter([batch]))
    first = next(out)
    assert first.num_rows == 4 and read == 2                     # two pages of two listings, not all fifty
    assert first.num_rows + sum(b.num_rows for b in out) == 100
    links = '<div class="category-list">' + "".join(f'<a href="/{i}">x</a>' for i in range(4)) + "</div>"
    found = list(directories._read_links(Pages())(iter([pa.RecordBatch.from_arrays([pa.array(["u"] * 5), pa.array([links] * 5)], names=["url", "html"])])))
    assert [b.num_rows for b in found] == [4] * 5
