"""Cleaning, geometry and classification, case by case."""

import re
import unicodedata

from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS, CENSUS_CORE, PROSPECT_AREAS, Area, load_areas
from placebook.functions import geo, rules, text
from placebook.functions.provenance import source_kind, trust
from placebook.schema import CORE_ZONE, OUTSIDE, RING_ZONE, UNASSIGNED
from placebook.taxonomy import GROUPS, Taxonomy

import pytest


def table(spark, rows, ddl, **cols):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*[c.alias(n) for n, c in cols.items()]).collect()]


def test_phones(spark):
    mobile = "+2349071112233"
    cases = [(x, mobile) for x in ("0907 111 2233", "+234-907-111-2233", "(0907) 1112233", "Tel. 0907.111.2233", "09071112233 or 0802 000 0000")]
    cases += [(x, "") for x in ("", None, "none", "0907 111 223", "+44 20 7946 0000")]
    got = table(spark, [(c,) for c, _ in cases], "raw string", p=text.clean_phone("raw"))
    assert [g[0] for g in got] == [want for _, want in cases]


def test_names_and_addresses(spark):
    rows = [("Medplus Pharmacy Nigeria Ltd", "No 5, Fixture Road"), ("MEDPLUS PHARMACY", "5 Fixture Rd"),
            ("The Fixture Ventures & Global Services", "Shop 4 12 Ikorodu Road, Anthony"),
            ("Café Ünïted ﬁne ½ A™B–c", "19c Sylvia Cres, Anthony, Lagos")]
    got = table(spark, rows, "n string, a string", n=text.norm_name("n"), a=text.norm_addr("a"), s=text.street_of("a"))
    assert got[0][:2] == got[1][:2] == ("medplus pharmacy", "5 fixture")
    assert got[2][0] == "fixture" and got[2][2] == "12 Ikorodu Road"
    assert got[3][0] == "cafe united fine 12 atmbc" and got[3][2] == "19c Sylvia Cres"


def test_landmarks_need_an_empty_label(spark):
    rows = [("Iyana Oworo (Car Wash) Bus Stop", ""), ("Sylvia Crescent", ""), ("Bus Stop Pharmacy", "Pharmacy"), ("Roundabout Grill", "Restaurant")]
    got = table(spark, rows, "n string, l string", r=text.poi_reason("n", "l"))
    assert [bool(g[0]) for g in got] == [True, True, False, False]


def test_slugs_and_months(spark):
    got = table(spark, [("Anthony / Anthony Village", "2026-10-06")], "a string, d string",
                s=text.slugs(F.col("a"), F.array(F.lit("Lekki Ph. 1"))), m=text.month_label("d"))
    assert got == [(["anthony", "anthony-village", "lekki-ph-1"], "Oct 2026")]


def test_areas(spark):
    rows = [(6.5600, 3.3695, ""), (6.5723, 3.3670, "Ikeja"), (6.6200, 3.3000, ""), (None, None, "12 Ikorodu Rd, Anthony Village, Lagos"),
            (None, None, "Mende, Maryland"), (None, None, "Somewhere, Lagos")]
    got = table(spark, rows, "lat double, lng double, addr string", a=geo.assign_area("lat", "lng", "addr", CENSUS_AREAS)["area"])
    assert [g[0] for g in got] == ["Anthony / Anthony Village", "Maryland / Mende", OUTSIDE, "Anthony / Anthony Village",
                                   "Maryland / Mende", UNASSIGNED]
    rows = [(6.4685, 3.5720, ""), (6.4370, 3.5320, ""), (6.4470, 3.4720, ""), (6.4700, 3.5300, "")]
    got = table(spark, rows, "lat double, lng double, addr string", a=geo.assign_area("lat", "lng", "addr", PROSPECT_AREAS)["area"])
    assert [g[0] for g in got] == ["Lekki-Epe Corridor to Ajah"] * 2 + ["Lekki Phase 1", OUTSIDE]


def test_corridor_and_names_without_geometry(spark):
    areas = [Area("Strip", corridor=((6.44, 3.47), (6.47, 3.57), 2.0)), Area("Ikeja / GRA")]
    rows = [(6.455, 3.52, ""), (6.50, 3.52, ""), (6.50, 3.52, "3 Road, gra"), (6.50, 3.52, "Grape Street")]
    got = table(spark, rows, "lat double, lng double, addr string", a=geo.assign_area("lat", "lng", "addr", areas)["area"])
    assert [g[0] for g in got] == ["Strip", OUTSIDE, "Ikeja / GRA", OUTSIDE]


def test_nearest_decides_before_inside(spark):
    areas = [Area("Small", 0.0, 0.0, 0.1), Area("Wide", 0.03, 0.0, 10.0)]
    got = table(spark, [(0.01, 0.0)], "lat double, lng double", a=geo.assign_area("lat", "lng", F.lit(""), areas)["area"])
    assert got == [(OUTSIDE,)]           # inside the wide one, but nearer to the small one


def test_zones_and_registry(spark):
    got = table(spark, [("Ojota",), (CENSUS_CORE[0],), (OUTSIDE,)], "a string", z=geo.zone_of("a", CENSUS_CORE))
    assert [g[0] for g in got] == [RING_ZONE, CORE_ZONE, OUTSIDE]
    with pytest.raises(ValueError):
        Area("x", 1.0, 2.0, 1.0, polygon=((0, 0), (0, 1), (1, 1)))
    with pytest.raises(ValueError):
        Area("x", 1.0, None)
    with pytest.raises(TypeError):
        load_areas('{"x": {"lattitude": 1}}')
    assert load_areas('{"x": {"corridor": {"from": [1, 2], "to": [3, 4], "width_km": 2}}}')[0].kind == "corridor"


def test_sources(spark):
    rows = [("Google Places API (Oct 2026)",), ("Google Maps (sweep)",), ("OpenStreetMap",), ("Finelib (Oct 2026)",), ("Manual CSV (a.csv)",),
            ("Multiple sources (cross-verified)",)]
    got = table(spark, rows, "s string", k=source_kind("s"), t=trust("s"))
    assert got == [("places_api", 5), ("gmaps", 4), ("osm", 3), ("directory", 2), ("manual", 1), ("manual", 1)]


def test_classifier_order_and_slash(spark):
    t = Taxonomy.starter()
    rows = [("Bar/Lounge", "x"), ("Barber shop", ""), ("", "red widget"), ("Provision store", ""), ("", "City Park")]
    got = table(spark, rows, "l string, n string", c=rules.classify("l", "n", t)["sub"], g=rules.legacy_category("l", "n", t))
    assert got == [("Lounges", "Event Businesses"), ("Barbers", "Barbers"), ("Unclassified (needs review)", ""),
                   ("Provision Stores", "Supermarkets"), ("Recreation Centres", "")]
    assert len(t.groups) == len(GROUPS) == 29
    assert {(g, s) for g, s, _ in t.rules} <= set(t.tree)


def test_taxonomy_from_files(spark, tmp_path):
    (tmp_path / "tree.csv").write_text("ord,grp,sub\n1,B,b\n0,A,a\n")
    (tmp_path / "rules.csv").write_text('ord,grp,sub,key\n1,B,b,"x"\n0,A,a,"x y"\n')
    (tmp_path / "legacy.csv").write_text("ord,category,key\n0,L,x\n")
    (tmp_path / "terms.csv").write_text("ord,grp,term\n0,A,Foo\n1,B,foo\n")
    t = Taxonomy.load(spark, str(tmp_path))
    assert t.tree == [("A", "a"), ("B", "b")] and t.rules == [("A", "a", "x y"), ("B", "b", "x")]
    assert [r.term for r in t.terms_df(spark).collect()] == ["Foo"]
    got = table(spark, [("x y", ""), ("x", "z")], "l string, n string", c=rules.classify("l", "n", t)["sub"])
    assert got == [("a",), ("b",)]


def test_rule_text_and_names_with_and_without_odd_blanks(spark):
    """Plain texts take a short way; it gives what the pattern for every kind of blank gives."""
    names = ["", " ", "a b", "a  b", " a/b ", "a\tb", "a\u00a0b", "a\u2003 b", "é x", "a_b", "_a  _ b_", "the a", "Ltd", "a - the - b", "x_the y", "..", "_"]
    out = table(spark, [(x, y) for x in names for y in (None, "", " L/M ")], "name string, label string",
                name=F.col("name"), label=F.col("label"), text=rules.rule_text("label", "name"), nn=text.norm_name("name"))
    drop = set(text.COMPANY_WORDS)
    for name, label, got, nn in out:
        plain = f"{label or ''} {name}".lower().replace("/", " ")
        assert got == " " + re.sub(r"\s+", " ", plain) + " ", (name, label)
        ascii_ = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if ord(c) < 128)
        kept = " ".join(w for w in re.split("[^a-z0-9_]+", ascii_) if w not in drop)
        assert nn == re.sub("[ _]+", " ", kept).strip(" "), name
