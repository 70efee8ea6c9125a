"""Areas, rules and references against the forms that try everything, on random data and on odd cases."""

import html
import random

import pytest
from pyspark.sql import functions as F

from placebook.areas import Area
from placebook.functions import geo, rules
from placebook.functions.contacts import unescape
from placebook.operators import area_index, key_index, rule_index
from placebook.schema import conform
from placebook.taxonomy import Taxonomy


def some_areas(rng, n):
    out = []
    for i in range(n):
        y, x, near = 6.4 + rng.random() * .3, 3.3 + rng.random() * .3, lambda d: rng.uniform(-d, d)
        if i % 6 == 0:
            out.append(Area(f"C{i}", corridor=((y, x), (y + near(.05), x + near(.05)), rng.uniform(.3, 3))))
        elif i % 6 == 1:
            out.append(Area(f"P{i} / Pol {i}", polygon=tuple((y + near(.04), x + near(.04)) for _ in range(rng.randint(3, 7)))))
        elif i % 6 == 2:
            out.append(Area(f"N{i}", aliases=(f"Long name {i}", "Shared (x)")))
        else:
            out.append(Area(f"D{i}", y, x, rng.uniform(.1, 2)))
    one = out[3]
    return out + [Area("Same centre", one.lat, one.lng, 9.0), Area("No length", corridor=((6.5, 3.4), (6.5, 3.4), 1.0)),
                  Area("Whole land", polygon=((4.0, 2.0), (4.0, 15.0), (14.0, 15.0), (14.0, 2.0)))]


@pytest.mark.parametrize("n, land", [(60, True), (120, False)])
def test_area_index_agrees_with_the_expression(spark, n, land):
    rng = random.Random(n)
    areas = some_areas(rng, n)[:None if land else -1]
    said = ["N8", "n2", "D3", "Pol 7", "long NAME 14", "shared (x)", "C0", "nothing", "no length", "N2x"]
    rows = [(i, None if i % 9 == 0 else rng.choice([6.4 + rng.random() * .3, rng.uniform(-80, 80), areas[3].lat]),
             None if i % 11 == 0 else rng.choice([3.3 + rng.random() * .3, rng.uniform(-180, 180), areas[3].lng]),
             rng.choice([f"no 1, {rng.choice(said)} st", "", "DD3 x", "d9."]), i) for i in range(900)]
    df = spark.createDataFrame(rows + rows[:3], "ord long, lat double, lng double, addr string, any long")
    index = area_index.build(area_index.registry(spark, areas))
    got = {r.ord: r.placed for r in area_index.assign(df, index).collect()}
    want = {r.ord: r.a for r in df.select("ord", geo.assign_area("lat", "lng", "addr", areas).alias("a")).collect()}
    assert {k: v.area for k, v in got.items()} == {k: v.area for k, v in want.items()}
    held = {k for k, v in got.items() if v.distance_km is not None}
    assert held and all(got[k].distance_km == want[k].distance_km for k in held)
    assert area_index.assign(df, index).count() == len(rows) + 3 and area_index.assign(df.limit(0), index).count() == 0
    nothing = area_index.build(area_index.registry(spark, areas).limit(0))
    assert {r.placed.area for r in area_index.assign(df, nothing).collect()} == {"Outside catchment", "Unassigned"}


def test_key_index_finds_all_and_only_what_is_there(spark):
    rng = random.Random(3)
    letters = "ab cé"
    texts = ["", *{"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(200)}]
    keys = ["", None, "a", "éa", *["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(60)]]
    t = spark.createDataFrame([(x,) for x in [*texts, None]], "text string")
    k = spark.createDataFrame(list(enumerate(keys)), "ord int, key string")
    got = {(r.text, r.ord) for r in key_index.matches(t, k).collect()}
    assert got == {(x, i) for x in texts for i, y in enumerate(keys) if y is not None and y in x}
    first = {r.text: r.ord for r in key_index.first_match(t, k.filter("key <> ''"), "ord").collect()}
    assert first == {x: min(i for i, y in enumerate(keys) if y and y in x) for x in texts if any(y and y in x for y in keys)}
    assert key_index.matches(t, k.limit(0)).count() == 0 and key_index.matches(t.limit(0), k).count() == 0


def test_keys_that_share_short_runs_meet_few_texts(spark, monkeypatch):
    """Whatever shares its rarest run is let through here: a text meets its own key, not those with some of the same digits."""
    keys = spark.range(300).select(F.concat(F.lit("shop "), (F.col("id") * 7 + 10_000).cast("string")).alias("key"))
    monkeypatch.setattr(key_index.F, "contains", lambda a, b: F.lit(True))
    assert key_index.matches(keys.select(F.concat("key", F.lit(" ltd")).alias("text")), keys).count() == 300


def test_word_index_finds_names_between_word_ends(spark, monkeypatch):
    """Every name that stands in a text as words, whatever their case; and only texts that share a rare word meet a name."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aßéİıſK") for _ in range(rng.randint(1, 2)))
    names = ["", "--", "(x)", "a-é", *{" ".join(word() for _ in range(rng.randint(1, 2))) for _ in range(60)}]
    texts = ["", "--", "a -- é (x) b", *{rng.choice([", ", " ", "-"]).join(word() for _ in range(rng.randint(1, 5))) for _ in range(300)}]
    k = spark.createDataFrame(list(enumerate(names)), "ord int, name string").withColumn("folded", F.lower("name")).withColumn(
        "pattern", F.concat(F.lit(r"(?iU)\b"), F.regexp_replace("name", r"([^\p{L}\p{N}\s])", r"\\$1"), F.lit(r"\b")))
    t = spark.createDataFrame([(x,) for x in texts], "text string").withColumn("low", F.lower("text"))
    ends = F.rlike(F.col("text"), F.col("pattern"))
    want = {(r.text, r.ord) for r in key_index.matches(t, k, "low", "folded").filter(ends).collect()}
    assert len(want) > 100 and {(r.text, r.ord) for r in key_index.word_matches(t, k, "low", "folded").filter(ends).collect()} == want
    estates = spark.range(500).select(F.concat(F.lit("estate "), (F.col("id") + 100_000).cast("string")).alias("key"))
    # whatever shares its rarest word is let through here: a text meets one name, not all that share "estate"
    monkeypatch.setattr(key_index.F, "contains", lambda a, b: F.lit(True))
    said = estates.select(F.concat(F.lit("no 1, "), "key", F.lit(" road")).alias("text"))
    assert key_index.word_matches(said, estates).count() == 500


def test_rule_index_agrees_with_the_expression(spark):
    rng = random.Random(5)
    stems = ["ba", "ker", "y sho", "/p", "park ", "É", "-x", "n"]
    word = lambda n: "".join(rng.choice(stems) for _ in range(rng.randint(1, n)))
    t = Taxonomy(tree=[], rules=[(f"G{i % 5}", f"S{i}", word(4).upper()) for i in range(70)] + [("Other Local Services", "Unclassified (needs review)", "n")],
                 legacy=[(f"L{i}", rng.choice(["", " "]) + word(3).lower()) for i in range(40)], terms=[])
    rows = [(i, word(3), rng.choice(["", word(3)]), rng.choice(["Finelib (x)", "Google Maps"]), rng.choice(["", word(5)]), rng.choice(["", "Kept"])) for i in range(300)]
    df = conform(spark.createDataFrame(rows, "ord long, name string, label string, source string, notes string, legacy18 string"))
    got = {r.ord: (r.grp, r["sub"], r.legacy18) for r in rule_index.classify_records(df, t.rules_df(spark), t.legacy_df(spark)).collect()}
    want = {r.ord: (r.grp, r["sub"], r.legacy18) for r in rules.classify_records(df, t).collect()}
    assert got == want and len({v for v in got.values()}) > 10


def test_references_are_decoded_as_browsers_do(spark):
    rng = random.Random(7)
    bits = ["&", "&amp", "&amp;", "&lt", "&notit;", "&copy", ";", "&#", "&#x", "&#65;", "&#x41", "&#0;", "&#128;", "&#129", "&#xD800;", "&#1114112;", "&#13;",
            "&#x1F600;", "&#99999999999999999999;", "&NotEqualTilde;", "&nosuch;", "&#xFFFF;", "&#11;", "&#127", "&ThickSpace;", "x", " ", "<b>", "é", "1", "&#x;", "&;", "&apos;", "&#00000065;"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", unescape("t").alias("u"))
    assert all(r.u == (html.unescape(r.t) if r.t is not None else None) for r in df.collect())
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()


def test_long_rule_files_do_not_pass_the_driver(spark, tmp_path, monkeypatch):
    """Rules stay files: numbered in the order of `ord` (equal ones as they stand), joined, never collected."""
    rng = random.Random(5)
    rows = [(rng.randint(0, 90), f"G{i % 7}", f"S{i}", f"key{i} ") for i in range(600)] + [(None, "G", "none", "zz"), (5, "G", "five", "key")]
    spark.createDataFrame(rows, "ord int, grp string, sub string, key string").coalesce(1).write.option("header", True).option(
        "ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "rules.csv"))
    spark.createDataFrame([(2, "B", "b"), (1, "A", "key")], "ord int, category string, key string").write.option("header", True).csv(str(tmp_path / "legacy.csv"))
    df = conform(spark.createDataFrame([(1, "key3 x"), (2, "zz"), (3, "KEY")], "ord long, name string").withColumns(
        {"label": F.lit(""), "source": F.lit("x")}))
    most, collect = [0], type(df).collect

    def counted(self):
        found = collect(self)
        most.append(len(found))
        return found

    monkeypatch.setattr(type(df), "collect", counted)
    t = Taxonomy.load(spark, str(tmp_path))
    rules_df = t.rules_df(spark)
    out = rule_index.classify_records(df, rules_df, t.legacy_df(spark))
    got = {r["ord"]: (r["sub"], r["legacy18"]) for r in out.collect()}
    assert t.keys_beyond(400) and not t.keys_beyond(700) and max(most) < 20
    listed = collect(rules_df.orderBy("rule_ord"))
    want = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    assert [(r["rule_ord"], r["sub"], r["key"]) for r in listed] == [(i, *r[2:]) for i, r in enumerate(want)]
    first = next(r[2] for r in want if r[3].lower() in " key3 x ")
    assert got == {1: (first, "A"), 2: ("none", ""), 3: (next(r[2] for r in want if r[3] in " key "), "A")}
    assert t.rules[0] == ("G", "none", "zz") and Taxonomy.starter().keys_beyond(84) and not Taxonomy.starter().keys_beyond(85)
