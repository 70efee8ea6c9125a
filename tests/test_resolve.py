"""Entity resolution against a plain loop over the records, one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from placebook.operators.resolve import Resolution, list_items, mark_deciding
from placebook.schema import MULTI_SOURCE, RECORD, conform

G, O, D, M, A = ("Google Maps (sweep, Oct 2026)", "OpenStreetMap (Oct 2026)", "Finelib (Oct 2026)",
                 "Manual CSV (x.csv)", "Google Places API (Oct 2026)")
TRUST = {A: 5, G: 4, O: 3, D: 2, M: 1}
FIELDS = ["phone", "website", "addr", "place_id", "email", "label"]
DDL = ("ord bigint, name string, place_id string, phone string, addr string, website string, email string, "
       "label string, source string, lat double, lng double, reviews int, phones_all array<string>, "
       "grp string, sub string")


def record(ord, name, **kw):
    row = {"ord": ord, "name": name, "place_id": "", "phone": "", "addr": "", "website": "", "email": "",
           "label": "", "source": G, "lat": None, "lng": None, "reviews": None, "grp": "G", "sub": "S"}
    row.update(kw)
    row["phones_all"] = [row["phone"]] if row["phone"] else []
    return row


def one_by_one(rows):
    """Process records in order; names and addresses here need no normalising beyond lower case."""
    owner, businesses, joined_by, log = {}, [], {}, []
    for r in sorted(rows, key=lambda x: x["ord"]):
        def keys_of(name, b):
            out = [("pid", b["place_id"])] if b["place_id"] else []
            out += [("p", b["phone"])] if b["phone"] else []
            return out + [("na", name + "|" + b["addr"]), ("n", name)]
        mine = keys_of(r["name"], r)
        target = None
        for k in mine:
            b = owner.get(k)
            if b is None:
                continue
            both = b["v"]["place_id"] and r["place_id"]
            if k[0] in ("na", "n") and both and b["v"]["place_id"] != r["place_id"]:
                continue
            target, joined_by[r["ord"]] = b, k[0]
            break
        if target is None:
            target = {"root": r["ord"], "name": r["name"], "v": dict(r), "sources": [r["source"]],
                      "phones": list(r["phones_all"]), "members": [r["ord"]]}
            businesses.append(target)
            for k in mine:
                owner.setdefault(k, target)
            continue
        v, lead = target["v"], target["sources"][0]
        wins = TRUST[r["source"]] > TRUST[lead]
        if r["lat"] is not None and (v["lat"] is None or wins):
            v["lat"], v["lng"] = r["lat"], r["lng"]
        for f in FIELDS + ["reviews"]:
            if r[f] in ("", None):
                continue
            if v[f] in ("", None):
                v[f] = r[f]
            elif v[f] != r[f]:
                if f not in ("label", "reviews"):
                    log.append((target["root"], r["ord"], f, *((r[f], v[f], lead) if wins else (v[f], r[f], r["source"]))))
                if wins:
                    v[f] = r[f]
        if wins:
            target["sources"] = [r["source"]] + [s for s in target["sources"] if s != r["source"]]
        if r["source"] not in target["sources"]:
            target["sources"].append(r["source"])
        target["phones"] = list(dict.fromkeys(target["phones"] + r["phones_all"]))
        target["members"].append(r["ord"])
        for k in keys_of(target["name"], v) + mine:
            owner.setdefault(k, target)
    return businesses, joined_by, log


def random_rows(seed, n):
    rng = random.Random(seed)
    pick = lambda values, p: rng.choice(values) if rng.random() < p else ""
    rows = []
    for i in range(n):
        rows.append(record(
            i * 3 + 1, f"name{rng.randrange(n // 6 + 2)}x",
            place_id=pick([f"0x{j}" for j in range(n // 5 + 2)], 0.45),
            phone=pick([f"+234803000{j:04d}" for j in range(n // 4 + 2)], 0.3),
            addr=pick([f"{j} lagos" for j in range(5)], 0.6),
            website=pick(["https://a.example", "https://b.example"], 0.4),
            email=pick(["a@x.example", "b@x.example"], 0.3), label=pick(["Shop", "Bar"], 0.5),
            source=rng.choice(list(TRUST)),
            **({"lat": float(rng.randrange(9)), "lng": 3.0} if rng.random() < 0.4 else {}),
            reviews=rng.choice([None, 3, 40])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in DDL.split(", ")) for r in rows], DDL)


@pytest.mark.parametrize("seed,n", [(2, 250), (3, 400)])
def test_equals_the_sequential_result(spark, seed, n):
    rows = random_rows(seed, n)
    expected, joined_by, log = one_by_one(rows)
    got = Resolution(frame(spark, rows))
    clusters = {r.ord: r.cluster for r in got.clusters.collect()}
    assert clusters == {m: b["root"] for b in expected for m in b["members"]}
    via = {r.ord: r.via for r in got.clusters.collect() if r.via is not None}
    assert set(via) == set(joined_by)
    assert {k: v for k, v in via.items() if v < 2} == {k: ["pid", "p"].index(v) for k, v in joined_by.items() if v in ("pid", "p")}
    out = {r.ord: r for r in got.businesses().collect()}
    assert len(out) == len(expected)
    for b in expected:
        r = out[b["root"]]
        for f in FIELDS + ["reviews", "lat", "lng", "name"]:
            assert r[f] == b["v"][f], (b["root"], f)
        assert r.sources_all == b["sources"]
        assert r.source == (MULTI_SOURCE if len(b["sources"]) > 1 else b["sources"][0])
        assert r.phones_all == b["phones"]
    lost = {(r.cluster, r.ord, r.field, r.kept, r.dropped, r.dropped_source)
            for r in got.conflicts().collect() if r.field != "lat,lng"}
    assert lost == set(log)


def merged(spark, *rows):
    res = Resolution(frame(spark, rows))
    return res, sorted(res.businesses().collect(), key=lambda r: r.ord)


def test_place_ids_are_never_fused_by_name(spark):
    rows = [record(1, "Nett Pharmacy", place_id="0x1:0xa", addr="350 Ikorodu Rd"),
            record(2, "Nett Pharmacy", place_id="0x1:0xb", addr="Opic Plaza"),
            record(3, "Nett Pharmacy", source=O, phone="+2348031234567")]
    _, out = merged(spark, *rows)
    assert [r.ord for r in out] == [1, 2] and out[0].phone == "+2348031234567"


def test_decision_log_names_level_and_state(spark):
    res, out = merged(spark, record(1, "Fixture Salon Ltd", addr="5 Fixture Road, Anthony"),
                      record(2, "Fixture Salon", addr="5 Fixture Rd, Anthony", source=O),
                      record(3, "Fixture Salon", addr="elsewhere", source=D), record(4, "Ltd", source=M))
    log = {r.ord: r for r in res.decisions().collect()}
    assert (log[2].key, log[3].key, log[4].action) == ("na", "n", "dropped")
    assert log[2].kept_source == G and log[3].kept_source == MULTI_SOURCE
    assert out[0].sources_all == [G, O, D]


def test_a_merge_may_bring_the_category(spark):
    rows = [record(1, "Hub", phone="+2348031234567", grp="Other Local Services", sub="Unclassified (needs review)"),
            record(2, "Hub", phone="+2348031234567", grp="Phones", sub="Phone Shops")]
    _, out = merged(spark, *rows)
    assert (out[0].grp, out[0].sub) == ("Phones", "Phone Shops")


def test_long_phone_lists_are_complete(spark):
    rows = [record(i, "Shop", phone=f"+23480300{i:05d}", source=M) for i in range(1, 1203)]
    res = Resolution(frame(spark, rows))
    stored = conform(res.businesses().drop("n_sightings")).first()
    want = [r.value for r in res.items.filter("kind = 'phone'").orderBy("ord", "pos").collect()]
    assert len(want) == 1202 and stored.phones_all == want


def test_later_members_give_meta_but_no_empty_class(spark):
    rows = [record(1, "Shop", phone="+2348030000001", source=M), record(2, "Shop", phone="+2348030000001", source=M)]
    df = conform(frame(spark, rows)).withColumn(
        "meta", F.when(F.col("ord") == 2, F.struct(F.lit("2026-12-01"), F.lit("https://order.example"), F.lit(None).cast("string")))
        .cast(RECORD["meta"].dataType)).withColumn("grp", F.when(F.col("ord") == 2, "Food").otherwise(F.lit(""))).withColumn("sub", F.lit(""))
    out = Resolution(df).businesses().first()
    assert out.meta.order_online_url == "https://order.example" and out.grp == ""


def test_only_deciding_sightings_are_sorted(spark):
    """However many sightings a business has, a bounded number of them is sorted and shuffled whole."""
    rows = [record(i, f"Shop {i}", phone="+2348030000001", source=[G, O, D, M, A][i % 5], email="" if i < 300 else f"e{i}@x.example",
                   lat=6.5 if i > 200 else None, lng=3.3 if i > 200 else None) for i in range(1, 401)]
    res = Resolution(frame(spark, rows))
    assert not res._stored                                       # the clusters alone need no sightings stored
    few = [r.ord for r in res.members.filter("decides").collect()]
    assert {1, 201, 300} <= set(few) and len(few) <= 9 and res.members.count() == 400
    plan = list_items(res.members)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    out = res.businesses().first()
    assert (out.email, out.lat) == ("e300@x.example", 6.5) and res.state.first().n_sightings == 400


def test_items_keep_the_order_of_large_and_negative_places(spark):
    top = (1 << 63) - 1
    rows = [record(i, "Shop", phone=p, source=M) for i, p in ((-5, "+2348030000001"), (-4, "+2348030000002"), (top, "+2348030000003"))]
    got = {r.value: (r.ord, r.pos) for r in Resolution(frame(spark, rows)).items.filter("kind = 'phone'").collect()}
    assert got == {"+2348030000001": (-5, 0), "+2348030000002": (-4, 0), "+2348030000003": (top, 0)}


def test_whole_records_are_not_sorted_to_meet_their_business(spark):
    """Records meet the few numbers of their business by hash, whatever their number."""
    rows = conform(frame(spark, random_rows(3, 60)))
    marked = mark_deciding(rows, Resolution(rows).clusters)
    plan = marked._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and marked.count() == 60
