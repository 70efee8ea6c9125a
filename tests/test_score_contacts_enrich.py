"""Scores, contacts out of pages, and what enrichment does to records."""

from pyspark.sql import functions as F

from placebook.functions.contacts import extract_contacts, is_social_site
from placebook.functions.scoring import band_of, in_scope, score_records
from placebook.operators import enrich
from placebook.operators.matching import first_come
from placebook.operators.priority import assign_priority
from placebook.schema import RECORD, conform
from placebook.sources.place_details import latest_answers, parse_details

HTML = """<body><h1>Bello &amp; Daughters, caterers</h1>
<p>Write to kitchen@bello-daughters.example or <a href='mailto:Parties@bello-daughters.example'>parties</a>; robots use noreply@bello-daughters.example.
<img src="badge@3x.png"> <a href="https://instagram.com/bello.daughters">pictures</a> <a href="https://instagram.com/p/Zz9">one picture</a>
<a href="https://facebook.com/BelloDaughters/">page</a> <a href="https://www.facebook.com/sharer/sharer.php?u=bello">tell friends</a>
<a href="https://x.com/bellocooks">news</a> <a href="https://wa.me/2348099990001">chat</a> <a href="tel:08055550002">ring</a></p>
<p>Same day delivery within the island, catering for weddings.</p><script>let s = "bulk order wholesale";</script></body>"""


def records(spark, rows):
    out = []
    for i, r in enumerate(rows):
        r = {"ord": i + 1, "source": "Google Maps (sweep, Oct 2026)", **r}
        out.append(tuple(r.get(f.name) for f in RECORD.fields))
    return conform(spark.createDataFrame(out, RECORD))


def by_ord(df):
    return {r.ord: r for r in df.collect()}


def test_contacts_of_a_page(spark):
    got = extract_contacts(spark.createDataFrame([(HTML,)], "html string")).first().asDict()
    assert sorted(got["emails"]) == ["kitchen@bello-daughters.example", "parties@bello-daughters.example"]
    assert {k: got[k] for k in ("instagram", "facebook", "twitter", "tiktok", "linkedin")} == {
        "instagram": ["https://www.instagram.com/bello.daughters"], "facebook": ["https://www.facebook.com/BelloDaughters"],
        "twitter": ["https://x.com/bellocooks"], "tiktok": [], "linkedin": []}
    assert got["whatsapp"] == ["+2348099990001"] and "+2348055550002" in got["phones"]
    assert "catering" in got["delivery"] and "bulk order" not in got["delivery"] and not got["order_online"]


def test_social_hosts(spark):
    urls = [("https://instagram.com/a", True), ("http://shop.fb.com", True), ("https://myfb.com/x", False), ("x.com/a", True), ("", False)]
    got = spark.createDataFrame([(u,) for u, _ in urls], "u string").select(is_social_site("u")).collect()
    assert [r[0] for r in got] == [w for _, w in urls]


def test_scores(spark):
    service = {"Service options": [{"Delivery": True}, {"Takeout": True}], "Dining options": [{"Catering": True}]}
    rows = [dict(name="Fixture Kitchen", label="Restaurant", additional_info=service),
            dict(name="Fixture Mart", label="Supermarket", reviews=150, rating=4.3, website="https://m.example",
                 additional_info={"Service options": [{"Delivery": True}]}, delivery_text_signals=["catering"]),
            dict(name="Fixture Pharmacy", score_basis="Full"), dict(name="fixture - pharmacy"),
            dict(name="Fixture Chambers", label="Lawyer"),
            dict(name="Z", label="Cafe", additional_info={"Service options": [{"Delivery": False}, {"Delivery": True}]},
                 meta=("2026-10-06", "https://order.example", None))]
    out = by_ord(score_records(records(spark, rows)))
    assert out[1].score == 25 + 5 + 15 + 6 and out[1].delivery_category == "Restaurant / Food"
    c = out[2].components
    assert (c.delivery_flag, c.catering, c.has_website, c.rating_4, c.category_weight, c.order_volume) == (25, 15, 8, 5, 10, 19.6)
    assert out[2].band.startswith("Hot") and out[2].score == 82.6
    assert out[3].components.chain == out[4].components.chain == 10        # one title, twice
    assert out[3].score_basis == "Full" and out[4].score_basis == "Floor - not enriched"
    assert (out[6].components.delivery_flag, out[6].components.online_ordering) == (0, 7)   # a link is no flag
    assert {r.ord for r in in_scope(score_records(records(spark, rows))).collect()} == {1, 2, 3, 4, 6}


def test_band_edges(spark):
    rows = [(60.0, "Hot"), (59.9, "Warm"), (40.0, "Warm"), (25.0, "Cool"), (24.9, "Cold")]
    got = spark.createDataFrame(rows, "s double, w string").select(band_of("s"), "w").collect()
    assert all(b.startswith(w) for b, w in got)


def test_priorities(spark):
    core = ["Anthony / Anthony Village"]
    rows = [dict(name="x", phone="+2348031234567", area=core[0], reviews=12), dict(name="y", phone="+2348031234567", area="Gbagada", reviews=30),
            dict(name="z", phone="+2348031234567", area="Gbagada"),
            dict(name="w", area=core[0], lat=6.5, lng=3.3, source="OpenStreetMap (Oct 2026)"), dict(name="v", source="Finelib (Oct 2026)")]
    out = by_ord(assign_priority(records(spark, rows), core))
    assert [out[i].priority[0] for i in range(1, 6)] == list("ABCDD") and out[1].package == "Premium"
    assert out[4].verification == "Mapped location (OSM)" and out[5].verification == "Directory listing only"
    assert out[4].contactable == "No" and out[1].verification == "Google-verified"


def serve_one_by_one(wishes):
    taken, out = set(), {}
    for who, wants in sorted(wishes):
        free = next((w for w in wants if w not in taken), None)
        if free:
            taken.add(free)
            out[who] = free
    return out


def test_first_come_equals_the_queue(spark):
    import random
    rng = random.Random(7)
    wishes = [(i, rng.sample([f"k{j}" for j in range(25)], rng.randrange(0, 5))) for i in range(120)]
    df = spark.createDataFrame(wishes, "ord bigint, w array<string>").select(
        "ord", F.transform("w", lambda x: F.struct(x.alias("key"), F.lit(0).alias("tag"))).alias("choices"))
    got = {r.ord: r.choice for r in first_come(df).collect()}
    assert got == serve_one_by_one(wishes)


def test_site_contacts_and_phone_guard(spark):
    site = "https://a.example"
    pages = spark.createDataFrame([
        (site, "/", "<p>info@a.example 0803 111 1111</p>"), (site, "/order", "<p>info@a.example x@a.example 0803 222 2222</p>"),
        (site, "/about", "<p>dispatch</p>"), (site, "/contact", "y@a.example"), (site, "/delivery", "z@a.example"),
        ("https://b.example", "/about", "no home page")], "website string, path string, html string")
    found = enrich.site_contacts(pages)
    one = {r.website: r for r in found.collect()}
    assert set(one) == {site, "https://b.example"}                # also a site whose home page was not saved
    assert one[site].emails == ["info@a.example", "y@a.example", "x@a.example", "z@a.example"]    # every page, best first
    few = enrich.site_contacts(pages, paths=["/contact"], limit=2).collect()
    assert [(r.website, r.emails) for r in few] == [(site, ["info@a.example", "y@a.example"])]
    many = spark.createDataFrame([(site, f"/p{i}", f"m{i}@a.example", i) for i in range(20)] + [(site, "/p3", "old@a.example", -1)],
                                 "website string, path string, html string, fetched_at int")
    assert set(enrich.site_contacts(many).first().emails) == {f"m{i}@a.example" for i in range(20)}
    assert one[site].order_online and one[site].phones == ["+2348031111111", "+2348032222222"]
    rows = [dict(name="hq", phone="+2348031111111", website="https://none.example"),
            dict(name="late", website=site, zone="Ring area", reviews=5), dict(name="early", website=site, zone="Core catchment"),
            dict(name="has", website=site, phone="+2348099999999", email="own@x.example")]
    out = by_ord(enrich.apply_site_contacts(records(spark, rows), found))
    assert out[3].phone == "+2348032222222" and out[2].phone == ""            # the core record is served first
    assert "+2348031111111" in out[2].phones_all and out[2].email == "info@a.example; y@a.example; x@a.example"
    assert out[4].email == "own@x.example" and out[4].phone == "+2348099999999" and out[4].phones_all[0] == "+2348099999999"
    assert "online ordering" in out[2].delivery_text_signals and out[3].contact_channels == 3 and out[1].phones_all == []


def test_details_and_api(spark):
    ddl = "key string, items map<string,struct<label:string,href:string>>, about array<string>"
    raw = spark.createDataFrame([("0x1:0xa", {
        "address": ("Address: 350, Maryland mall, 360 Ikorodu Rd, Anthony ", ""), "action:4": ("", "https://order.example/x"),
        "phone:tel:+2348131867091": ("Phone", ""), "authority": ("Website", "http://x.example/")},
        ["Offers delivery", "Offers takeout", "Serves dine-in", "Has wheelchair access", "No delivery"])], ddl)
    p = parse_details(raw)
    got = p.first()
    assert got.phone == "+2348131867091" and got.addr == "350, Maryland mall, 360 Ikorodu Rd, Anthony"
    assert got.attrs == {"Service options": [{"Delivery": False}, {"Takeout": True}, {"Dine-in": True}]}
    rows = [dict(name="X", addr="360 Ikorodu Rd", place_id="0x1:0xa"),
            dict(name="Y", maps="https://www.google.com/maps/place/x/data=!4m7!3m6!1s0x1:0xa!8m2!3d6.5!19sChIJab_c-1?q=1", phone="+2348000000001")]
    out = by_ord(enrich.apply_details(records(spark, rows), p, "2026-12-01"))
    assert out[1].score_basis == out[2].score_basis == "Full" and out[1].website == "http://x.example/"
    assert out[1].phone == "+2348131867091" and out[2].phone == "+2348000000001"
    assert out[2].phones_all == ["+2348000000001", "+2348131867091"] and out[1].meta.order_online_url == "https://order.example/x"
    data = "struct<internationalPhoneNumber:string,nationalPhoneNumber:string,websiteUri:string,userRatingCount:int,rating:double>"
    answers = latest_answers(spark.createDataFrame([
        ("ChIJab_c-1", 1, ("", "", "", 3, 1.0)), ("ChIJab_c-1", 2, ("+234 803 123 4567", "", "", 412, 4.4))], f"key string, fetched_at int, data {data}"))
    out = by_ord(enrich.apply_api(records(spark, rows), answers, "Google Places API (Dec 2026)"))
    assert (out[2].reviews, out[2].rating, out[2].phone) == (412, 4.4, "+2348000000001")
    assert out[2].sources_all[-1] == "Google Places API (Dec 2026)" and out[1].reviews is None


def test_budgets(spark):
    usage = spark.createDataFrame([("2026-10-01", "enterprise")] * 799 + [("2026-10-02", "pro")], "at string, sku string")
    got = {r.sku: (r.used, r.ceiling, r.remaining) for r in enrich.quota(usage, 80).collect()}
    assert got == {"enterprise": (799, 800, 1), "pro": (1, 4000, 3999)}
    maps = "https://www.google.com/maps/place/x/data=!1s0x1:0x%d!19sChIJ%d"
    rows = [dict(name="r", label="Restaurant", area="Yaba", maps=maps % (i, i), reviews=v, phone="p" if i == 3 else "", website="w" if i == 3 else "")
            for i, v in ((1, None), (2, 5), (3, 900), (4, 50))]
    rows.append(dict(name="law", label="Lawyer", area="Yaba", maps=maps % (9, 9), reviews=9999))
    recs = records(spark, rows)
    none = spark.createDataFrame([], "key string")
    assert [r.ord for r in enrich.detail_candidates(recs, none, 3).collect()] == [3, 4, 2]
    known = spark.createDataFrame([("0x1:0x3",)], "key string")
    assert [r.ord for r in enrich.detail_candidates(recs, known, 3).collect()] == [4, 2]
    assert [r.ord for r in enrich.api_candidates(recs, none, 9).orderBy("reviews").collect()] == [1, 2, 4, 3, 5]
    done = spark.createDataFrame([("ChIJ9",)], "key string")
    assert {r.ord for r in enrich.api_candidates(recs, done, 2).collect()} == {4}       # the known one is not replaced
    assert {r.ord for r in enrich.api_candidates(recs, none, 2, in_scope_only=True).collect()} == {4, 2}


def test_flags_that_come_as_text(spark):
    from placebook.functions.scoring import flag_in_text
    rows = [("Yes", True), ("No", False), (" false ", False), ("", False), (None, False), ("offered", True)]
    got = spark.createDataFrame(rows, "t string, w boolean").select(flag_in_text("t"), "w").collect()
    assert all(a == b for a, b in got)


def test_the_enrichment_steps_follow_each_other(spark):
    from placebook.plans.profiles import enrich_records
    from placebook.sources.place_details import attributes, chips
    site = "https://a.example"
    pages = spark.createDataFrame([(site, "/", "<p>0803 111 1111 we deliver</p>")], "website string, path string, html string")
    about = spark.createDataFrame([("0x1:0xa", ["Offers delivery"])], "key string, about array<string>")
    details = about.select("key", F.lit("+2348031111111").alias("phone"), F.lit("").alias("website"), F.lit("").alias("addr"),
                           F.lit("").alias("order_url"), attributes(chips()).alias("attrs"))
    rows = [dict(name="first", website=site), dict(name="second", place_id="0x1:0xa")]
    out = by_ord(enrich_records(records(spark, rows), "2026-12-01", enrich.site_contacts(pages), details))
    assert out[1].phone == "+2348031111111" and out[2].phone == ""      # given to the first, so not to the second
    assert out[2].phones_all == ["+2348031111111"] and out[2].score_basis == "Full"
