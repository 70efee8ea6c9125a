"""Entity resolution: which sightings are one business, and what the business record holds.

The semantics are those of a greedy pass in record order. Each record looks for a business by its keys,
strongest first - place id, phone, name with address, name - and joins the first business found under
one of them; a name may not join two different place ids. Keys stay with the business that had them
first, and two businesses are never joined later.

Run record by record that is a sequential loop. Here it is worked out by sets, with the same result:

1.  A key belongs to the business of the first record that has it, so "whom do I join" is a lookup of
    min(ord) per key. For a record without a place id, or one found by place id or phone, that settles
    it: it has a parent record.
2.  Parents form a forest; pointer doubling over the records that are parents finds each root.
3.  What is left are records that bring a new place id and are known by name only. A business without
    a place id takes the first of them; each tries the business under name+address, then the one under
    the name. That is first come, first served, solved in rounds of min() per business until nobody is
    turned away (`matching.first_come`).
4.  A merged business answers to its own name with the address it took over. When such a key exists
    before any record brings it itself, the affected lookups are corrected and the steps repeated
    until nothing changes.

Each step depends only on earlier records, so what the rounds settle on is the sequential result. All
steps are joins and partial aggregations; no key group is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.geo import distance_km
from placebook.functions.provenance import TRUST_LEVELS, trust
from placebook.functions.rules import unclassified
from placebook.functions.text import norm_addr, norm_name
from placebook.operators.matching import first_come
from placebook.operators.skew import lookup
from placebook.schema import MULTI_SOURCE, QUIET_FIELDS, RECORD, SURVIVING_NUMBERS, SURVIVING_TEXT, conform
from placebook.session import materialise, materialise_counting

# fixed values: key levels, strongest first
LEVELS = ["pid", "p", "na", "n"]
PID, PHONE, NAME_ADDR, NAME = range(4)


def address_key(addr: Column | str) -> Column:
    return F.substring(norm_addr(addr), 1, 40)


def with_match_keys(records: DataFrame) -> DataFrame:
    """Add nn (normalised name) and ak (normalised address, 40 characters)."""
    return records.withColumn("nn", norm_name("name")).withColumn("ak", address_key("addr"))


def split_nameless(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that can be matched, dropped records with the reason)."""
    keyed = with_match_keys(records)
    return keyed.filter("nn != ''"), dropped_nameless(keyed)


def dropped_nameless(keyed: DataFrame) -> DataFrame:
    return keyed.filter("nn = ''").select("ord", "name", "source", F.lit("empty normalised name").alias("reason"))


def match_keys(keyed: DataFrame) -> DataFrame:
    """One row per record and key: ord, level, key."""
    keys = F.array(
        F.struct(F.lit(PID).alias("level"), F.col("place_id").alias("key")),
        F.struct(F.lit(PHONE).alias("level"), F.col("phone").alias("key")),
        F.struct(F.lit(NAME_ADDR).alias("level"), F.concat_ws("|", "nn", "ak").alias("key")),
        F.struct(F.lit(NAME).alias("level"), F.col("nn").alias("key")),
    )
    return (keyed.select("ord", F.explode(keys).alias("k")).select("ord", "k.level", "k.key")
            .filter("key != ''"))


def _link(keys: DataFrame, firsts: DataFrame, has_id: DataFrame) -> DataFrame:
    """Per record: the first earlier record under each of its keys (f0..f3, NULL if none)."""
    shared = firsts.filter("n > 1").select("level", "key", "first")
    found = lookup(keys, shared, ["level", "key"]).filter("first < ord")
    wide = found.groupBy("ord").agg(*[
        F.min(F.when(F.col("level") == i, F.col("first"))).alias(f"f{i}") for i in range(4)])
    return has_id.join(wide, "ord", "left")


def _parents(links: DataFrame) -> DataFrame:
    """Settle every record but the name-only newcomers: ord, has_id, parent, via, a, b."""
    strong = F.coalesce("f0", "f1")
    weak = F.coalesce("f2", "f3")
    newcomer = strong.isNull() & F.col("has_id") & weak.isNotNull()
    parent = F.coalesce(strong, F.when(~F.col("has_id"), weak))
    via = (F.when(F.col("f0").isNotNull(), F.lit(PID)).when(F.col("f1").isNotNull(), F.lit(PHONE))
           .when(~F.col("has_id") & F.col("f2").isNotNull(), F.lit(NAME_ADDR))
           .when(~F.col("has_id") & F.col("f3").isNotNull(), F.lit(NAME)))
    return links.select("ord", "has_id", parent.alias("parent"), via.alias("via"),
                        F.when(newcomer, F.col("f2")).alias("a"), F.when(newcomer, F.col("f3")).alias("b"),
                        newcomer.alias("newcomer"))


def _hub_tops(forest: DataFrame) -> DataFrame:
    """For every record that others point to: hub, the top of its tree, whether the top is a newcomer.

    Pointer doubling: the reach doubles per round, so the rounds grow with the log of the depth.
    """
    children = (forest.filter("parent is not null").groupBy(F.col("parent").alias("hub"))
                .agg(F.min(F.when(F.col("has_id"), F.col("ord"))).alias("child_id")))
    candidates = (forest.filter("newcomer").select(F.explode(F.array("a", "b")).alias("hub"))
                  .filter("hub is not null").distinct())
    hubs = children.join(candidates, "hub", "full")
    own = forest.select(F.col("ord").alias("hub"), "parent", "newcomer",
                        F.when(F.col("has_id"), F.col("ord")).alias("own_id"))
    tops, inner = materialise_counting(hubs.join(own, "hub").select(
        "hub", F.coalesce("parent", "hub").alias("top"), "child_id", "own_id", "newcomer",
        F.col("parent").isNull().alias("is_top")), "hub-tops", F.expr("not is_top"))
    ends = tops.filter("is_top").select(F.col("hub").alias("top"), F.col("newcomer").alias("top_new"),
                                        F.col("own_id").alias("top_id"))
    while inner:
        step = tops.filter("not is_top").select(F.col("hub").alias("top"), F.col("top").alias("next"))
        # a stored step goes as far as two jumps of up to two hops each, to need fewer of them
        jump = lookup(step, step.select(F.col("top").alias("next"), F.col("next").alias("after")), ["next"]).select("top", F.coalesce("after", "next").alias("next"))
        moved = lookup(lookup(tops, jump, ["top"]).select(
            "hub", F.coalesce("next", "top").alias("top"), "child_id", "is_top", F.col("next").isNotNull().alias("once")),
            jump, ["top"])
        tops, inner = materialise_counting(moved.select(
            "hub", F.coalesce("next", "top").alias("top"), "child_id", "is_top",
            (F.col("once") | F.col("next").isNotNull()).alias("moved")), "hub-tops", F.col("moved"))
        tops = tops.drop("moved")
    return lookup(tops.select("hub", "top", "child_id"), ends, ["top"])


def _match_newcomers(forest: DataFrame, tops: DataFrame) -> DataFrame:
    """Which newcomer joins which business: ord, home, via. Newcomers that join none are absent."""
    first_id = (tops.groupBy("top").agg(F.min("child_id").alias("c"), F.max("top_id").alias("o"))
                .select("top", F.least("c", "o").alias("first_id")))
    doors = (tops.filter("not top_new").select("hub", "top")
             .join(first_id, "top").select("hub", "top", "first_id"))
    news = forest.filter("newcomer").select("ord", "a", "b")

    def door(df: DataFrame, side: str, out: str) -> DataFrame:
        found = lookup(df, doors.withColumnRenamed("hub", side), [side])
        open_ = F.col("first_id").isNull() | (F.col("first_id") > F.col("ord"))
        return found.withColumn(out, F.when(open_, F.col("top"))).drop("top", "first_id", side)

    tries = door(door(news, "a", "ra"), "b", "rb")

    def choice(col: str, level: int) -> Column:
        return F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("key"), F.lit(level).alias("tag")))

    other = F.when(~F.col("rb").eqNullSafe(F.col("ra")), choice("rb", NAME))
    wishes = tries.select("ord", F.array_compact(F.array(choice("ra", NAME_ADDR), other)).alias("choices"))
    return first_come(wishes).select(
        "ord", F.col("choice").alias("home"), F.col("tag").alias("via"))


def _clusters(links: DataFrame) -> DataFrame:
    """ord, cluster (ord of the business's first record), via (level, NULL for that first record)."""
    forest = _parents(links)
    tops = materialise(_hub_tops(forest), "tops")
    homes = materialise(_match_newcomers(forest, tops), "homes")
    moved = homes.select(F.col("ord").alias("top"), "home")
    final = (lookup(tops.select("hub", "top"), moved, ["top"])
             .select(F.col("hub").alias("parent"), F.coalesce("home", "top").alias("cluster")))
    child = lookup(forest.filter("parent is not null").select("ord", "via", "parent"), final, ["parent"]).select("ord", "cluster", "via")
    alone = (forest.filter("parent is null").select("ord")
             .join(homes, "ord", "left")
             .select("ord", F.coalesce("home", "ord").alias("cluster"), "via"))
    return materialise(child.unionByName(alone), "clusters")


def _effective_trust() -> Column:
    """Trust of a sighting: the first record of a business counts by its leading source, others by theirs."""
    return F.when(F.col("ord") == F.col("cluster"), trust(F.get("sources_all", F.lit(0)))).otherwise(trust("source"))


def _leaders(level_rows: list[Column]) -> Column:
    """The sightings that led a business's provenance, oldest first.

    A sighting takes the lead when its trust exceeds every earlier one. It is then the first of its
    trust level, so the first row per level (at most five) is all that is needed.
    """
    firsts = F.array_sort(F.filter(F.array(*level_rows), lambda e: e.isNotNull()))
    return F.filter(firsts, lambda e: ~F.exists(
        firsts, lambda o: (o["ord"] < e["ord"]) & (o["t"] > e["t"])))


def _deciding(rows: DataFrame, clusters: DataFrame, tests: list[Column]) -> DataFrame:
    """The sightings that can decide a business: its first, the first of each trust level, the first to pass each test: cluster, ord.

    Only numbers are compared, which aggregate by hash, so that neither a sort nor a shuffle of whole sightings is needed
    to find them. What is a minimum by `ord` over all sightings is the same minimum over these.
    """
    bits = F.lit(0).cast("long")
    for i, test in enumerate(tests):
        bits = bits + F.when(test, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    narrow = rows.select("ord", bits.alias("bits"), trust(F.get("sources_all", F.lit(0))).cast("byte").alias("t_lead"),
                         trust("source").cast("byte").alias("t_own"))
    placed = lookup(narrow, clusters.select("ord", "cluster"), ["ord"], "inner")
    t = F.when(F.col("ord") == F.col("cluster"), F.col("t_lead")).otherwise(F.col("t_own"))
    marks = [t == level for level in TRUST_LEVELS] + [F.col("bits").bitwiseAND(F.lit(1 << i).cast("long")) != 0 for i in range(len(tests))]
    firsts = placed.groupBy("cluster").agg(F.min("ord").alias("f"), *[F.min(F.when(m, F.col("ord"))).alias(f"f{i}") for i, m in enumerate(marks)])
    found = F.array_distinct(F.array_compact(F.array("f", *[f"f{i}" for i in range(len(marks))])))
    return firsts.select("cluster", F.explode(found).alias("ord"))


def _borrowed_keys(keyed: DataFrame, clusters: DataFrame, firsts: DataFrame) -> DataFrame:
    """Name+address keys a business owns before any record brings them: key, first.

    These are its own name with an address taken over from a sighting of another name.
    """
    few = _deciding(keyed, clusters, [F.col("addr") != ""])
    rows = (keyed.select("ord", "nn", "ak", "source", "sources_all",
                         (F.col("addr") != "").alias("filled")).join(few, "ord"))
    rows = rows.select("ord", "cluster", "nn", _effective_trust().alias("t"),
                       F.when(F.col("filled"), F.col("ak")).alias("ak"))
    slot = F.struct("ord", "t", "ak")
    state = rows.groupBy("cluster").agg(
        F.min(F.when(F.col("ord") == F.col("cluster"), F.col("nn"))).alias("nn"),
        F.min(F.when(F.col("ak").isNotNull(), slot)).alias("filled"),
        *[F.min(F.when(F.col("t") == t, slot)).alias(f"l{t}") for t in TRUST_LEVELS])
    taken_over = F.filter(_leaders([F.col(f"l{t}") for t in TRUST_LEVELS]), lambda e: e["ak"].isNotNull())
    events = (state.select("cluster", "nn", F.explode(F.array_union(
        taken_over, F.filter(F.array("filled"), lambda e: e.isNotNull()))).alias("e"))
        .filter("e.ord > cluster")
        .groupBy(F.concat_ws("|", "nn", "e.ak").alias("key")).agg(F.min("e.ord").alias("borrowed")))
    own = firsts.filter(F.col("level") == NAME_ADDR).select("key", "first")
    return events.join(own, "key").filter("borrowed < first").select("key", F.col("borrowed").alias("first"))


def keyed_records(records: DataFrame) -> DataFrame:
    """What matching reads of the records, with their keys, stored: normalised once, whoever reads them."""
    cols = ["ord", "name", "addr", "place_id", "phone", "source", "sources_all"]
    return materialise(with_match_keys(records.select(*cols)), "keyed")


def resolve(records: DataFrame, keyed: DataFrame | None = None) -> DataFrame:
    """Assign every nameable record to its business: ord, cluster, via.

    `records` need ord (unique), name, addr, place_id, phone, source, sources_all; `keyed` are its `keyed_records`,
    if they are known.
    """
    # filtered after it is stored: a filter in the same plan would work out the normalised name twice
    keyed = (keyed_records(records) if keyed is None else keyed).filter("nn != ''")
    has_id = keyed.select("ord", (F.col("place_id") != "").alias("has_id"))
    keys = match_keys(keyed)
    firsts = materialise(
        keys.groupBy("level", "key").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    links = materialise(_link(keys, firsts, has_id), "links")
    clusters = _clusters(links)
    seen = None
    while True:
        borrowed = materialise(_borrowed_keys(keyed, clusters, firsts), "borrowed")
        mark = borrowed.agg(F.count(F.lit(1)), F.sum(F.xxhash64("key", "first").cast("decimal(38,0)"))).first()
        if (seen is None and mark[0] == 0) or mark == seen:
            return clusters
        seen = mark
        corrected = (lookup(keys.filter(F.col("level") == NAME_ADDR), borrowed, ["key"], "inner")
                     .filter("first < ord").select("ord", F.col("first").alias("fixed")))
        moved, n_moved = materialise_counting(_moved(corrected, links, clusters), "moved",
                                              F.expr("was != now"))
        if n_moved == 0:
            return _relabelled(clusters, moved)
        fixed = (links.join(corrected, "ord", "left").withColumn("f2", F.coalesce("fixed", "f2")).drop("fixed"))
        clusters = _clusters(materialise(fixed, "links"))


def _moved(corrected: DataFrame, links: DataFrame, clusters: DataFrame) -> DataFrame:
    """Corrected records that look by name: the business they found (was) and the one they would find (now)."""
    by_name = links.filter("f0 is null and f1 is null").select("ord", F.coalesce("f2", "f3").alias("weak"))
    asked = corrected.join(by_name, "ord")
    home = clusters.select("ord", "cluster")
    for col, out in (("weak", "was"), ("fixed", "now")):
        asked = lookup(asked, home.select(F.col("ord").alias(col), F.col("cluster").alias(out)), [col])
    return asked.select("ord", "was", "now")


def _relabelled(clusters: DataFrame, moved: DataFrame) -> DataFrame:
    """The same businesses, with the level of a merge put right where the address would have found it too."""
    named = moved.select("ord", F.lit(True).alias("by_address"))
    via = F.when(F.col("by_address") & (F.col("via") == NAME), F.lit(NAME_ADDR)).otherwise(F.col("via"))
    return materialise(clusters.join(named, "ord", "left").select("ord", "cluster", via.alias("via")), "clusters")


# ------------------------------------------------------------------ what the business record holds

_TRACKED = [*SURVIVING_TEXT, *SURVIVING_NUMBERS]
# conflicts are logged in this order: the pair first, then the fields
_LOGGED = [f for f in SURVIVING_TEXT if f not in QUIET_FIELDS]


def _filled(field: str) -> Column:
    if field == "lat":
        return F.col("lat").isNotNull()
    return F.col(field).isNotNull() if field in SURVIVING_NUMBERS else F.col(field) != ""


def _slot_filled(slot: Column, field: str) -> Column:
    return slot[field].isNotNull() if field in [*SURVIVING_NUMBERS, "lat"] else slot[field] != ""


def _state_tests() -> list[Column]:
    """What decides a field besides trust: the first sighting that fills it."""
    return [*map(_filled, _TRACKED), _filled("lat"), ~unclassified() & (F.col("sub") != ""), F.col("meta").isNotNull()]


def mark_deciding(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """Records with their business: cluster, via and `decides`, whether the sighting can decide anything about it."""
    few = _deciding(records, clusters, _state_tests()).withColumn("decides", F.lit(True))
    marked = clusters.join(few, ["ord", "cluster"], "left").select("ord", "cluster", "via", "decides").withColumn("decides", F.coalesce("decides", F.lit(False)))
    # looked up by hash in its few numbers a record: whole records are not sorted
    return records.join(materialise(marked, "marked").hint("shuffle_hash"), "ord")


def merge_state(members: DataFrame) -> DataFrame:
    """Per business, what decides every field: a few rows' worth, however many sightings it has.

    * leaders: the (at most five) sightings that led its provenance, with their field values
    * s_<field>: the first sighting that fills the field
    * grp/sub of the first classified sighting; whole first record

    Only sightings that decide something (`mark_deciding`) are sorted and shuffled, a bounded number per business.
    """
    rows = members.filter("decides").withColumn("t", _effective_trust())
    values = ["lat", "lng", *_TRACKED]
    lead = F.when(F.col("ord") == F.col("cluster"), F.get("sources_all", F.lit(0))).otherwise(F.col("source"))
    slot = F.struct("ord", "t", lead.alias("source"), *values)
    aggs = [F.min(F.when(F.col("t") == t, slot)).alias(f"l{t}") for t in TRUST_LEVELS]
    for f in _TRACKED:
        aggs.append(F.min(F.when(_filled(f), F.struct("ord", f))).alias(f"s_{f}"))
    aggs.append(F.min(F.when(_filled("lat"), F.struct("ord", "lat", "lng"))).alias("s_lat"))
    aggs.append(F.min(F.when(~unclassified() & (F.col("sub") != ""), F.struct("ord", "grp", "sub"))).alias("s_class"))
    aggs.append(F.min_by(F.struct("meta"), F.when(F.col("meta").isNotNull(), F.col("ord"))).alias("s_meta"))
    kept = [c for c in RECORD.names if c not in {"ord", "lat", "lng", *_TRACKED} and c in members.columns]
    aggs.append(F.min_by(F.struct(*kept), F.col("ord")).alias("head"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_sightings"))
    state = rows.groupBy("cluster").agg(*aggs).join(sizes, "cluster")
    leaders = _leaders([F.col(f"l{t}") for t in TRUST_LEVELS])
    return state.withColumn("leaders", leaders).drop(*[f"l{t}" for t in TRUST_LEVELS])


def _last_filled(leaders: Column, field: str) -> Column:
    """The latest leader that fills the field, NULL if none does."""
    return F.try_element_at(F.filter(leaders, lambda e: _slot_filled(e, field)), F.lit(-1))


def survivors(state: DataFrame, lists: DataFrame) -> DataFrame:
    """The business records, from the merge state and the united lists."""
    cols = {}
    leaders = F.col("leaders")
    for f in _TRACKED:
        last = _last_filled(leaders, f)
        value = F.coalesce(last[f], F.col(f"s_{f}")[f])
        cols[f] = value if f in SURVIVING_NUMBERS else F.coalesce(value, F.lit(""))
    last = _last_filled(leaders, "lat")
    cols["lat"] = F.coalesce(last["lat"], F.col("s_lat")["lat"])
    cols["lng"] = F.when(last.isNotNull(), last["lng"]).otherwise(F.col("s_lat")["lng"])
    head = F.col("head")
    inherit = unclassified(head["grp"], head["sub"]) & F.col("s_class").isNotNull()
    cols["grp"] = F.when(inherit, F.col("s_class")["grp"]).otherwise(head["grp"])
    cols["sub"] = F.when(inherit, F.col("s_class")["sub"]).otherwise(head["sub"])
    joined = state.join(lists, "cluster", "left")
    led = F.transform(F.reverse(leaders), lambda e: e["source"])
    alone = F.col("n_sightings") == 1
    cols["sources_all"] = F.when(alone, head["sources_all"]).otherwise(
        F.array_distinct(F.concat(F.slice(led, 1, F.greatest(F.size(led) - 1, F.lit(0))),
                                  F.coalesce("all_sources", F.array().cast("array<string>")))))
    cols["source"] = F.when(~alone & (F.size(F.array_distinct("all_sources")) > 1), F.lit(MULTI_SOURCE)).otherwise(
        head["source"])
    cols["phones_all"] = F.when(alone, head["phones_all"]).otherwise(
        F.coalesce("all_phones", F.array().cast("array<string>")))
    cols["meta"] = F.col("s_meta")["meta"]
    cols["delivery_text_signals"] = F.when(alone, head["delivery_text_signals"]).otherwise(
        F.coalesce("all_signals", F.array().cast("array<string>")))
    cols["additional_info"] = F.when(alone, head["additional_info"]).otherwise(F.col("all_info"))
    out = [F.col("cluster").alias("ord")]
    for name in RECORD.names[1:]:
        out.append(cols.get(name, head[name]).alias(name))
    return joined.select(*out, "n_sightings")


_PLACES = 1 << 31                                                # more than an array has elements


def list_items(members: DataFrame) -> DataFrame:
    """Every distinct source, phone and delivery signal of a business, in order of appearance.

    cluster, kind, value, ord, pos - the complete lists, one row per element.
    """
    def tagged(kind: str, items: Column) -> Column:
        return F.transform(items, lambda v, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"),
                                                        v.alias("value")))
    all_items = F.concat(tagged("source", F.col("sources_all")),
                         tagged("phone", F.concat("phones_all", F.array("phone"))),
                         tagged("signal", F.col("delivery_text_signals")))
    # one number in the order of (ord, pos): minima of numbers aggregate by hash, those of structs sort every element
    at = F.col("ord").cast("decimal(19,0)") * F.lit(_PLACES).cast("decimal(10,0)") + F.col("i.pos").cast("decimal(10,0)")
    firsts = (members.select("ord", "cluster", F.explode(all_items).alias("i"))
              .filter("i.value != ''")
              .groupBy("cluster", "i.kind", "i.value").agg(F.min(at).alias("at"))
              .withColumn("pos", F.pmod("at", F.lit(_PLACES).cast("decimal(10,0)")).cast("int")))
    return firsts.select("cluster", "kind", "value", F.expr(f"(at - pos) div {_PLACES}L").alias("ord"), "pos")


def united_lists(items: DataFrame, members: DataFrame) -> DataFrame:
    """The lists as arrays per business: every distinct element, however many there are.

    Duplicates are gone before this, so a list is as long as the record's own field must be.
    """
    def listed(kind: str) -> Column:
        found = F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "pos", "value")))
        return F.transform(F.array_sort(found), lambda e: e["value"])

    lists = items.groupBy("cluster").agg(
        listed("source").alias("all_sources"), listed("phone").alias("all_phones"),
        listed("signal").alias("all_signals"))
    info = (members.filter("additional_info is not null")
            .select("ord", "cluster", F.explode("additional_info").alias("g", "entries"))
            .groupBy("cluster", "g").agg(F.min_by("entries", "ord").alias("entries"))
            .groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("g", "entries"))).alias("all_info")))
    return lists.join(info, "cluster", "left")


def merge_events(members: DataFrame, state: DataFrame, items: DataFrame) -> DataFrame:
    """Every sighting that joined a business, beside the business as it stood just before.

    The state per business is small and joins back to its sightings; the values of that moment follow
    from the leaders and fillers that came earlier. States are looked up by hash: sightings are not sorted.
    """
    sources = items.filter("kind = 'source'").select("cluster", F.struct("ord", "pos").alias("at"))
    first = sources.groupBy("cluster").agg(F.min("at").alias("first"))
    second = (sources.join(first, "cluster").filter("at > first")
              .groupBy("cluster").agg(F.min("at")["ord"].alias("second_source")))
    before = state.select("cluster", "leaders", *[f"s_{f}" for f in _TRACKED], "s_lat",
                          F.col("head")["name"].alias("kept_name"), F.col("head")["source"].alias("head_source"))
    before = before.join(second, "cluster", "left")
    joined = members.filter("ord != cluster").withColumn("t", _effective_trust())
    rows = lookup(joined, before.hint("shuffle_hash"), ["cluster"])
    rows = rows.withColumn("earlier", F.filter("leaders", lambda e: e["ord"] < F.col("ord")))
    rows = rows.withColumn("lead", F.element_at("earlier", -1))
    return rows.withColumn("wins", F.col("t") > F.col("lead")["t"])


def _before(field: str) -> Column:
    """The business's value of a field just before this sighting joined, NULL if it had none."""
    last = _last_filled(F.col("earlier"), field)
    first = F.col(f"s_{field}")
    if field == "lat":
        return F.when(last.isNotNull(), F.struct(last["lat"].alias("lat"), last["lng"].alias("lng"))).when(
            first["ord"] < F.col("ord"), F.struct(first["lat"].alias("lat"), first["lng"].alias("lng")))
    return F.coalesce(last[field], F.when(first["ord"] < F.col("ord"), first[field]))


def conflicts(events: DataFrame) -> DataFrame:
    """Values that lost: cluster, ord (of the sighting), field, kept, dropped, dropped_source.

    A table rather than a list in the record, because a busy business may have any number of them.
    """
    lead_source = F.col("lead")["source"]
    entries = []
    # columns of their own, so that each is worked out once, and only where the sighting has a value itself
    events = events.withColumns({f"_had_{f}": F.when(_filled(f) & (F.col("wins") if f == "lat" else F.lit(True)), _before(f)) for f in ["lat", *_LOGGED]})
    old = F.col("_had_lat")
    moved = distance_km(F.col("lat"), F.col("lng"), old["lat"], old["lng"]) > 0.2

    def pair(lat: Column, lng: Column) -> Column:
        return F.concat_ws(",", lat.cast("string"), lng.cast("string"))

    entries.append(F.when(F.col("wins") & _filled("lat") & old.isNotNull() & moved, F.struct(
        F.lit(0).alias("pos"), F.lit("lat,lng").alias("field"), pair(F.col("lat"), F.col("lng")).alias("kept"),
        pair(old["lat"], old["lng"]).alias("dropped"), lead_source.alias("dropped_source"))))
    for pos, f in enumerate(_LOGGED, start=1):
        had, new = F.col(f"_had_{f}"), F.col(f)
        entries.append(F.when(_filled(f) & had.isNotNull() & (had != new), F.struct(
            F.lit(pos).alias("pos"), F.lit(f).alias("field"),
            F.when(F.col("wins"), new).otherwise(had).alias("kept"),
            F.when(F.col("wins"), had).otherwise(new).alias("dropped"),
            F.when(F.col("wins"), lead_source).otherwise(F.col("source")).alias("dropped_source"))))
    return (events.select("cluster", "ord", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
            .select("cluster", "ord", "e.*"))


def decisions(events: DataFrame, dropped: DataFrame) -> DataFrame:
    """The log of merges and of records dropped for an empty name."""
    level = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("via") + 1)
    value = (F.when(F.col("via") == PID, F.col("place_id")).when(F.col("via") == PHONE, F.col("phone"))
             .when(F.col("via") == NAME_ADDR, F.concat_ws("|", norm_name("name"), address_key("addr")))
             .otherwise(norm_name("name")))
    merged = events.select(
        "ord", F.lit("merged").alias("action"), F.lit("").alias("reason"), level.alias("key"), value.alias("key_value"),
        "cluster", "kept_name",
        F.when(F.col("second_source") < F.col("ord"), F.lit(MULTI_SOURCE)).otherwise(F.col("head_source")).alias("kept_source"),
        F.coalesce(_before("addr"), F.lit("")).alias("kept_addr"),
        F.col("name").alias("merged_name"), F.col("source").alias("merged_source"), F.col("addr").alias("merged_addr"))
    gone = dropped.select("ord", F.lit("dropped").alias("action"), "reason", F.col("name").alias("merged_name"),
                          F.col("source").alias("merged_source"))
    return merged.unionByName(gone, allowMissingColumns=True)


class Resolution:
    """One run of entity resolution and the tables that come out of it, each computed on demand."""

    def __init__(self, records: DataFrame):
        self._records = conform(records)
        keyed = keyed_records(self._records)
        self.clusters = resolve(self._records, keyed)
        self.dropped = dropped_nameless(keyed)
        # businesses, conflicts and decisions all read these: worked out once, when first asked for
        self._stored: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = materialise(make(), name)
        return self._stored[name]

    @property
    def members(self) -> DataFrame:
        return self._once("members", lambda: mark_deciding(self._records, self.clusters))

    @property
    def items(self) -> DataFrame:
        return self._once("items", lambda: list_items(self.members))

    @property
    def state(self) -> DataFrame:
        return self._once("state", lambda: merge_state(self.members))

    def businesses(self) -> DataFrame:
        lists = united_lists(self.items, self.members)
        return survivors(self.state, lists)

    def events(self) -> DataFrame:
        return merge_events(self.members, self.state, self.items)

    def conflicts(self) -> DataFrame:
        return conflicts(self.events())

    def decisions(self) -> DataFrame:
        return decisions(self.events(), self.dropped)
