"""Every registered query: (spark, folder of the tables) -> DataFrame, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS, CENSUS_CORE, Area
from placebook.catalog import adapters as A
from placebook.functions import geo, rules, scoring
from placebook.functions.contacts import extract_contacts, is_social_site, unescape
from placebook.functions.provenance import source_kind, trust
from placebook.functions.text import poi_reason, slugs, street_of
from placebook.operators import centroids, enrich, frontier, quality, reports
from placebook.operators.ordering import census_order, number_rows, prospect_order
from placebook.operators.resolve import Resolution, with_match_keys
from placebook.plans import profiles
from placebook.schema import COMPONENTS
from placebook.session import materialise, scratch_path
from placebook.sources import csv_import, directories, map_cards, osm, place_details
from placebook.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TODAY = "2026-12-01"
PROFILE = profiles.census_profile()
# shapes for the two other geometry tests, and a registry with every kind of area
CORRIDOR = Area("Strip", corridor=((6.53, 3.34), (6.59, 3.40), 2.0))
POLYGON = Area("Block", polygon=((6.52, 3.335), (6.55, 3.33), (6.575, 3.36), (6.60, 3.365), (6.595, 3.40), (6.56, 3.385), (6.53, 3.405)))
MIXED = [CORRIDOR, POLYGON, CENSUS_AREAS[3], Area("Ikeja", aliases=("Ikeja GRA",))]
FLOORS = {"Ilupeju": 100_000, "Gbagada": 1, "Ojota": 100_000}
SWEEPS = [(6.5613, 3.3721, 14), (6.5030, 3.3620, 14)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_stages: dict[tuple, object] = {}


def stage(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    """A finished stage of the run over this folder: queries over finished records share it."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stages:
        _stages[key] = make()
    return _stages[key]


def ready(spark: SparkSession, folder: str) -> DataFrame:
    """Sightings with area and category."""
    return profiles.classify(profiles.place(A.sightings(spark, folder), PROFILE, TODAY), PROFILE)


def resolution(spark: SparkSession, folder: str) -> Resolution:
    return stage(spark, folder, "resolution", lambda: Resolution(materialise(ready(spark, folder), "ready")))


def merged(spark: SparkSession, folder: str) -> DataFrame:
    return stage(spark, folder, "merged", lambda: materialise(resolution(spark, folder).businesses(), "merged"))


def businesses(spark: SparkSession, folder: str) -> DataFrame:
    return stage(spark, folder, "businesses", lambda: materialise(
        profiles.finish_businesses(merged(spark, folder), PROFILE)[0], "businesses"))


def attributed(spark: SparkSession, folder: str) -> DataFrame:
    """Businesses with chips and signals as enrichment would leave them."""
    i = F.col("ord")

    def chip(test: Column, key: str, value: Column) -> Column:
        return F.when(test, F.create_map(F.lit(key), value))

    service = F.array_compact(F.array(
        chip(i % 3 == 0, "Delivery", i % 6 != 3), chip(i % 9 == 0, "No-contact delivery", F.lit(True)),
        chip(i % 4 == 1, "Takeout", F.lit(True)), chip(i % 3 == 0, "Delivery", F.lit(True))))
    dining = F.array_compact(F.array(chip(i % 10 == 0, "Catering", F.lit(True))))
    # every fifth name loses its number, so that some names repeat
    return businesses(spark, folder).withColumns({
        "name": F.when(i % 5 == 0, F.regexp_replace("name", " [0-9]+.*$", "")).otherwise(F.col("name")),
        "additional_info": F.create_map(F.lit("Service options"), service, F.lit("Dining options"), dining),
        "delivery_text_signals": F.when(i % 7 == 2, F.array(F.lit("catering"), F.lit("online ordering"))).otherwise(
            F.array().cast("array<string>")),
        "meta": F.struct(F.lit(TODAY).alias("place_page_checked"),
                         F.when(i % 8 == 3, F.lit("https://order.example")).alias("order_online_url"),
                         F.lit(None).cast("string").alias("delivery_hours")),
        "score_basis": F.when(i % 2 == 0, "Full").otherwise("")})


def scored(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> DataFrame:
        records = attributed(spark, folder)
        return materialise(scoring.score_records(records), "scored")
    return stage(spark, folder, "scored", make)


def prospects(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.in_scope(scored(spark, folder))


def joined(c: Column | str) -> Column:
    return F.array_join(c, "; ")


# ------------------------------------------------------------------------ text, rules, provenance

@query
def clean_phone(spark, folder):
    return A.sightings(spark, folder).select("ord", "phone")


@query
def norm_keys(spark, folder):
    return with_match_keys(A.sightings(spark, folder)).select("ord", "nn", "ak")


@query
def street(spark, folder):
    return A.sightings(spark, folder).select("ord", street_of("addr").alias("street"))


@query
def source_trust(spark, folder):
    return A.sightings(spark, folder).select("ord", source_kind("source").alias("kind"), trust("source").alias("trust"))


@query
def poi_filter(spark, folder):
    """Landmarks among names made of an address and of a business name, with and without a category."""
    i = F.col("ord")
    name = (F.when(i % 5 == 0, F.concat(F.element_at(F.split("addr", ", "), -2), F.lit(" Bus Stop")))
            .when(i % 5 == 1, F.concat("name", F.lit(" Crescent"))).when(i % 5 == 2, F.concat(F.lit("Roundabout "), "name"))
            .otherwise(F.col("name")))
    return A.sightings(spark, folder).select("ord", poi_reason(name, "label").alias("reason"))


@query
def classify(spark, folder):
    return ready(spark, folder).select("ord", "grp", "sub")


@query
def legacy_category(spark, folder):
    return A.sightings(spark, folder).select("ord", rules.legacy_category("label", "name", PROFILE.taxonomy).alias("legacy18"))


@query
def classify_from_tagline(spark, folder):
    """Directory rows without a category are classified from their tagline."""
    return profiles.classify(A.with_tagline(spark, folder), PROFILE).select("ord", "grp", "sub")


@query
def area_slugs(spark, folder):
    """Address parts per area text of the listings' addresses, as a directory would spell them."""
    area = F.concat(F.element_at(F.split("addr", ", "), -2), F.lit(" / "), F.col("label"))
    rows = A.listings(spark, folder).select(area.alias("area")).distinct()
    return rows.select("area", joined(slugs(F.col("area"), F.array(F.lit("Lekki Ph 1")))).alias("slugs"))


# ------------------------------------------------------------------------ geography

@query
def assign_area(spark, folder):
    found = geo.assign_area("lat", "lng", "addr", CENSUS_AREAS)
    rows = A.sightings(spark, folder).withColumn("f", found)
    return rows.select("ord", "f.area", geo.zone_of("f.area", CENSUS_CORE).alias("zone"),
                       F.round("f.distance_km", 6).alias("distance_km"))


@query
def assign_mixed_areas(spark, folder):
    """A corridor, a polygon, a disc and an area that only has a name, in one registry."""
    rows = A.sightings(spark, folder).withColumn("f", geo.assign_area("lat", "lng", "addr", MIXED))
    return rows.select("ord", "f.area", F.round("f.distance_km", 6).alias("distance_km"))


@query
def corridor_test(spark, folder):
    rows = A.sightings(spark, folder).filter("lat is not null")
    d, inside = geo.distance_and_inside(F.col("lat"), F.col("lng"), CORRIDOR)
    return rows.select("ord", F.round(d, 6).alias("distance_km"), inside.alias("inside"))


@query
def polygon_test(spark, folder):
    rows = A.sightings(spark, folder).filter("lat is not null")
    d, inside = geo.distance_and_inside(F.col("lat"), F.col("lng"), POLYGON)
    return rows.select("ord", F.round(d, 6).alias("distance_km"), inside.alias("inside"))


@query
def address_area(spark, folder):
    return A.sightings(spark, folder).select(
        "ord", F.coalesce(geo.area_in_address("addr", CENSUS_AREAS), F.lit("")).alias("area"))


@query
def derive_centroids(spark, folder):
    return centroids.derive_centroids(A.sightings(spark, folder), CENSUS_AREAS).select(
        "area", "n", "lat", "lng", "low_confidence")


@query
def catchment_box(spark, folder):
    """The padded box around discs at the derived centres."""
    found = derive_centroids(spark, folder).filter("n > 0").withColumn("radius_km", F.lit(1.3))
    return centroids.bounding_box(centroids.disc_extremes(found), 2.0)


@query
def geo_stats(spark, folder):
    return reports.geo_stats(ready(spark, folder))


# ------------------------------------------------------------------------ sources

@query
def csv_records(spark, folder):
    out = csv_import.map_csv(A.odd_headers(spark, folder))
    return out.select("ord", "name", "addr", "street", "label", "phone", joined("phones_all").alias("phones_all"), "website",
                      F.col("lat").cast("decimal(9,4)").cast("string").alias("lat"), F.col("lng").isNull().alias("no_lng"),
                      "sales_status", "source", "added")


@query
def osm_selection(spark, folder):
    box = centroids.catchment_box(CENSUS_AREAS, 0.0)
    picked = A.elements(spark, folder)
    census = osm.select_elements(picked, "census", box).select("ord", F.lit(True).alias("census"))
    prospect = osm.select_elements(picked, "prospects", box).select("ord", F.lit(True).alias("prospects"))
    return census.join(prospect, "ord", "full").select(
        "ord", F.coalesce("census", F.lit(False)).alias("census"), F.coalesce("prospects", F.lit(False)).alias("prospects"))


@query
def osm_records(spark, folder):
    out = osm.map_osm(A.elements(spark, folder))
    return out.select("ord", "name", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "addr", "street", "label",
                      "phone", joined("phones_all").alias("phones_all"), "website", "maps", "source", "added", "notes")


@query
def card_records(spark, folder):
    out = map_cards.map_cards(A.cards(spark, folder))
    return out.select("ord", "name", "place_id", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"), "addr", "street",
                      "label", "phone", "website", "rating", "reviews", "source", "added")


@query
def directory_listings(spark, folder):
    out = A.directory_listings(spark, folder)
    return out.select("site", "page_no", "name", "listing_id", "addr", "phone", "lat", "lng", "desc", "sponsored", "category")


def _directory_records(spark: SparkSession, folder: str) -> DataFrame:
    """Listings crawled page by page, the latest version of each, as records."""
    found = directories.drop_sponsored(A.directory_listings(spark, folder))
    raw = found.withColumn("ord", F.col("page_no").cast("bigint") * 1000 + F.col("pos")).withColumn("_fetched", F.lit("2026-10-06"))
    return directories.map_listings(directories.latest_listing(raw))


@query
def directory_records(spark, folder):
    return _directory_records(spark, folder).select("name", "addr", "label", "phone", "lat", "lng", "notes", "source", "added", "maps")


@query
def directory_links(spark, folder):
    return directories.category_links(A.directory_pages(spark, folder)).select("url", "link")


@query
def broken_pages(spark, folder):
    """Pages whose layout changed (every fifth here) must be reported, not read as empty."""
    pages = A.directory_pages(spark, folder)
    changed = F.col("page_no") % 5 == 0
    html = F.when(changed, F.replace("html", F.lit("h3>"), F.lit("h4>"))).otherwise(F.col("html"))
    pages = pages.withColumn("html", html)
    return directories.broken_pages(pages, directories.parse_listings(pages)).select("url")


@query
def sponsored_rows(spark, folder):
    return (directories.drop_sponsored(A.directory_listings(spark, folder))
            .groupBy("site", "page_no").agg(F.count(F.lit(1)).alias("n"), F.count_if("sponsored").alias("n_sponsored")))


@query
def unique_in_crawl(spark, folder):
    rows = A.directory_listings(spark, folder).withColumn("ord", F.col("page_no").cast("bigint") * 1000 + F.col("pos"))
    out = directories.unique_in_crawl(rows, ["site"], ["ord"])
    return out.select("site", "listing_id", "name", "phone", F.col("first_at.ord").alias("first_ord"))


@query
def latest_listing(spark, folder):
    """Finelib sightings as crawled rows: one business seen again replaces its row; some have no id."""
    raw = A.listings(spark, folder).filter("source like 'Finelib%'").select(
        "ord", F.lit("finelib").alias("site"), F.when(F.col("ord") % 5 == 1, "").otherwise(F.col("true_id").cast("string")).alias("listing_id"),
        "name", "phone_raw")
    return directories.latest_listing(raw).select("ord", "listing_id", "name", "phone_raw")


@query
def place_details_parsed(spark, folder):
    out = place_details.parse_details(A.details(spark, folder))

    def chip(group: str, key: str) -> Column:
        entries = F.try_element_at("attrs", F.lit(group))
        return F.get(F.filter(entries, lambda e: F.map_contains_key(e, key)), F.lit(0))[key]

    return out.select("key", "phone", "website", "addr", "order_url",
                      *[chip("Service options", k).alias(n) for k, n in (
                          ("Delivery", "delivery"), ("No-contact delivery", "no_contact"), ("Takeout", "takeout"), ("Dine-in", "dine_in"))],
                      chip("Dining options", "Catering").alias("catering"))


@query
def api_answers_latest(spark, folder):
    out = place_details.latest_answers(A.api_answers(spark, folder))
    return out.select("key", F.col("internationalPhoneNumber").alias("intl"), F.col("websiteUri").alias("web"),
                      F.col("userRatingCount").alias("n_ratings"), F.col("rating").alias("stars"))


@query
def raw_round_trip(spark, folder):
    """Raw rows of all four sources stored in batches, read back and put in run order."""
    from placebook.sources import raw_store

    rows = A.listings(spark, folder).select(F.col("ord").alias("raw_id"), "source", "name")
    root = scratch_path(spark, "raw")
    kinds = {"osm": "OpenStreetMap%", "gmaps_browser": "Google%", "manual_csv": "Manual%", "directories": "Finelib%"}
    raw = {}
    for source, like in kinds.items():
        part = rows.filter(F.col("source").like(like)).repartitionByRange(4, "raw_id").sortWithinPartitions("raw_id")
        for batch in range(2):
            raw_store.append_raw(part.filter(F.col("raw_id") % 2 == batch), root, source, batch)
        raw[source] = raw_store.read_raw(spark, root, source, rows.schema)
    numbered = raw_store.in_run_order(raw)
    out = numbered["osm"]
    for source in ("gmaps_browser", "manual_csv", "directories"):
        out = out.unionByName(numbered[source])
    return out.select("ord", "raw_id", "source", "name")


@query
def source_union(spark, folder):
    """Mapped records of all four sources in one canonical frame, counted by source text."""
    from placebook.sources.raw_store import union_sources

    parts = {"osm": osm.map_osm(A.elements(spark, folder)), "gmaps_browser": map_cards.map_cards(A.cards(spark, folder)),
             "manual_csv": csv_import.map_csv(A.odd_headers(spark, folder)), "directories": _directory_records(spark, folder)}
    return union_sources(parts).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("phone != ''")).alias("with_phone"))


@query
def unmappable_rows(spark, folder):
    """Raw rows without a name, per source."""
    from placebook.sources.raw_store import mapping_stats

    raw = {"osm": A.elements(spark, folder), "gmaps_browser": A.cards(spark, folder), "manual_csv": A.odd_headers(spark, folder)}
    mapped = {"osm": osm.map_osm(raw["osm"]), "gmaps_browser": map_cards.map_cards(raw["gmaps_browser"]),
              "manual_csv": csv_import.map_csv(raw["manual_csv"])}
    return mapping_stats(raw, mapped)


# ------------------------------------------------------------------------ entity resolution

@query
def dedupe_clusters(spark, folder):
    return resolution(spark, folder).clusters.select("ord", "cluster", "via")


@query
def survivorship(spark, folder):
    return merged(spark, folder).select(
        "ord", "name", "grp", "sub", "phone", "website", "addr", "street", "label", "legacy18", "place_id", "maps", "rating",
        "reviews", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "area", "zone", "n_sightings")


@query
def provenance(spark, folder):
    return merged(spark, folder).select("ord", "source", joined("sources_all").alias("sources_all"),
                                        joined("phones_all").alias("phones_all"))


@query
def merge_conflicts(spark, folder):
    return resolution(spark, folder).conflicts().filter("field != 'lat,lng'").select(
        "cluster", "ord", "field", "kept", "dropped", "dropped_source")


@query
def coordinate_conflicts(spark, folder):
    return resolution(spark, folder).conflicts().filter("field = 'lat,lng'").select("cluster", "ord", "dropped_source")


@query
def merge_decisions(spark, folder):
    return resolution(spark, folder).decisions().select(
        "ord", "action", "key", "key_value", "cluster", "kept_name", "kept_source", "kept_addr", "merged_name", "merged_source",
        "merged_addr")


@query
def dedupe_stats(spark, folder):
    res, kept = resolution(spark, folder), businesses(spark, folder)
    parts = [res.members.agg(F.lit("in").alias("what"), F.count(F.lit(1)).alias("n")),
             res.members.agg(F.lit("merged").alias("what"), F.count_if(F.expr("via is not null")).alias("n")),
             kept.agg(F.lit("kept").alias("what"), F.count(F.lit(1)).alias("n")),
             res.conflicts().filter("field != 'lat,lng'").agg(F.lit("conflicts").alias("what"), F.count(F.lit(1)).alias("n"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def combine_runs(spark, folder):
    """Two finished runs as one master: the scored prospects lead, census records join them."""
    prospect_run = prospects(spark, folder)
    census_run = businesses(spark, folder)

    def make() -> DataFrame:
        return materialise(profiles.combine([census_run, prospect_run], profiles.combined_profile())[1], "combined")
    out = stage(spark, folder, "combined", make)
    return out.select("ord", "name", "place_id", "phone", "area", "zone", "priority", "score", "source", "n_sightings")


# ------------------------------------------------------------------------ census

@query
def priority(spark, folder):
    return businesses(spark, folder).select("ord", "priority", "package", "contactable", "verification", "contact_channels")


@query
def census_by_group(spark, folder):
    return reports.group_table(reports.census_cube(businesses(spark, folder)), PROFILE.taxonomy)


@query
def census_kpis(spark, folder):
    return reports.census_kpis(reports.census_cube(businesses(spark, folder)))


@query
def area_summary(spark, folder):
    return reports.area_summary(reports.census_cube(businesses(spark, folder)), CENSUS_AREAS, CENSUS_CORE)


@query
def group_area_matrix(spark, folder):
    return reports.group_area_matrix(reports.census_cube(businesses(spark, folder)), PROFILE.taxonomy, CENSUS_AREAS, CENSUS_CORE)


@query
def tree_coverage(spark, folder):
    return reports.tree_coverage(reports.census_cube(businesses(spark, folder)), PROFILE.taxonomy)


@query
def subs_outside_tree(spark, folder):
    return reports.subs_outside_tree(reports.census_cube(businesses(spark, folder)), PROFILE.taxonomy)


@query
def research_matrix(spark, folder):
    return reports.research_matrix(reports.census_cube(businesses(spark, folder)), PROFILE.taxonomy, CENSUS_AREAS, CENSUS_CORE)


@query
def source_log(spark, folder):
    return reports.source_log(businesses(spark, folder))


@query
def source_mentions(spark, folder):
    return reports.source_mentions_by_kind(businesses(spark, folder))


@query
def channel_counts(spark, folder):
    return reports.channel_counts(businesses(spark, folder))


@query
def summary_counts(spark, folder):
    """Records by area and by group, with the ones that have a phone."""
    records = businesses(spark, folder)
    by_area = records.groupBy(F.lit("area").alias("by"), F.col("area").alias("value"))
    by_group = records.groupBy(F.lit("group").alias("by"), F.col("grp").alias("value"))
    agg = [F.count(F.lit(1)).alias("n"), F.count_if(F.expr("phone != ''")).alias("contactable")]
    return by_area.agg(*agg).unionByName(by_group.agg(*agg))


@query
def top_unclassified(spark, folder):
    return reports.top_unclassified(ready(spark, folder))


@query
def census_list(spark, folder):
    """The census list in its order, with running ids."""
    out = reports.census_export(number_rows(businesses(spark, folder), census_order()), CENSUS_AREAS, TODAY)
    return out.select(
        F.col("ID").alias("id"), F.col("Business Name").alias("name"), F.col("Zone").alias("zone"), F.col("Catchment").alias("area"),
        F.col("Category Group").alias("grp"), F.col("Subcategory").alias("sub"), F.col("Phone").alias("phone"),
        F.col("Programme").alias("programme"), F.col("All Sources").alias("sources"), F.col("Prospect Priority").alias("priority"))


# ------------------------------------------------------------------------ score

@query
def delivery_score(spark, folder):
    return scored(spark, folder).select("ord", "delivery_category", *[F.col("components")[c].alias(c) for c, _, _ in COMPONENTS],
                                        F.round("score", 1).alias("score"), "band", "score_basis")


@query
def chain_names(spark, folder):
    return scoring.repeated_names(attributed(spark, folder)).select("title", "n_title")


@query
def scope_filter(spark, folder):
    return scored(spark, folder).groupBy((F.col("delivery_category") != scoring.OTHER).alias("in_scope")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def bands_and_basis(spark, folder):
    records = prospects(spark, folder)
    return (reports.count_by(records, "band").withColumnRenamed("band", "value")
            .unionByName(reports.count_by(records, "score_basis").withColumnRenamed("score_basis", "value")))


@query
def prospect_kpis(spark, folder):
    return reports.prospect_kpis(reports.prospect_cube(prospects(spark, folder)))


@query
def component_counts(spark, folder):
    return reports.component_counts(reports.prospect_cube(prospects(spark, folder)))


@query
def area_category(spark, folder):
    return reports.area_category(reports.prospect_cube(prospects(spark, folder)), CENSUS_AREAS)


@query
def prospect_list(spark, folder):
    out = reports.prospect_export(number_rows(prospects(spark, folder), prospect_order()), TODAY)
    return out.select(F.col("Rank").alias("rank"), F.col("Business Name").alias("name"), F.col("Area").alias("area"),
                      F.col("Delivery Score").alias("score"), F.col("Band").alias("band"), F.col("Takeout").alias("takeout"),
                      F.col("Phone").alias("phone"), F.col("All Phones").alias("all_phones"))


# ------------------------------------------------------------------------ pages and enrichment

def _contacts(spark: SparkSession, folder: str) -> DataFrame:
    return extract_contacts(A.pages(spark, folder))


@query
def emails(spark, folder):
    return _contacts(spark, folder).select("page_id", joined("emails").alias("emails"))


@query
def whatsapp_numbers(spark, folder):
    return _contacts(spark, folder).select("page_id", joined("whatsapp").alias("whatsapp"))


@query
def page_phones(spark, folder):
    return _contacts(spark, folder).select("page_id", joined("phones").alias("phones"))


@query
def delivery_signals(spark, folder):
    return _contacts(spark, folder).select("page_id", joined("delivery").alias("delivery"), "order_online")


@query
def page_entities(spark, folder):
    """References of every form in texts made of the pages' ids and addresses."""
    n = F.col("page_id").cast("string")
    text = F.concat(F.col("url"), F.lit("?a=1&b="), n, F.lit(" Bread &amp; Butter &#"), F.lit("8358;"), n, F.lit(" caf&eacute; &copy"), n,
                    F.lit(" &notit; &nosuch; &#x1F600 &#150; &#0; &#xD800; &#11;|&#1114112; &; & &amp;amp; &lt;b&gt; fjord&aring &#39"), n)
    return A.read(spark, folder, "pages")["pages"].select("page_id", unescape(text).alias("text"))


@query
def social_profiles(spark, folder):
    return _contacts(spark, folder).select("page_id", *[joined(c).alias(c) for c in enrich.SOCIAL_FIELDS])


@query
def site_contacts(spark, folder):
    out = enrich.site_contacts(A.site_pages(spark, folder))
    return out.select("website", joined("emails").alias("emails"), joined("phones").alias("phones"),
                      joined("whatsapp").alias("whatsapp"), joined("delivery").alias("delivery"), "order_online")


@query
def social_websites(spark, folder):
    """Websites that are profiles on a network, among addresses made of the sightings' ids."""
    url = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("https://www.instagram.com/biz", "http://maps.google.com/x", "shop.fb.com/b",
                                                             "https://myfb.com/b", "https://notx.com/y", "x.com/y")]),
                                (F.col("ord") % 6 + 1).cast("int")), F.col("ord").cast("string"))
    return A.sightings(spark, folder).select("ord", is_social_site(url).alias("social"))


@query
def site_candidates(spark, folder):
    return enrich.site_candidates(businesses(spark, folder), 100).select("ord", "website", "reviews")


def without_phones(spark: SparkSession, folder: str) -> DataFrame:
    """The census with two of three phones gone."""
    return businesses(spark, folder).withColumn("phone", F.when(F.col("ord") % 3 == 0, F.col("phone")).otherwise(""))


@query
def apply_site_contacts(spark, folder):
    records = without_phones(spark, folder)
    found = enrich.site_contacts(A.site_pages(spark, folder))
    out = enrich.apply_site_contacts(records, found)
    return out.select("ord", "email", "phone", "whatsapp", "instagram", joined("phones_all").alias("phones_all"),
                      joined("delivery_text_signals").alias("signals"), "contact_channels")


@query
def phone_guard(spark, folder):
    """Several records want the same few numbers; each goes to the first that gets round to it."""
    i = F.col("ord")
    number = [F.concat(F.lit("+234809"), F.lpad((k).cast("string"), 7, "0")) for k in (i % 40, i % 60, i % 90)]
    records = without_phones(spark, folder)
    found = records.filter("phone = ''").select("ord", F.array(*number).alias("phones"))
    return enrich.guard_phones(records, found, [F.col("ord")]).select("ord", "phone")


@query
def detail_candidates(spark, folder):
    known = place_details.parse_details(A.details(spark, folder)).filter("order_url != ''").select("key")
    limit = 100 + known.count()
    return enrich.detail_candidates(businesses(spark, folder), known, limit).select("ord", "key", "reviews")


@query
def api_candidates(spark, folder):
    known = place_details.latest_answers(A.api_answers(spark, folder)).filter("rating >= 4.5").select("key")
    return enrich.api_candidates(businesses(spark, folder), known, 100).select("ord", "key", "reviews")


@query
def apply_details(spark, folder):
    records = businesses(spark, folder)
    out = enrich.apply_details(records, place_details.parse_details(A.details(spark, folder)), TODAY)
    return out.select("ord", "phone", joined("phones_all").alias("phones_all"), "website", "addr", "score_basis",
                      F.coalesce(F.col("meta")["order_online_url"], F.lit("")).alias("order_url"))


@query
def apply_api(spark, folder):
    records = businesses(spark, folder)
    answers = place_details.latest_answers(A.api_answers(spark, folder))
    out = enrich.apply_api(records, answers, "Google Places API (Dec 2026)")
    return out.select("ord", "phone", joined("phones_all").alias("phones_all"), "website", "reviews",
                      F.round("rating", 1).alias("rating"), F.size("sources_all").alias("n_sources"))


@query
def api_quota(spark, folder):
    usage = A.read(spark, folder, "events")["events"].select(
        F.col("ts").alias("at"), F.when(F.col("event_type") == "click", "enterprise").when(F.col("event_type") == "view", "pro")
        .otherwise("essentials").alias("sku"))
    return enrich.quota(usage, 80)


# ------------------------------------------------------------------------ frontier

def _searches(spark: SparkSession, folder: str) -> DataFrame:
    return frontier.current_searches(A.search_log(spark, folder))


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    """The terms that were ever searched."""
    return A.search_log(spark, folder).select("term").distinct()


BOX = (6.55, 3.36, 6.58, 3.37)


@query
def search_states(spark, folder):
    return _searches(spark, folder).select("term", "area", "status", "raw_count", F.col("error"),
                                           F.unix_micros(F.col("started_at").cast("timestamp")).alias("started_us"),
                                           F.unix_micros(F.col("finished_at").cast("timestamp")).alias("finished_us"))


@query
def search_plan(spark, folder):
    return frontier.sweep_plan(_terms(spark, folder), SWEEPS)


@query
def directory_plan(spark, folder):
    """One search per area seen, and one per page of the paged directory."""
    seen = ready(spark, folder).select("area").distinct()
    return frontier.directory_plan(seen, 150)


@query
def pending_searches(spark, folder):
    """What a plan of all logged searches and the sweeps still has to do."""
    logged = A.search_log(spark, folder).select("source", "term", "area").distinct()
    plan = logged.unionByName(frontier.sweep_plan(_terms(spark, folder), SWEEPS))
    return frontier.pending(plan, _searches(spark, folder)).select("term", "area")


@query
def search_subset(spark, folder):
    return frontier.only(_searches(spark, folder), area="sweep 6.54", term="click 1").select("term", "area", "status")


@query
def forced_searches(spark, folder):
    return frontier.force(A.search_log(spark, folder), ["click 1"], ["topup Gbagada @6.5514,3.3865,15z"],
                          F.current_timestamp()).select("source", "term", "area", "status")


@query
def split_saturated(spark, folder):
    return frontier.saturation_plan(_searches(spark, folder), BOX).select("term", "area")


@query
def top_up_plan(spark, folder):
    return frontier.top_up_plan(ready(spark, folder), _terms(spark, folder), CENSUS_AREAS, FLOORS)


@query
def best_counts(spark, folder):
    return frontier.best_counts(_searches(spark, folder)).select("term", "best")


@query
def suspect_results(spark, folder):
    return frontier.suspect_results(A.search_log(spark, folder)).select("event_id", "term", "raw_count", "before", "signal")


@query
def kept_counts(spark, folder):
    """Sightings inside the catchment per search; each sighting is tied to a logged search by its number."""
    searches = _searches(spark, folder)
    log = A.search_log(spark, folder).select("event_id", "source", "term", "area")
    inside = ready(spark, folder).filter(enrich.inside_catchment()).select(F.col("ord").alias("event_id"))
    return frontier.kept_counts(searches, log.join(inside, "event_id")).select("term", "area", "status", "kept_count")


@query
def search_report(spark, folder):
    return frontier.search_report(_searches(spark, folder)).select(
        "source", "term", "area", "status", F.unix_micros(F.col("started_at").cast("timestamp")).alias("started_us"), "raw_count", "error")


# ------------------------------------------------------------------------ reconciliation

def _published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return profiles.census_reports(businesses(spark, folder), PROFILE, TODAY)


@query
def dq_reconcile_kpis(spark, folder):
    cells = profiles.verify(businesses(spark, folder), PROFILE, _published(spark, folder))["cells"]
    return cells.filter("tbl = 'kpis'").select(F.col("row").alias("kpi"), "published", "recount", "ok")


@query
def dq_reconcile_groups(spark, folder):
    cells = profiles.verify(businesses(spark, folder), PROFILE, _published(spark, folder))["cells"]
    return cells.filter("tbl = 'groups' and row <> 'TOTAL'").select(F.col("row").alias("grp"), "col", "published", "recount", "ok")


@query
def dq_schema(spark, folder):
    return quality.schema_problems(businesses(spark, folder), PROFILE.taxonomy, CENSUS_AREAS)


@query
def dq_unclassified(spark, folder):
    return quality.unclassified_share(businesses(spark, folder))


@query
def dq_shared_phones(spark, folder):
    """Over the sightings, where numbers are shared, rather than over the merged records."""
    return quality.shared_phones(A.sightings(spark, folder))


@query
def dq_shared_ids(spark, folder):
    return quality.shared_place_ids(A.sightings(spark, folder))


@query
def dq_merged_are_distinct(spark, folder):
    """Phones and place ids the finished census still shares without reason."""
    records = businesses(spark, folder)
    phones = quality.shared_phones(records).filter("not ok").select(F.lit("phone").alias("what"), F.col("phone").alias("value"))
    ids = quality.shared_place_ids(records).select(F.lit("place_id").alias("what"), F.col("place_id").alias("value"))
    return phones.unionByName(ids)


@query
def dq_row_counts(spark, folder):
    return profiles.verify(businesses(spark, folder), PROFILE, _published(spark, folder))["row_counts"]


@query
def dq_rules_in_tree(spark, folder):
    """Categories in use that the tree does not list, with how many records they hold."""
    used = ready(spark, folder).groupBy("grp", "sub").agg(F.count(F.lit(1)).alias("n"))
    return used.join(PROFILE.taxonomy.tree_df(spark).select("grp", "sub"), ["grp", "sub"], "left_anti")


@query
def spot_check(spark, folder):
    return quality.spot_check(businesses(spark, folder), "run-1")


# ------------------------------------------------------------------------ streams

@query
def stream_ingest(spark, folder):
    """The orders file as a stream: mapped, placed, classified, appended."""
    tables = A.read(spark, folder, "orders", "part")
    raw = ingest.read_files(spark, folder, tables["orders"].schema, "orders.parquet")
    root = scratch_path(spark, "stream-ingest")

    def mapper(orders: DataFrame) -> DataFrame:
        orders.createOrReplaceTempView("orders")
        tables["part"].createOrReplaceTempView("part")
        flat = spark.sql(A.LISTINGS)
        mapped = A.to_sightings(flat)
        return profiles.classify(profiles.place(mapped, PROFILE, TODAY), PROFILE).select("ord", "phone", "area", "zone", "grp", "sub")

    ingest.append_mapped(raw, mapper, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _in_files(spark: SparkSession, folder: str, root: str, parts: list[int], of: int) -> None:
    """The events in files of their own, dealt by id: each file holds early and late ones."""
    events = A.read(spark, folder, "events")["events"]
    for part in parts:
        (events.filter(F.pmod(F.xxhash64("event_id"), F.lit(of)) == part).coalesce(1).write.mode("append").parquet(f"{root}/part-{part}"))


def _lose_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """What a stream leaves that died after its last batch was written, before that was noted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max((int(f.getPath().getName()), f.getPath()) for f in fs.listStatus(path) if f.getPath().getName().isdigit())[1]
    fs.delete(last, False)


@query
def stream_latest(spark, folder):
    """Late rows supersede nothing, later ones do: the latest event per user and kind, from six files in six batches, one run twice."""
    root = scratch_path(spark, "stream-latest")
    _in_files(spark, folder, f"{root}/in", range(6), 6)
    schema = A.read(spark, folder, "events")["events"].schema

    def go() -> None:
        raw = ingest.read_files(spark, f"{root}/in/*", schema, files_per_trigger=1).select("user_id", "event_type", "event_id", "value")
        ingest.upsert_latest(raw, f"{root}/out", f"{root}/checkpoint", ["user_id", "event_type"], ["event_id"], 8).awaitTermination()

    go()
    _lose_last_commit(spark, f"{root}/checkpoint")
    go()
    return ingest.read_current(spark, f"{root}/out").select("user_id", "event_type", "event_id", F.round("value", 4).alias("value"))


@query
def stream_states(spark, folder):
    """Search states kept up to date by a stream that stops after three files and starts again from its checkpoint for three more."""
    root = scratch_path(spark, "stream-states")
    schema = A.read(spark, folder, "events")["events"].schema

    def go() -> None:
        raw = ingest.read_files(spark, f"{root}/in/*", schema, files_per_trigger=2)
        raw.createOrReplaceTempView("events")
        ingest.keep_states(ingest.search_states(spark.sql(A.SEARCH_LOG)), f"{root}/out", f"{root}/checkpoint", 8).awaitTermination()

    _in_files(spark, folder, f"{root}/in", range(3), 6)
    go()
    _in_files(spark, folder, f"{root}/in", range(3, 6), 6)
    go()
    return ingest.read_current(spark, f"{root}/out").select("term", "area", "status")


from placebook.catalog import large, runs  # noqa: E402,F401 - they register their queries
