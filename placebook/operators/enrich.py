"""Filling records from websites, detail pages and API answers: whom to look up, and what to apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placebook.functions.contacts import SOCIAL_FIELDS, extract_contacts, is_social_site
from placebook.functions.scoring import OTHER, category_of
from placebook.functions.text import blank, clean_phone, first_filled
from placebook.operators.matching import first_come
from placebook.operators.ordering import first_rows
from placebook.operators.skew import lookup
from placebook.schema import BASIS_FULL, CHANNELS, CORE_ZONE, OUTSIDE, RING_ZONE, UNASSIGNED
from placebook.session import materialise
from placebook.sources.map_cards import api_id_in, place_id_in

# fixed values: paths of a site that come after its home page, best first
SITE_PATHS = ["/contact", "/contact-us", "/about", "/order", "/delivery"]
# fixed values: free calls per month and kind of API call
FREE_CALLS = {"essentials": 10_000, "pro": 5_000, "enterprise": 1_000}
DETAIL_URL = "https://www.google.com/maps/place/"


def contact_channels() -> Column:
    """How many of the six channels a record has."""
    count = F.lit(0)
    for field in CHANNELS:
        count = count + (~blank(field)).cast("int")
    return count


def inside_catchment() -> Column:
    return ~F.col("area").isin(OUTSIDE, UNASSIGNED)


def detail_key() -> Column:
    """The place id, else the one in the map address, else the address before its query."""
    return first_filled("place_id", place_id_in("maps"), F.substring_index("maps", "?", 1))


# ------------------------------------------------------------------------ whom to look up

def most_reviewed() -> list[Column]:
    """Many reviews first, unknown last."""
    return [F.col("reviews").isNull().cast("int"), -F.coalesce("reviews", F.lit(0))]


def detail_candidates(records: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """Records worth a visit to their detail page, most reviewed first, within what is left of the limit.

    Known pages (`key`) count against the limit.
    """
    fresh = (records.withColumn("key", detail_key())
             .filter(F.col("maps").startswith(DETAIL_URL) & inside_catchment() & (category_of() != OTHER))
             .join(known.select("key").distinct(), "key", "left_anti"))
    left = max(0, limit - known.count())
    return first_rows(fresh, most_reviewed(), left).orderBy(*most_reviewed(), "ord")


def api_candidates(records: DataFrame, known: DataFrame, top: int, in_scope_only: bool = False) -> DataFrame:
    """Records worth a paid call: incomplete ones first, then by reviews; the top ones not known yet.

    The top is taken first, then the known ones leave it, so a second run does not move on to others.
    """
    able = records.withColumn("key", api_id_in("maps")).filter((F.col("key") != "") & inside_catchment())
    if in_scope_only:
        able = able.filter(category_of() != OTHER)
    complete = (~blank("phone") & ~blank("website")).cast("int")
    best = first_rows(able, [complete, *most_reviewed()], top)
    return best.join(known.select("key").distinct(), "key", "left_anti")


def site_rank() -> Column:
    return F.when(F.col("zone") == CORE_ZONE, 0).when(F.col("zone") == RING_ZONE, 1).otherwise(2)


def site_order() -> list[Column]:
    return [site_rank(), -F.coalesce("reviews", F.lit(0)), F.col("ord")]


def site_candidates(records: DataFrame, limit: int) -> DataFrame:
    """Records whose website to read: catchment first, then by reviews."""
    return first_rows(records.filter(~blank("website")), site_order()[:-1], limit)


def quota(usage: DataFrame, ceiling_pct: int) -> DataFrame:
    """Calls used, allowed and left per month and kind; usage: at, sku."""
    free = F.lit(0)
    for sku, n in FREE_CALLS.items():
        free = F.when(F.col("sku") == sku, n).otherwise(free)
    ceiling = F.floor(free * ceiling_pct / 100).cast("bigint")
    return (usage.groupBy(F.date_format("at", "yyyy-MM").alias("month"), "sku")
            .agg(F.count(F.lit(1)).alias("used"))
            .withColumn("ceiling", ceiling)
            .withColumn("remaining", F.greatest(F.lit(0), F.col("ceiling") - F.col("used"))))


# ------------------------------------------------------------------------ what was found

def site_contacts(pages: DataFrame, paths: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Contacts per website from its saved pages (website, path, html): the lists of all pages united.

    Pages count in this order: the home page, the known paths, then the others by path. All stored pages
    are read; `paths` (known ones to read besides the home page) and `limit` (so many of a site's pages)
    narrow that. Of several versions of a page the latest by `fetched_at` counts, if there is that column;
    equal ones settle by their text. Each distinct contact is kept, so a list is as long as the site's own.
    """
    rank = F.when(F.col("path").isin("", "/"), 0)
    for i, path in enumerate(SITE_PATHS, start=1):
        rank = rank.when(F.col("path") == path, i)
    usable = pages.withColumn("rank", F.struct(rank.otherwise(len(SITE_PATHS) + 1).alias("known"), F.col("path"))).filter("html != ''")
    if paths is not None:
        usable = usable.filter(F.col("path").isin("", "/", *paths))
    version = F.struct("fetched_at", "html") if "fetched_at" in pages.columns else F.struct("html")
    one_each = usable.groupBy("website", "rank").agg(F.max(version)["html"].alias("html"))
    if limit is not None:
        nth = F.row_number().over(Window.partitionBy("website").orderBy("rank"))
        one_each = one_each.withColumn("nth", nth).filter(F.col("nth") <= limit).drop("nth")
    lists = ["emails", "phones", "whatsapp", *SOCIAL_FIELDS, "delivery"]
    ordering = F.col("order_online") | (F.col("rank.path") == "/order")
    found = materialise(extract_contacts(one_each).select("website", "rank", *lists, ordering.alias("order_online")), "contacts")

    def tagged(name: str) -> Column:
        return F.transform(name, lambda v, i: F.struct(F.lit(name).alias("kind"), v.alias("value"), i.alias("pos")))

    items = F.concat(*map(tagged, lists))
    each = (found.select("website", "rank", F.explode(items).alias("x")).groupBy("website", "x.kind", "x.value")
            .agg(F.min(F.struct("rank", "x.pos")).alias("at")))

    def listed(name: str) -> Column:
        whole = F.collect_list(F.when(F.col("kind") == name, F.struct("at", "value")))
        return F.transform(F.array_sort(whole), lambda e: e["value"])

    whole = each.groupBy("website").agg(*[listed(name).alias(name) for name in lists])
    sites = found.groupBy("website").agg(F.bool_or("order_online").alias("order_online")).join(whole, "website", "left")
    none = F.array().cast("array<string>")
    return sites.select("website", *[F.coalesce(name, none).alias(name) for name in lists], "order_online")


def social_site_contacts(records: DataFrame) -> DataFrame:
    """For records whose website is a profile on a network: the contacts the address itself holds."""
    links = (records.filter(~blank("website") & is_social_site("website")).select("website").distinct()
             .withColumn("html", F.concat(F.lit('<a href="'), "website", F.lit('"></a>'))))
    return extract_contacts(links).drop("html")


# ------------------------------------------------------------------------ applying it

def guard_phones(records: DataFrame, found: DataFrame, order: list[Column]) -> DataFrame:
    """Which found phone becomes a record's own: ord, phone.

    `found` has ord and phones (best first). A record without a phone takes the first found one that no
    record uses; records choose in the given order, so a number goes to the first that wants it.
    """
    used = records.filter(~blank("phone")).select("phone").distinct()
    lacking = records.filter(blank("phone")).join(found.select("ord", "phones"), "ord")
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    asked = lacking.select(F.col("ord").alias("record"), rank.alias("rank"), F.posexplode("phones").alias("pos", "phone"))
    free = lookup(asked, used.withColumn("used", F.lit(True)), ["phone"]).filter("used is null")
    wishes = free.groupBy("record", "rank").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "phone"))),
        lambda e: F.struct(e["phone"].alias("key"), F.lit(0).alias("tag"))).alias("choices"))
    served = first_come(wishes.select(F.struct("rank", "record").alias("ord"), "choices"))
    return served.select(F.col("ord.record").alias("ord"), F.col("choice").alias("phone"))


def _with_phones(records: DataFrame, found: DataFrame, given: DataFrame, own_first: bool, relist: Column) -> DataFrame:
    """Join found contacts (ord, found_phones, …) and granted phones; extend phones_all where `relist`.

    The record's own number leads its list: as it was before (own_first False) or as it is now.
    """
    out = (records.join(found, "ord", "left")
           .join(given.withColumnRenamed("phone", "_granted"), "ord", "left"))
    phones = F.coalesce("found_phones", F.array().cast("array<string>"))
    before = F.filter(F.array(F.col("phone")), lambda p: p != "")
    after = F.filter(F.array(first_filled("phone", "_granted")), lambda p: p != "")
    front = after if own_first else before
    grown = F.array_distinct(F.concat(front, F.coalesce("phones_all", F.array().cast("array<string>")), phones))
    return (out.withColumn("phones_all", F.when(relist, grown).otherwise(F.col("phones_all")))
            .withColumn("phone", first_filled("phone", "_granted")).drop("_granted", "found_phones"))


def apply_site_contacts(records: DataFrame, contacts: DataFrame) -> DataFrame:
    """Fill records from the contacts of their website; nothing a record has is displaced."""
    columns = records.columns
    renamed = contacts.select("website", F.lit(True).alias("read"), *[
        F.col(c).alias(f"f_{c}") for c in contacts.columns if c != "website"])
    sites = lookup(records.filter(~blank("website")).select("ord", "website"), renamed, ["website"], "inner").drop("website")
    found = sites.withColumn("found_phones", F.col("f_phones"))
    granted = guard_phones(records, found.select("ord", F.col("f_phones").alias("phones")), site_order())
    out = _with_phones(records, found, granted, own_first=False, relist=F.col("read"))
    none = F.array().cast("array<string>")
    signals = F.array_distinct(F.concat("delivery_text_signals", F.coalesce("f_delivery", none),
                                        F.when(F.col("f_order_online"), F.array(F.lit("online ordering"))).otherwise(none)))
    cols = {"email": first_filled("email", F.array_join(F.slice("f_emails", 1, 3), "; ")),
            "whatsapp": first_filled("whatsapp", F.get("f_whatsapp", F.lit(0))),
            "delivery_text_signals": signals}
    for field in SOCIAL_FIELDS:
        cols[field] = first_filled(field, F.get(f"f_{field}", F.lit(0)))
    out = out.withColumns(cols)
    return out.withColumn("contact_channels", F.when(F.col("read"), contact_channels())
                          .otherwise(F.col("contact_channels"))).select(*columns)


def apply_details(records: DataFrame, details: DataFrame, checked: str) -> DataFrame:
    """Apply parsed detail pages (key, phone, website, addr, order_url, attrs); the basis becomes full."""
    columns = records.columns
    renamed = details.select("key", F.lit(True).alias("read"), *[
        F.col(c).alias(f"f_{c}") for c in details.columns if c != "key"])
    keyed = records.select("ord", detail_key().alias("key")).filter("key <> ''")         # records without a place ask for nothing
    found = (lookup(keyed, renamed, ["key"], "inner").drop("key")
             .withColumn("found_phones", F.filter(F.array("f_phone"), lambda p: p != "")))
    granted = guard_phones(records, found.select("ord", F.col("found_phones").alias("phones")), [F.col("ord")])
    out = _with_phones(records, found, granted, own_first=True, relist=F.size("found_phones") > 0)
    none = F.create_map().cast("map<string,array<map<string,boolean>>>")
    old = F.coalesce("additional_info", none)
    fresh = F.coalesce("f_attrs", none)
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(fresh, k))
    meta = F.col("meta")
    cols = {
        "website": first_filled("website", "f_website"),
        "addr": F.when(F.length("f_addr") > F.length("addr"), F.col("f_addr")).otherwise(F.col("addr")),
        "additional_info": F.when(F.col("read"), F.map_concat(kept, fresh)).otherwise(F.col("additional_info")),
        "meta": F.when(F.col("read"), F.struct(
            F.lit(checked).alias("place_page_checked"),
            F.coalesce(F.nullif("f_order_url", F.lit("")), meta["order_online_url"]).alias("order_online_url"),
            meta["delivery_hours"].alias("delivery_hours"))).otherwise(meta),
        "score_basis": F.when(F.col("read"), F.lit(BASIS_FULL)).otherwise(F.col("score_basis")),
    }
    return out.withColumns(cols).select(*columns)


def apply_api(records: DataFrame, answers: DataFrame, source_label: str) -> DataFrame:
    """Apply API answers (key and the five fields): reviews are replaced, the rest is filled."""
    columns = records.columns
    keyed = records.select("ord", api_id_in("maps").alias("key")).filter("key != ''")
    number = clean_phone(first_filled("internationalPhoneNumber", "nationalPhoneNumber"))
    found = (lookup(keyed, answers, ["key"], "inner").drop("key")
             .withColumn("read", F.lit(True)).withColumn("found_phones", F.filter(F.array(number), lambda p: p != "")))
    granted = guard_phones(records, found.select("ord", F.col("found_phones").alias("phones")), [F.col("ord")])
    out = _with_phones(records, found.withColumnRenamed("rating", "f_rating"), granted, own_first=True, relist=F.size("found_phones") > 0)
    listed = F.exists("sources_all", lambda s: F.contains(s, F.lit("Places API")))
    cols = {
        "website": first_filled("website", "websiteUri"),
        "reviews": F.coalesce("userRatingCount", "reviews"),
        "rating": F.coalesce("rating", "f_rating"),
        "sources_all": F.when(F.col("read") & ~listed, F.concat("sources_all", F.array(F.lit(source_label))))
        .otherwise(F.col("sources_all")),
    }
    return out.withColumns(cols).select(*columns)
