"""Detail pages and API answers: items map<string, struct<label,href>>, about array<string>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import clean_phone, strip

# fixed values: chips of the detail page - pattern, group, key, value; the first pattern that fits counts
CHIPS = [
    (r"^(offers |has )?no-contact delivery", "Service options", "No-contact delivery", True),
    (r"^(no|doesn.t offer) delivery", "Service options", "Delivery", False),
    (r"^(offers )?delivery", "Service options", "Delivery", True),
    (r"^(no|doesn.t offer) takeout", "Service options", "Takeout", False),
    (r"^(offers )?takeout|^(offers )?takeaway", "Service options", "Takeout", True),
    (r"^(offers |serves )?dine-in", "Service options", "Dine-in", True),
    (r"^(offers )?catering", "Dining options", "Catering", True),
]
API_FIELDS = ["internationalPhoneNumber", "nationalPhoneNumber", "websiteUri", "userRatingCount", "rating"]


def _entries(test) -> Column:
    return F.filter(F.map_entries("items"), lambda e: test(e["key"], e["value"]))


def _last(entries: Column) -> Column:
    return F.try_element_at(entries, F.lit(-1))


def chips(about: Column | str = "about") -> Column:
    """array<struct<group,key,value>> of the labels that fit a chip, in page order."""
    about = F.col(about) if isinstance(about, str) else about

    def chip(label: Column) -> Column:
        text = F.lower(strip(F.coalesce(label, F.lit(""))))
        out = None
        for pattern, group, key, value in CHIPS:
            made = F.struct(F.lit(group).alias("group"), F.lit(key).alias("key"), F.lit(value).alias("value"))
            out = F.when(text.rlike(pattern), made) if out is None else out.when(text.rlike(pattern), made)
        return out

    return F.array_compact(F.transform(F.coalesce(about, F.array().cast("array<string>")), chip))


def attributes(found: Column) -> Column:
    """Chips as {group: [{key: value}, …]}: a key at its first place with its last value."""
    groups = list(dict.fromkeys(g for _, g, _, _ in CHIPS))

    def entries(group: str) -> Column:
        mine = F.filter(found, lambda c: c["group"] == group)
        keys = F.array_distinct(F.transform(mine, lambda c: c["key"]))
        return F.transform(keys, lambda k: F.create_map(
            k, F.element_at(F.filter(mine, lambda c: c["key"] == k), -1)["value"]))

    pairs = F.array(*[F.struct(F.lit(g), entries(g)) for g in groups])
    return F.map_from_entries(F.filter(pairs, lambda p: F.size(p["col2"]) > 0))


def parse_details(raw: DataFrame) -> DataFrame:
    """phone, website, addr, order_url and attrs of every detail page, beside its key."""
    phone = _last(_entries(lambda k, v: k.startswith("phone:tel:")))["key"]
    order = _last(_entries(lambda k, v: k.startswith("action:4") & (F.coalesce(v["href"], F.lit("")) != "")))
    website = F.try_element_at("items", F.lit("authority"))["href"]
    addr = F.try_element_at("items", F.lit("address"))["label"]
    return raw.withColumns({
        "phone": clean_phone(F.replace(F.coalesce(phone, F.lit("")), F.lit("phone:tel:"), F.lit(""))),
        "website": F.coalesce(website, F.lit("")),
        "addr": strip(F.regexp_replace(F.coalesce(addr, F.lit("")), r"(?U)^Address:\s*", "")),
        "order_url": F.coalesce(order["value"]["href"], F.lit("")),
        "attrs": attributes(chips()),
    }).drop("items", "about")


def latest_answers(raw: DataFrame, key: str = "key", at: str = "fetched_at") -> DataFrame:
    """The latest API answer per place, reduced to the fields that are used."""
    return (raw.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"data.{f}").alias(f) for f in API_FIELDS]), at).alias("d"))
            .select(key, "d.*"))
