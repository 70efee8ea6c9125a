"""Result cards of a map search: aria, href, stars, leaves array<string>, website, _fetched, _kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import clean_phone, column, first_of, month_label, street_of, strip

# fixed values: texts on a card that are neither category nor address
NOISE = ["·", "", "Website", "Directions", "Order online", "Reserve a table", "Menu", "Book online", "Delivery",
         "Takeout", "Dine-in", "Sponsored"]
STATUS = r"(?iU)^(?:·\s*)?(open|closed|opens|closes|temporarily closed|permanently closed|open 24 hours)\b"
PHONE = r"(?U)^\+?\d[\d\s\-()]{7,}$"
REVIEWS = r"^\(([\d,]+)\)$"
STARS = r"(?i)([\d.]+)\s*stars?(?:\s*([\d,]+)\s*review)?"
# a rating, the text "no reviews", or glyphs of an icon font
SKIPPED = r"(?iU)^(?:\d(?:\.\d)?|no reviews|[\uE000-\uF8FF\s]+)$"


def place_id_in(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(column(url), F.lit("")), "!1s(0x[0-9a-f]+:0x[0-9a-f]+)", 1)


def api_id_in(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(column(url), F.lit("")), r"!19s(ChIJ[\w\-]+)", 1)


def point_in(url: Column | str) -> tuple[Column, Column]:
    text = F.coalesce(column(url), F.lit(""))
    pattern = r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)"
    return (F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double"),
            F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).try_cast("double"))


def own_website(url: Column | str) -> Column:
    """A web address whose host is not the map's own; else ''."""
    text = F.coalesce(column(url), F.lit(""))
    host = F.get(F.split(text, "/"), F.lit(2))
    return F.when(text.startswith("http") & ~F.contains(host, F.lit("google.")), text).otherwise("")


def _count(text: Column) -> Column:
    return F.nullif(F.replace(text, F.lit(","), F.lit("")), F.lit("")).try_cast("int")


def parse_cards(raw: DataFrame) -> DataFrame:
    """Card pieces as fields: name, label, addr, phone_raw, rating, reviews, lat, lng, place_id, website, maps.

    The category is the first text left when noise, ratings, counts, phones and opening times are gone;
    the address is the second.
    """
    keep = [c for c in ("ord", "_fetched", "_kind") if c in raw.columns]
    # step by step, so that each list is worked out once and not once per field taken from it
    texts = F.transform(F.coalesce("leaves", F.array().cast("array<string>")), strip)
    cards = raw.select(*keep, strip(F.coalesce("aria", F.lit(""))).alias("name"), texts.alias("texts"),
                       F.coalesce("stars", F.lit("")).alias("stars"), "href", "website")
    cards = cards.withColumn("texts", F.filter("texts", lambda t: ~t.isin(NOISE) & (t != F.col("name")) & ~t.rlike(SKIPPED)))
    cards = cards.withColumns({
        "counts": F.filter("texts", lambda t: t.rlike(REVIEWS)), "phones": F.filter("texts", lambda t: t.rlike(PHONE)),
        "words": F.filter("texts", lambda t: ~t.rlike(REVIEWS) & ~t.rlike(PHONE) & ~t.rlike(STATUS) & ~t.rlike("^[·₦]"))})
    lat, lng = point_in("href")
    label, addr = first_of(F.col("words")), F.coalesce(F.get("words", F.lit(1)), F.lit(""))
    # a rating that passed for a category, or a price for an address: the card has neither
    wrong = label.rlike(r"^[\d.]+\(") | addr.startswith("₦")
    return cards.select(
        *keep, "name",
        F.when(wrong, "").otherwise(label).alias("label"), F.when(wrong, "").otherwise(addr).alias("addr"),
        first_of(F.col("phones")).alias("phone_raw"),
        F.nullif(F.regexp_extract("stars", STARS, 1), F.lit("")).try_cast("double").alias("rating"),
        F.coalesce(_count(F.regexp_extract("stars", STARS, 2)),
                   _count(F.regexp_extract(first_of(F.col("counts")), REVIEWS, 1))).alias("reviews"),
        lat.alias("lat"), lng.alias("lng"), place_id_in("href").alias("place_id"),
        own_website("website").alias("website"), F.coalesce("href", F.lit("")).alias("maps"))


def map_cards(raw: DataFrame) -> DataFrame:
    cards = parse_cards(raw).filter("name != ''").withColumn("phone", clean_phone("phone_raw"))
    phone = F.col("phone")
    source = F.concat(F.lit("Google Maps ("), F.coalesce("_kind", F.lit("sweep")), F.lit(", "),
                      month_label("_fetched"), F.lit(")"))
    return cards.select(
        *[c for c in ("ord",) if c in cards.columns], "name", "place_id", "lat", "lng", "addr",
        street_of("addr").alias("street"), "label", "phone",
        F.filter(F.array(phone), lambda p: p != "").alias("phones_all"), "website", "rating", "reviews", "maps",
        source.alias("source"), F.array(source).alias("sources_all"), F.col("_fetched").alias("added"))
