"""Open map elements: type, id, lat, lon, center(lat, lon), tags map<string,string>, _fetched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import clean_phone, clean_phones, first_filled, first_of, month_label, strip

ELEMENT = ("type string, id bigint, lat double, lon double, center struct<lat:double,lon:double>, "
           "tags map<string,string>")

# fixed values: which elements each profile selects - element type, tag, pattern of the tag's value
SELECTORS = {
    "census": [
        ("node", "shop", "."), ("way", "shop", "."),
        ("node", "amenity", "restaurant|cafe|fast_food|pharmacy|bank|school|place_of_worship"),
        ("node", "office", "."), ("node", "healthcare", "."),
    ],
    "prospects": [
        ("node", "amenity", "^(restaurant|cafe|fast_food|food_court|pharmacy)$"),
        ("way", "amenity", "^(restaurant|cafe|fast_food|food_court|pharmacy)$"),
        ("node", "shop", "^(supermarket|convenience|bakery|greengrocer|chemist|deli|general|beverages|butcher)$"),
        ("way", "shop", "^(supermarket|convenience|bakery|greengrocer|chemist|deli|general)$"),
        ("node", "healthcare", "^pharmacy$"),
    ],
}
# fixed values: tags that name the category, and tags that hold phones
LABEL_TAGS = ["shop", "amenity", "healthcare", "office", "craft", "tourism", "leisure"]
PHONE_TAGS = ["phone", "contact:phone", "contact:mobile", "mobile"]


def tag(key: str) -> Column:
    return F.coalesce(F.try_element_at("tags", F.lit(key)), F.lit(""))


def _place() -> tuple[Column, Column]:
    """A way carries its place in `center`."""
    return F.coalesce("lat", F.col("center")["lat"]), F.coalesce("lon", F.col("center")["lon"])


def select_elements(elements: DataFrame, profile: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Elements of the profile's kinds inside a (south, west, north, east) box."""
    south, west, north, east = box
    lat, lng = _place()
    tests = [(F.col("type") == kind) & tag(key).rlike(words) for kind, key, words in SELECTORS[profile]]
    return elements.filter(lat.between(south, north) & lng.between(west, east)
                           & reduce(lambda a, b: a | b, tests))


def label_of() -> Column:
    """The first category tag: the key itself for 'yes', else the first value with blanks for underscores."""
    out = []
    for key in LABEL_TAGS:
        value = strip(F.substring_index(tag(key), ";", 1))
        out.append(F.when(tag(key) != "", F.when(value == "yes", F.lit(key))
                          .otherwise(F.replace(value, F.lit("_"), F.lit(" ")))))
    return F.coalesce(*out, F.lit(""))


def map_osm(elements: DataFrame) -> DataFrame:
    lat, lng = _place()
    numbers = clean_phones(F.flatten(F.array(*[F.split(tag(k), ";") for k in PHONE_TAGS])))
    phones = F.col("_phones")
    house = F.concat_ws(" ", F.nullif(tag("addr:housenumber"), F.lit("")), F.nullif(tag("addr:street"), F.lit("")))
    parts = [house, first_filled(tag("addr:suburb"), tag("addr:district")), tag("addr:city"), tag("addr:state")]
    source = F.concat(F.lit("OpenStreetMap ("), month_label("_fetched"), F.lit(")"))
    hours = tag("opening_hours")
    keep = ["ord"] if "ord" in elements.columns else []
    return elements.withColumn("_phones", numbers).select(
        *keep,
        strip(first_filled(tag("name"), tag("name:en"), tag("brand"))).alias("name"),
        lat.alias("lat"), lng.alias("lng"),
        F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts]).alias("addr"),
        tag("addr:street").alias("street"), label_of().alias("label"),
        first_of(phones).alias("phone"), phones.alias("phones_all"),
        clean_phone(tag("contact:whatsapp")).alias("whatsapp"),
        first_filled(tag("website"), tag("contact:website"), tag("url")).alias("website"),
        first_filled(tag("email"), tag("contact:email")).alias("email"),
        tag("contact:instagram").alias("instagram"), tag("contact:facebook").alias("facebook"),
        tag("contact:twitter").alias("twitter"),
        F.concat(F.lit("https://www.openstreetmap.org/"), F.coalesce("type", F.lit("node")), F.lit("/"),
                 F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("maps"),
        source.alias("source"), F.array(source).alias("sources_all"), F.col("_fetched").alias("added"),
        F.when(hours != "", F.concat(F.lit("Opening hours (OSM): "), hours)).otherwise("").alias("notes"),
    ).filter("name != ''")
