"""The delivery score: eleven visible components, 0 to 100."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import blank
from placebook.operators.skew import lookup
from placebook.schema import BASIS_FLOOR, BASIS_FULL, COMPONENTS

# fixed values: name parts of known chains (substrings, as they are meant)
CHAIN_HINTS = [
    "shoprite", "spar", "ebeano", "justrite", "market square", "addide", "hubmart", "prince ebeano",
    "grocery bazaar", "next cash", "game", "blenco", "everyday", "citydia", "foodco", "marketsquare",
    "medplus", "healthplus", "alpha pharmacy", "juli pharmacy", "nett pharmacy", "emzor", "h medix",
    "chicken republic", "kfc", "domino", "cold stone", "the place", "mr bigg", "tantalizers", "sweet sensation",
    "burger king", "krispy kreme", "coldstone", "genesis", "ntachi osa", "iya eba", "food concepts",
    "shawarma", "chowdeck", "jumia", "glovo",
]
# fixed values: delivery categories with their words, first match wins, and their weights
CATEGORIES = [
    ("Pharmacy", r"pharmac|chemist|drug ?store", 4),
    ("Supermarket / Grocery",
     r"supermarket|grocer|provision|mini ?mart|hypermarket|convenience|food store|market", 10),
    ("Restaurant / Food",
     r"restaurant|fast food|buka|canteen|eatery|cafe|food|bakery|pizza|chicken|shawarma|grill|diner|bistro|"
     r"kitchen|takeaway|caterer", 6),
]
OTHER = "Other"
# fixed values: score bands, highest first
BANDS = [(60, "Hot - approach first"), (40, "Warm - worth a call"), (25, "Cool - lower priority")]
COLD = "Cold - little evidence of delivery"
BAND_NAMES = [name for _, name in BANDS] + [COLD]


def plain_title(name: Column | str = "name") -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name if isinstance(name, Column) else F.col(name), F.lit(""))),
                                   "[^a-z0-9]+", " "))


def attribute(group: str, key: str) -> Column:
    """A chip of the detail page: the first entry of the group that holds the key decides; else NULL."""
    entries = F.try_element_at("additional_info", F.lit(group))
    return F.get(F.filter(entries, lambda e: F.map_contains_key(e, key)), F.lit(0))[key]


def flag_in_text(c: Column | str) -> Column:
    """An attribute that arrives as text: anything but '', no and false means yes."""
    c = F.col(c) if isinstance(c, str) else c
    return ~F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("", "no", "false")


def category_of(label: Column | str = "label", name: Column | str = "name") -> Column:
    text = F.lower(F.concat_ws("  ", label, name))
    out = None
    for category, words, _ in CATEGORIES:
        out = F.when(text.rlike(words), category) if out is None else out.when(text.rlike(words), category)
    return out.otherwise(OTHER)


def order_link() -> Column:
    return ~blank(F.col("meta")["order_online_url"]) | F.array_contains("delivery_text_signals", "online ordering")


def components(is_chain: Column) -> Column:
    """The eleven components as a struct of points."""
    def points(test: Column, value: float) -> Column:
        return F.when(F.coalesce(test, F.lit(False)), F.lit(float(value))).otherwise(F.lit(0.0))

    reviews = F.coalesce("reviews", F.lit(0))
    weight = F.lit(0.0)
    for category, _, value in CATEGORIES:
        weight = F.when(F.col("delivery_category") == category, F.lit(float(value))).otherwise(weight)
    catering = F.coalesce(attribute("Dining options", "Catering"), F.array_contains("delivery_text_signals", "catering"))
    values = {
        "delivery_flag": points(attribute("Service options", "Delivery"), 25),
        "no_contact_delivery": points(attribute("Service options", "No-contact delivery"), 5),
        "takeout": points(attribute("Service options", "Takeout"), 5),
        "delivery_hours": points(~blank(F.col("meta")["delivery_hours"]), 5),
        "catering": points(catering, 15),
        "order_volume": F.when(reviews != 0, F.least(F.lit(25.0), F.round(F.log10(reviews + 1) * 9, 1))).otherwise(0.0),
        "has_website": points(~blank("website"), 8),
        "online_ordering": points(order_link(), 7),
        "chain": points(is_chain, 10),
        "category_weight": weight,
        "rating_4": points(F.coalesce("rating", F.lit(0.0)) >= 4.0, 5),
    }
    return F.struct(*[values[c].alias(c) for c, _, _ in COMPONENTS])


def band_of(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    out = None
    for floor, name in BANDS:
        out = F.when(score >= floor, name) if out is None else out.when(score >= floor, name)
    return out.otherwise(COLD)


def repeated_names(records: DataFrame) -> DataFrame:
    """Plain titles that more than one record bears."""
    return (records.select(plain_title().alias("title")).filter("title != ''").groupBy("title")
            .agg(F.count(F.lit(1)).alias("n_title")).filter("n_title > 1"))


def score_records(records: DataFrame) -> DataFrame:
    """Fill delivery_category, components, score, band and score_basis of every record.

    A name borne by several records marks a chain, counted over all records, in scope or not.
    """
    titled = records.withColumn("title", plain_title())
    counted = lookup(titled, repeated_names(records), ["title"])
    hints = F.array(*[F.lit(h) for h in CHAIN_HINTS])
    is_chain = F.exists(hints, lambda h: F.contains(F.col("title"), h)) | F.col("n_title").isNotNull()
    scored = (counted.withColumn("delivery_category", category_of())
              .withColumn("components", components(is_chain)))
    total = F.lit(0.0)
    for c, _, _ in COMPONENTS:
        total = total + F.col("components")[c]
    return (scored.withColumn("score", F.least(F.lit(100.0), F.round(total, 1)))
            .withColumn("band", band_of("score"))
            .withColumn("score_basis", F.when(F.col("score_basis") == BASIS_FULL, BASIS_FULL).otherwise(BASIS_FLOOR))
            .select(*records.columns))


def in_scope(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("delivery_category") != OTHER)
