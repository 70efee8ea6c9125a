"""Category tree and keyword rules: a starter set, and the loaders for a full one.

A directory project brings its own tree and its own ordered rules: `Taxonomy.load` reads them from
files of any size (columns below). What is stated here is only a starter set, in the same order of
precedence, so that the package works out of the box.

* tree:   ord, grp, sub                    every subcategory a report must list, found or not
* rules:  ord, grp, sub, key               first rule whose key occurs in the listing's text wins
* legacy: ord, category, key               the same for the flat 18-category column
* terms:  ord, grp, term                   what to search for, per group
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# fixed values: the 29 groups, in report order
GROUPS = [
    "Retail & Groceries", "Fashion & Clothing", "Phones & Technology", "Printing & Business Services",
    "Food & Restaurants", "Baking & Desserts", "Catering & Events Food", "Bars & Entertainment",
    "Beauty & Personal Care", "Health & Medical", "Fitness & Wellness", "Education & Children",
    "Religious & Community", "Events & Creative Services", "Real Estate & Property", "Professional Services",
    "Insurance & Finance", "Logistics & Delivery", "Laundry & Cleaning", "Automotive",
    "Construction & Building", "Power & Energy", "Furniture & Interiors", "Home Services", "Security",
    "Hospitality", "Water & Utilities", "Agriculture & Food Supply", "Other Local Services",
]

# fixed values: starter rules in order of precedence - group, subcategory, keys
STARTER_RULES = [
    ("Health & Medical", "Dentists", ["dentist", "dental"]),
    ("Health & Medical", "Pharmacies", ["pharmac", "chemist"]),
    ("Health & Medical", "Laboratories", ["laborator"]),
    ("Health & Medical", "Opticians", ["optic", "eye clinic"]),
    ("Health & Medical", "Hospitals", ["hospital"]),
    ("Health & Medical", "Clinics", ["clinic", "doctor"]),
    ("Beauty & Personal Care", "Barbers", ["barb"]),
    ("Beauty & Personal Care", "Spas", ["spa"]),
    ("Beauty & Personal Care", "Hair Salons", ["hair", "salon"]),
    ("Fitness & Wellness", "Gyms", ["gym", "fitness"]),
    ("Education & Children", "Montessori Schools", ["montessori"]),
    ("Education & Children", "Nursery Schools", ["nursery", "school", "academy"]),
    ("Religious & Community", "Mosques", ["mosque"]),
    ("Religious & Community", "Churches", ["church", "parish", "chapel"]),
    ("Automotive", "Tyre Dealers", ["tyre", "tire"]),
    ("Automotive", "Car Wash", ["car wash", "carwash"]),
    ("Automotive", "Mechanics", ["mechanic", "auto repair", "car repair"]),
    ("Power & Energy", "Solar Installers", ["solar"]),
    ("Power & Energy", "Generator Dealers", ["generator"]),
    ("Construction & Building", "Plumbers", ["plumb"]),
    ("Construction & Building", "Building Material Shops", ["building material", "cement"]),
    ("Furniture & Interiors", "Furniture Shops", ["furniture"]),
    ("Home Services", "Pest Control", ["pest control", "fumigat"]),
    ("Laundry & Cleaning", "Laundry Businesses", ["laundr"]),
    ("Security", "Security Companies", ["security"]),
    ("Logistics & Delivery", "Courier Services", ["courier"]),
    ("Logistics & Delivery", "Logistics Companies", ["logistic"]),
    ("Printing & Business Services", "Printers", ["print"]),
    ("Phones & Technology", "Phone Shops", ["phone", "telecom"]),
    ("Phones & Technology", "Computer Shops", ["computer"]),
    ("Insurance & Finance", "Insurance Companies", ["insurance"]),
    ("Insurance & Finance", "Banking Agents", ["bank"]),
    ("Real Estate & Property", "Estate Agents", ["estate agent", "real estate"]),
    ("Professional Services", "Lawyers", ["lawyer"]),
    ("Professional Services", "Accountants", ["account"]),
    ("Events & Creative Services", "Photographers", ["photograph"]),
    ("Catering & Events Food", "Caterers", ["cater"]),
    ("Baking & Desserts", "Bakeries", ["baker", "bake"]),
    ("Bars & Entertainment", "Lounges", ["lounge"]),
    ("Bars & Entertainment", "Bars", ["bar"]),
    ("Food & Restaurants", "Fast Food", ["fast food", "takeaway"]),
    ("Food & Restaurants", "Restaurants", ["restaurant", "diner"]),
    ("Fashion & Clothing", "Tailors", ["tailor", "sewing"]),
    ("Fashion & Clothing", "Boutiques", ["boutique", "cloth", "fashion"]),
    ("Agriculture & Food Supply", "Veterinary Services", ["veterinar"]),
    ("Water & Utilities", "Sachet Water Producers", ["sachet water", "pure water"]),
    ("Hospitality", "Guest Houses", ["guest house", "guesthouse"]),
    ("Hospitality", "Hotels", ["hotel", "suites"]),
    ("Retail & Groceries", "Supermarkets", ["supermarket", "hypermarket"]),
    ("Retail & Groceries", "Provision Stores", ["provision", "grocer", "market", "store", "shop"]),
    ("Other Local Services", "Repair Services", ["repair"]),
    ("Bars & Entertainment", "Clubs", ["club"]),
    ("Bars & Entertainment", "Recreation Centres", ["park "]),
]

# fixed values: starter subcategories that no starter rule yields, so that reports show gaps
STARTER_GAPS = [
    ("Retail & Groceries", "Mini-Marts"), ("Fashion & Clothing", "Shoe Shops"),
    ("Baking & Desserts", "Cake Makers"), ("Education & Children", "Primary Schools"),
    ("Events & Creative Services", "Event Planners"), ("Home Services", "AC Repair"),
    ("Other Local Services", "Key Cutting"),
]

# fixed values: starter rules of the flat legacy column, in order of precedence
STARTER_LEGACY = [
    ("Barbers", ["barb"]),
    ("Pharmacies", ["pharmac", "chemist"]),
    ("Dentists", ["dent", "orthodont"]),
    ("Medical Centres", ["hospital", "clinic", "medical"]),
    ("Salons", ["salon", "spa", "hair"]),
    ("Gyms", ["gym", "fitness"]),
    ("Hotels", ["hotel", "guest house", "lodge"]),
    ("Caterers", ["cater"]),
    ("Event Businesses", ["event", "lounge", "bar", "club"]),
    ("Restaurants", ["restaurant", "fast food", "food", "cafe"]),
    ("Supermarkets", ["supermarket", "grocer", "provision", "market"]),
    ("Churches", ["church", "mosque"]),
    ("Schools", ["school", "academy"]),
    ("Real Estate", ["real estate", "property"]),
    ("Auto Services", ["auto", "mechanic", "tyre"]),
    ("Home Services", ["plumb", "electric", "clean", "laundry"]),
    ("Boutiques", ["boutique", "cloth", "fashion", "shop", "phone"]),
    ("Professional Services", ["legal", "law", "account", "bank", "hr "]),
]
# fixed values: legacy categories decided before the ordered rules, from label and name together
LEGACY_FIRST = [("barb", "Barbers"), ("dent", "Dentists"), ("orthodont", "Dentists")]

# fixed values: starter search terms
STARTER_TERMS = [
    ("Retail & Groceries", "supermarket"), ("Retail & Groceries", "provision store"),
    ("Food & Restaurants", "restaurant"), ("Food & Restaurants", "fast food"),
    ("Bars & Entertainment", "bar"), ("Beauty & Personal Care", "barber shop"),
    ("Health & Medical", "pharmacy"), ("Religious & Community", "church"),
    ("Professional Services", "lawyer"), ("Automotive", "auto mechanic"),
    ("Hospitality", "hotel"), ("Food & Restaurants", "Restaurant"),
]


@dataclass(frozen=True)
class Taxonomy:
    tree: list[tuple[str, str]]              # (grp, sub) in report order
    rules: list[tuple[str, str, str]]        # (grp, sub, key) in order of precedence
    legacy: list[tuple[str, str]]            # (category, key) in order of precedence
    terms: list[tuple[str, str]]             # (grp, term) in plan order

    @classmethod
    def starter(cls) -> "Taxonomy":
        rules = [(g, s, k) for g, s, keys in STARTER_RULES for k in keys]
        subs = dict.fromkeys([(g, s) for g, s, _ in STARTER_RULES] + STARTER_GAPS)
        tree = sorted(subs, key=lambda pair: GROUPS.index(pair[0]))
        return cls(tree, rules, [(c, k) for c, keys in STARTER_LEGACY for k in keys], list(STARTER_TERMS))

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Taxonomy":
        """Tree, rules, legacy and terms from CSV files with a header, ordered by their `ord`.

        The tables stay files, numbered in tasks (`rules_df`, `legacy_df`, ...); a list is read to the driver only when it is asked for.
        """
        return StoredTaxonomy(spark, folder)

    def keys_beyond(self, n: int) -> bool:
        """Whether there are more than n rules or flat keys."""
        return max(len(self.rules), len(self.legacy)) > n

    @property
    def groups(self) -> list[str]:
        found = list(dict.fromkeys(g for g, _ in self.tree))
        return found if "Other Local Services" in found else found + ["Other Local Services"]

    def tree_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, g, s) for i, (g, s) in enumerate(self.tree)],
                                     "tree_ord int, grp string, sub string")

    def groups_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.groups)), "group_ord int, grp string")

    def rules_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, g, s, k) for i, (g, s, k) in enumerate(self.rules)],
                                     "rule_ord int, grp string, sub string, key string")

    def legacy_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, c, k) for i, (c, k) in enumerate(self.legacy)], "legacy_ord int, category string, key string")

    def terms_df(self, spark: SparkSession) -> DataFrame:
        """Search terms without case duplicates; the first spelling stays."""
        from pyspark.sql import functions as F

        return (self._raw_terms(spark).groupBy(F.lower("term").alias("_k"))
                .agg(F.min(F.struct("term_ord", "grp", "term")).alias("t"))
                .select("t.term_ord", "t.grp", "t.term"))

    def _raw_terms(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(self.terms)], "term_ord int, grp string, term string")


class StoredTaxonomy(Taxonomy):
    """A taxonomy whose tables are CSV files of any length (`Taxonomy.load`)."""

    def __init__(self, spark: SparkSession, folder: str):
        vars(self).update(_spark=spark, _folder=folder, _numbered={})    # a frozen dataclass

    def _read(self, name: str, *cols: str) -> DataFrame:
        df = self._spark.read.option("header", True).option("multiLine", True).csv(f"{self._folder}/{name}.csv")
        return df.selectExpr("cast(ord as bigint) ord", *cols)

    def _list(self, name: str, *cols: str) -> list[tuple]:
        return [tuple(r)[1:] for r in self._read(name, *cols).orderBy("ord").collect()]

    @cached_property
    def tree(self) -> list[tuple[str, str]]:
        return self._list("tree", "grp", "sub")

    @cached_property
    def rules(self) -> list[tuple[str, str, str]]:
        return self._list("rules", "grp", "sub", "key")

    @cached_property
    def legacy(self) -> list[tuple[str, str]]:
        return self._list("legacy", "category", "key")

    @cached_property
    def terms(self) -> list[tuple[str, str]]:
        return self._list("terms", "grp", "term")

    def keys_beyond(self, n: int) -> bool:
        return any(self._read(name, "key").limit(n + 1).count() > n for name in ("rules", "legacy"))

    def _table(self, name: str, number: str, *cols: str) -> DataFrame:
        """The file's rows, numbered from 0 in their order, without passing the driver."""
        from pyspark.sql import functions as F

        from placebook.operators.ordering import number_rows

        if name not in self._numbered:
            rows = self._read(name, *cols).withColumn("_row", F.monotonically_increasing_id())
            self._numbered[name] = number_rows(rows, [F.col("ord"), F.col("_row")], "_nth")
        return self._numbered[name].select((F.col("_nth") - 1).cast("int").alias(number), *cols)

    def tree_df(self, spark: SparkSession) -> DataFrame:
        return self._table("tree", "tree_ord", "grp", "sub")

    def rules_df(self, spark: SparkSession) -> DataFrame:
        return self._table("rules", "rule_ord", "grp", "sub", "key")

    def legacy_df(self, spark: SparkSession) -> DataFrame:
        return self._table("legacy", "legacy_ord", "category", "key")

    def _raw_terms(self, spark: SparkSession) -> DataFrame:
        return self._table("terms", "term_ord", "grp", "term")
