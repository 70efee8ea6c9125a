"""Landmark filter, contactability, verification and sales priority of business records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.areas import CENSUS_AREAS
from placebook.functions.provenance import is_google
from placebook.functions.text import blank, poi_reason

# fixed values: priorities and packages
PRIORITY_A = "A - High commercial relevance"
PRIORITY_B = "B - Potential advertiser"
PRIORITY_C = "C - Ring area, contactable"
PRIORITY_D = "D - Listing only (no contact yet)"
GOOGLE_VERIFIED = "Google-verified"
MAPPED = "Mapped location (OSM)"
DIRECTORY_ONLY = "Directory listing only"


def split_pois(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(businesses, dropped landmarks and bare streets with the reason)."""
    why = records.withColumn("_reason", poi_reason("name", "label"))
    return (why.filter("_reason = ''").drop("_reason"),
            why.filter("_reason != ''").select("ord", "name", "label", "source", F.col("_reason").alias("reason")))


def priority_of(core: list[str]) -> Column:
    """struct(priority, package): a phone first, then core area, then visibility."""
    reviews = F.coalesce("reviews", F.lit(0))
    phone = ~blank("phone")
    is_core = F.col("area").isin(core) if core else F.lit(False)

    def level(priority: str, package: str) -> Column:
        return F.struct(F.lit(priority).alias("priority"), F.lit(package).alias("package"))

    return (F.when(phone & is_core & ((reviews >= 10) | ~blank("website")), level(PRIORITY_A, "Premium"))
            .when(phone & (is_core | (reviews >= 25)), level(PRIORITY_B, "Standard"))
            .when(phone, level(PRIORITY_C, "Listing"))
            .otherwise(level(PRIORITY_D, "Listing")))


def verification_of() -> Column:
    """How the location is known: coordinates alone do not make it Google's."""
    return (F.when(is_google(), GOOGLE_VERIFIED).when(F.col("lat").isNotNull(), MAPPED).otherwise(DIRECTORY_ONLY))


def assign_priority(records: DataFrame, core: list[str]) -> DataFrame:
    level = priority_of(core)
    return records.withColumns({
        "priority": level["priority"], "package": level["package"],
        "contactable": F.when(blank("phone"), "No").otherwise("Yes"), "verification": verification_of()})


def programme(area: Column | str, areas: list[str]) -> Column:
    """Which programme an area belongs to."""
    area = F.col(area) if isinstance(area, str) else area
    return (F.when(area.isin([a.name for a in CENSUS_AREAS]), "Magazine catchment")
            .when(area.isin(areas) if areas else F.lit(False), "Delivery area").otherwise(""))
