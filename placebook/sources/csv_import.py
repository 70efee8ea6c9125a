"""Hand-collected CSV files with loose headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placebook.functions.text import clean_phone, clean_phones, first_filled, first_of, number, street_of, strip
from placebook.schema import NOT_CONTACTED

# fixed values: headers a column may carry, best first
HEADERS = {
    "name": ["name", "business name", "business", "company"],
    "phone": ["phone", "phone number", "telephone", "tel", "mobile", "contact", "phones"],
    "addr": ["address", "full address", "addr", "location"],
    "label": ["category", "type", "label", "business type", "source category"],
    "website": ["website", "web", "url", "site"],
    "email": ["email", "e-mail", "mail"],
    "whatsapp": ["whatsapp", "wa"],
    "instagram": ["instagram", "ig"],
    "facebook": ["facebook", "fb"],
    "lat": ["lat", "latitude"],
    "lng": ["lng", "lon", "long", "longitude"],
    "notes": ["notes", "note", "comments", "sales notes"],
    "sales_status": ["sales status", "status"],
}


def tidy_header(header: str) -> str:
    """Case, underscores, spacing and a byte-order mark do not matter."""
    return " ".join(header.replace("﻿", "").lower().replace("_", " ").split())


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read files that share a header, with the file name of every row in _file."""
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("encoding", "UTF-8").csv(paths)
            .withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1)))


def pending_files(spark: SparkSession, paths: list[str], ledger: DataFrame) -> DataFrame:
    """Files not imported yet, by name and content: path, term. An edited file counts as new."""
    files = spark.read.format("binaryFile").load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    term = F.concat(F.lit("csv:"), name, F.lit(":"), F.substring(F.sha1("content"), 1, 10))
    return files.select("path", term.alias("term")).join(ledger.select("term").distinct(), "term", "left_anti")


def map_csv(raw: DataFrame) -> DataFrame:
    """Canonical records; rows without a name are gone. Keeps ord, _file and _fetched where present."""
    by_header = {tidy_header(c): c for c in raw.columns if not c.startswith("_") and c != "ord"}

    def value(field: str) -> Column:
        found = [strip(F.col(f"`{by_header[h]}`")) for h in HEADERS[field] if h in by_header]
        return first_filled(*found) if found else F.lit("")

    raw = raw.withColumn("_phones", clean_phones(F.split(value("phone"), "[/,;]")))
    phones = F.col("_phones")
    file = F.col("_file") if "_file" in raw.columns else F.lit("import")
    source = F.concat(F.lit("Manual CSV ("), F.coalesce(file, F.lit("import")), F.lit(")"))
    cols = {
        "name": value("name"), "addr": value("addr"), "street": street_of(value("addr")), "label": value("label"),
        "phone": first_of(phones), "phones_all": phones, "whatsapp": clean_phone(value("whatsapp")),
        "website": value("website"), "email": value("email"), "instagram": value("instagram"),
        "facebook": value("facebook"), "lat": number(value("lat")), "lng": number(value("lng")),
        "notes": value("notes"), "sales_status": first_filled(value("sales_status"), F.lit(NOT_CONTACTED)),
        "source": source, "sources_all": F.array(source),
    }
    keep = ["ord"] if "ord" in raw.columns else []
    if "_fetched" in raw.columns:
        cols["added"] = F.coalesce(F.col("_fetched").cast("string"), F.lit(""))
    return raw.select(*keep, *[c.alias(n) for n, c in cols.items()]).filter("name != ''")
