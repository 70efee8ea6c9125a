"""The canonical business record and its fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: markers, zones and statuses that appear in outputs
OUTSIDE = "Outside catchment"
UNASSIGNED = "Unassigned"
CORE_ZONE = "Core catchment"
RING_ZONE = "Ring area"
UNCLASSIFIED_GROUP = "Other Local Services"
UNCLASSIFIED_SUB = "Unclassified (needs review)"
MULTI_SOURCE = "Multiple sources (cross-verified)"
NOT_CONTACTED = "Not Contacted"
BASIS_FULL = "Full"
BASIS_FLOOR = "Floor - not enriched"

# fixed values: the channels counted in contact_channels
CHANNELS = ["phone", "website", "email", "instagram", "facebook", "linkedin"]

# fixed values: fields a merge may fill or overwrite (coordinates travel as one pair)
SURVIVING_TEXT = [
    "phone", "website", "maps", "addr", "street", "label", "legacy18", "place_id", "whatsapp",
    "email", "instagram", "facebook", "twitter", "linkedin", "tiktok",
]
SURVIVING_NUMBERS = ["rating", "reviews"]
# fixed values: fields whose disagreements are not worth a conflict entry
QUIET_FIELDS = ["rating", "reviews", "maps", "street", "label", "legacy18"]

_ATTRS = T.MapType(T.StringType(), T.ArrayType(T.MapType(T.StringType(), T.BooleanType())))
_META = T.StructType([
    T.StructField("place_page_checked", T.StringType()),
    T.StructField("order_online_url", T.StringType()),
    T.StructField("delivery_hours", T.StringType()),
])

# score components in display order: column name, display name, most points
COMPONENTS = [
    ("delivery_flag", "Google Delivery flag", 25),
    ("no_contact_delivery", "No-contact delivery", 5),
    ("takeout", "Takeout", 5),
    ("delivery_hours", "Delivery hours published", 5),
    ("catering", "Catering offered", 15),
    ("order_volume", "Order-volume proxy (reviews)", 25),
    ("has_website", "Has website", 8),
    ("online_ordering", "Online ordering / menu", 7),
    ("chain", "Chain / multi-branch", 10),
    ("category_weight", "Category weight", 10),
    ("rating_4", "Rating 4.0+", 5),
]
COMPONENTS_TYPE = T.StructType([T.StructField(c, T.DoubleType()) for c, _, _ in COMPONENTS])

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_LIST = T.ArrayType(T.StringType())
RECORD = T.StructType([
    T.StructField("ord", T.LongType()),            # position in the run: order decides merges and ties
    T.StructField("name", _S), T.StructField("place_id", _S),
    T.StructField("area", _S), T.StructField("zone", _S),
    T.StructField("street", _S), T.StructField("addr", _S),
    T.StructField("lat", _D), T.StructField("lng", _D),
    T.StructField("grp", _S), T.StructField("sub", _S),
    T.StructField("legacy18", _S), T.StructField("label", _S),
    T.StructField("phone", _S), T.StructField("phones_all", _LIST),
    T.StructField("whatsapp", _S), T.StructField("website", _S), T.StructField("email", _S),
    T.StructField("instagram", _S), T.StructField("facebook", _S), T.StructField("twitter", _S),
    T.StructField("linkedin", _S), T.StructField("tiktok", _S),
    T.StructField("contact_channels", _I),
    T.StructField("rating", _D), T.StructField("reviews", _I),
    T.StructField("additional_info", _ATTRS), T.StructField("meta", _META),
    T.StructField("delivery_text_signals", _LIST),
    T.StructField("priority", _S), T.StructField("package", _S), T.StructField("contactable", _S),
    T.StructField("verification", _S), T.StructField("sales_status", _S), T.StructField("notes", _S),
    T.StructField("score", _D), T.StructField("band", _S),
    T.StructField("components", COMPONENTS_TYPE), T.StructField("score_basis", _S),
    T.StructField("delivery_category", _S),
    T.StructField("source", _S), T.StructField("sources_all", _LIST),
    T.StructField("maps", _S), T.StructField("added", _S),
])


def conform(df: DataFrame) -> DataFrame:
    """Bring a frame to the canonical schema; an unknown column is an error.

    Absent text is '' and absent numbers are NULL, so no text column is ever NULL.
    """
    unknown = sorted(set(df.columns) - set(RECORD.names))
    if unknown:
        raise ValueError(f"unknown record columns: {unknown}")
    out = []
    for field in RECORD.fields:
        if field.name in df.columns:
            col = F.col(field.name).cast(field.dataType)
        else:
            col = F.lit(None).cast(field.dataType)
        if field.name == "sales_status":
            col = F.coalesce(F.nullif(col, F.lit("")), F.lit(NOT_CONTACTED))
        elif field.name == "sources_all":
            col = F.when(F.size(F.coalesce(col, F.array())) > 0, col).otherwise(F.array(F.col("source")))
        elif field.dataType == _S:
            col = F.coalesce(col, F.lit(""))
        elif field.dataType == _LIST:
            col = F.coalesce(col, F.array().cast(_LIST))
        out.append(col.alias(field.name))
    return df.select(*out)
