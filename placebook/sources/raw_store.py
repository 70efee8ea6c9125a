"""Raw rows and record tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from placebook.operators.ordering import number_rows
from placebook.schema import RECORD, conform

# fixed values: sources in mapping order; a record's position starts with its source's
SOURCE_ORDER = ["osm", "gmaps_browser", "manual_csv", "directories"]


def append_raw(rows: DataFrame, root: str, source: str, batch: int) -> None:
    """Add a search's raw rows, untouched, under source and batch.

    Writing a batch again replaces it, so a retried batch never doubles its rows. `row_id` fixes the
    order of arrival within the batch once, when the rows are written.
    """
    (rows.withColumn("row_id", F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(f"{root}/source={source}/batch={batch}"))


def read_raw(spark: SparkSession, root: str, source: str, schema: T.StructType) -> DataFrame:
    """All raw rows of a source with batch and row_id; a source never collected is empty."""
    full = T.StructType([*schema.fields, T.StructField("row_id", T.LongType()), T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(full).parquet(f"{root}/source={source}")
    except AnalysisException as e:                               # anything but a missing path is an error
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def in_run_order(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Give every raw row its position `ord`: sources in mapping order, then batch, then arrival.

    Merges and ties depend on this order, so it is worked out once, before anything is mapped.
    """
    keys = None
    for rank, source in enumerate(SOURCE_ORDER):
        if source in raw:
            part = raw[source].select(F.lit(rank).alias("source_rank"), "batch", "row_id")
            keys = part if keys is None else keys.unionByName(part)
    numbered = number_rows(keys, [F.col("source_rank"), F.col("batch"), F.col("row_id")], "ord")
    return {source: raw[source].join(
        numbered.filter(F.col("source_rank") == SOURCE_ORDER.index(source)).drop("source_rank"), ["batch", "row_id"])
        for source in SOURCE_ORDER if source in raw}


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Mapped records of all sources in one frame."""
    out = None
    for source in SOURCE_ORDER:
        if source in parts:
            part = conform(parts[source])
            out = part if out is None else out.unionByName(part)
    return out


def mapping_stats(raw: dict[str, DataFrame], mapped: dict[str, DataFrame]) -> DataFrame:
    """Per source: raw rows, mapped records, and the unmappable rows between them (no name)."""
    counts = None
    for source in SOURCE_ORDER:
        if source in raw:
            n_raw = raw[source].agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("raw"))
            n_out = mapped[source].agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("mapped"))
            part = n_raw.join(n_out, "source")
            counts = part if counts is None else counts.unionByName(part)
    return counts.withColumn("unmappable", F.col("raw") - F.col("mapped"))


def write_stage(records: DataFrame, root: str, stage: str) -> None:
    """Store a stage; only the canonical schema passes."""
    conform(records).write.mode("overwrite").parquet(f"{root}/stages/{stage}")


def read_stage(spark: SparkSession, root: str, stage: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(f"{root}/stages/{stage}")
