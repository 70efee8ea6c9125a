"""Raw rows as they arrive: mapped and classified, superseded by later rows, search states kept.

Resuming is the stream's own checkpoint. A listing may come back after any time, so no watermark would be right. Rows
go to a log, or into a table that holds the latest row of every key: that table lies in buckets of its keys, and a batch
rewrites the buckets it touches. A batch that runs again (its output was written, but the stream died before
it knew) finds its marker and changes nothing; without the marker it writes the same rows again. Batches are numbered from 0
by every checkpoint, so logs and markers carry the checkpoint's name beside the number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
               files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def append_mapped(raw: DataFrame, mapper: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Map, place and classify rows as they come and append them; nothing is kept between batches."""
    return (mapper(raw).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def stream_name(checkpoint: str) -> str:
    """What tells the batches of one checkpoint from those of another."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def append_log(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append every batch to the log under its stream and number; a batch that is run again replaces itself."""
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/stream={stream_name(checkpoint)}/batch={number}")

    return (rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_rows(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The latest row per key: a later row supersedes earlier ones whenever it comes."""
    rest = [c for c in log.columns if c not in [*key, "stream", "batch"]]
    return (log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*"))


def compact(spark: SparkSession, log: str, out: str, key: list[str], order: list[str]) -> None:
    """Write the current rows of a log as one batch of a new log, to keep reads short."""
    current_rows(spark.read.parquet(log), key, order).write.mode("overwrite").parquet(f"{out}/stream=compacted/batch=0")


# ------------------------------------------------------------------------ a table of the latest rows

BUCKETS = 64


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:                               # anything but a missing path is an error
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """The table that `upsert_latest` keeps."""
    return spark.read.parquet(f"{out}/current").drop("bucket")


def apply_batch(batch: DataFrame, out: str, marker: str, key: list[str], order: list[str], buckets: int = BUCKETS) -> bool:
    """Put a batch's rows into the table of latest rows; False if its marker says that this was done before.

    `order` settles which of two rows of a key is later, and must not leave ties between different rows. Only the
    touched buckets are read and written: a bucket is replaced as a whole when the job commits.
    """
    spark = batch.sparkSession
    done = T.StructType([T.StructField("rows", T.LongType())])
    if _read(spark, f"{out}/applied/{marker}", done) is not None:
        return False
    latest = current_rows(batch, key, order).withColumn("bucket", _bucket(key, buckets)).persist()
    try:
        touched = [r["bucket"] for r in latest.select("bucket").distinct().collect()]        # at most `buckets`
        if touched:
            before = _read(spark, f"{out}/current", latest.schema)
            rows = latest if before is None else latest.unionByName(before.filter(F.col("bucket").isin(touched)))
            fresh = current_rows(rows, key, order).select(*latest.columns).repartition(F.col("bucket"))
            fresh.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{out}/current")
        spark.createDataFrame([(latest.count(),)], done).coalesce(1).write.mode("overwrite").parquet(f"{out}/applied/{marker}")
    finally:
        latest.unpersist()
    return True


def upsert_latest(rows: DataFrame, out: str, checkpoint: str, key: list[str], order: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a table of the latest row per key: a late row changes nothing, a later one replaces its key's row."""
    stream = stream_name(checkpoint)

    def store(batch: DataFrame, number: int) -> None:
        apply_batch(batch, out, f"stream={stream}/batch={number}", key, order, buckets)

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ------------------------------------------------------------------------ search states

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def search_states(events: DataFrame) -> DataFrame:
    """A running table of search states from a stream of events: the latest status per search.

    The latest is the one with the greatest (happened_at, event_id), which both are part of the result, so what is stored
    tells which of two rows of a search is later. State is one row per search. Use with output mode update.
    """
    last = F.max(F.struct("happened_at", "event_id", "status")).alias("last")
    return events.groupBy("source", "term", "area").agg(last).select("source", "term", "area", "last.status", "last.happened_at", "last.event_id")


def keep_states(states: DataFrame, out: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Store the searches that each batch changed in the table of latest states; a new start goes on from the checkpoint.

    State lives in RocksDB, outside the executors' heaps, with its versions in the checkpoint.
    """
    states.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    stream = stream_name(checkpoint)

    def store(batch: DataFrame, number: int) -> None:
        apply_batch(batch, out, f"stream={stream}/batch={number}", ["source", "term", "area"], ["happened_at", "event_id"], buckets)

    return (states.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
