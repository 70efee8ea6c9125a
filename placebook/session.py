"""Session settings the jobs rely on, and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "placebook", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, named by the cluster in spark.checkpoint.dir.

    A temporary folder is used only on a local master that names none (tests, the local bench).
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    where = tempfile.mkdtemp(prefix="placebook-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    The written table survives lost executors (unlike a cache or a local checkpoint), is columnar, so
    later steps read only the columns they use, and cuts the lineage of iterative jobs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counting(df: DataFrame, name: str, test: Column) -> tuple[DataFrame, int]:
    """Materialise, and count the rows that pass a test on the way: no second job.

    For sizes and tests against zero: a task that runs twice may count twice, but never makes something
    of nothing.
    """
    seen = Observation()
    out = materialise(df.observe(seen, F.count_if(test).alias("n")), name)
    return out, seen.get["n"]
