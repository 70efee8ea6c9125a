"""Stages of a run, stored one by one, so that a run that died goes on where it stopped.

Every stage has a mark: a hash of its name, its settings, what it read and the marks of the stages before it. A stage is
finished when its mark is written, which happens after its table; a stage whose mark is there is read back and not run.
So a run started again begins at the first stage without one, and a change of settings or inputs begins at the first
stage it touches. Each mark carries the stage's counts and seconds, and together they are the run's metrics.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from placebook.schema import RECORD, conform

#: Changes with the rules of the stages themselves.
VERSION = "3"
MARK = "run_id string, mark string, state string, seconds double, spark_version string, counts map<string,bigint>"


def mark_of(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()


def files_of(df: DataFrame | None) -> list[str]:
    """The files that a table is read from; Spark never writes two tables to one name."""
    return sorted(df.inputFiles()) if df is not None else []


class Stages:
    """The stored stages of one run below `root`."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, *base: object):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        self.marks: dict[str, str] = {"": mark_of(VERSION, *base)}
        self.ran: list[str] = []                                 # in this session, for those who ask what was resumed

    def _mark_path(self, name: str) -> str:
        return f"{self.root}/metrics/stage={name}"

    def _state(self, name: str) -> tuple[str, str] | None:
        try:
            row = self.spark.read.schema(MARK).parquet(self._mark_path(name)).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return (row["mark"], row["state"]) if row else None

    def _note(self, name: str, state: str, seconds: float, counts: dict[str, int]) -> None:
        row = [(self.run_id, self.marks[name], state, seconds, self.spark.version, counts)]
        self.spark.createDataFrame(row, MARK).coalesce(1).write.mode("overwrite").parquet(self._mark_path(name))

    def keep(self, name: str, make: Callable[[], DataFrame], after: tuple[str, ...] = ("",), settings: object = None,
             canonical: bool = False, counts: dict[str, Column] | None = None) -> DataFrame:
        """The stage's table: read back if it is finished, else made, stored and marked.

        after: the stages it reads; settings: what else decides its result; canonical: only the record's schema passes;
        counts: further aggregates to note, beside the number of rows.
        """
        self.marks[name] = mark_of(name, settings, *[self.marks[a] for a in after])
        path = f"{self.root}/stages/{name}"
        before = self._state(name)
        if before == (self.marks[name], "done"):
            return self._read(path, canonical)
        start = time.monotonic()
        if before:
            self._note(name, "running", 0.0, {})                 # what was stored before is no longer vouched for
        df = make()
        (conform(df) if canonical else df).write.mode("overwrite").parquet(path)
        out = self._read(path, canonical)
        noted = out.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (counts or {}).items()]).first().asDict()
        self._note(name, "done", time.monotonic() - start, {k: int(v or 0) for k, v in noted.items()})
        self.ran.append(name)
        return out

    def keep_all(self, name: str, make: Callable[[], dict[str, DataFrame]], after: tuple[str, ...], settings: object = None) -> dict[str, DataFrame]:
        """A stage of several small tables (reports, checks) below a folder of its name, under one mark that counts their rows."""
        self.marks[name] = mark_of(name, settings, *[self.marks[a] for a in after])
        path = f"{self.root}/{name}"
        before = self._state(name)
        if before == (self.marks[name], "done"):
            names = self.spark.read.schema(MARK).parquet(self._mark_path(name)).first()["counts"]
            return {t: self.spark.read.parquet(f"{path}/{t}") for t in names}
        start = time.monotonic()
        if before:
            self._note(name, "running", 0.0, {})
        counts = {}
        for table, df in make().items():
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/{table}")
            counts[table] = seen.get["n"]
        self._note(name, "done", time.monotonic() - start, counts)
        self.ran.append(name)
        return {t: self.spark.read.parquet(f"{path}/{t}") for t in counts}

    def _read(self, path: str, canonical: bool) -> DataFrame:
        return self.spark.read.schema(RECORD).parquet(path) if canonical else self.spark.read.parquet(path)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per stage of a run: stage, run_id, mark, state, seconds, spark_version, counts."""
    return spark.read.parquet(f"{root.rstrip('/')}/metrics")
