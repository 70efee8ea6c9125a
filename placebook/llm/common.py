"""Small helpers shared by the operators: scratch tables, bounded samples, Arrow text buffers, word ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placebook.session import materialise, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Scratch:
    """Tables in the shared folder that cut lineage; superseded ones can be dropped by the name they got."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.paths: dict[int, str] = {}
        self.written: set[str] = set()

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.written.add(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Only for tables from which nothing is read any more."""
        for t in tables:
            if path := self.paths.pop(id(t), None):
                self._delete(path)

    def finish(self, df: DataFrame, name: str) -> DataFrame:
        """Write the result; all other tables of this scratch are of no more use and go."""
        others = list(self.written)
        out = self.keep(df, name)
        for path in others:
            self._delete(path)
        self.written = {self.paths[id(out)]}
        return out

    def _delete(self, path: str) -> None:
        self.written.discard(path)
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def crc_mod(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def _place(key: str) -> Column:
    """A place in [0, 1) by hash, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit("sample")), 11) / F.lit(float(1 << 53))


#: A sample is cut from so many times its rows, chosen by hash; what meets in one task is bounded by that.
SPARE = 4


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most `rows` rows, the same in every run: those whose key has the smallest hashes.

    A count comes first, so that only some SPARE * rows rows leave their tasks, whatever the input's size.
    """
    share = min(1.0, SPARE * rows / max(df.count(), 1))
    return df.filter(_place(key) < share).orderBy(_place(key), F.col(key)).limit(rows)


def sample_of_each(df: DataFrame, by: str, key: str, rows: int, classes: int, counted: DataFrame | None = None) -> DataFrame:
    """At most `rows` rows for each value of `by`, of its `classes` most frequent values; `nth` numbers them.

    `counted` may be a narrower table with `by` to count the classes in. Their counts, `classes` rows at most,
    are broadcast to thin the rows before they are gathered by class.
    """
    sizes = (df if counted is None else counted).groupBy(by).agg(F.count("*").alias("_size")).orderBy(F.col("_size").desc(), by).limit(classes)
    thin = df.join(F.broadcast(sizes), by).filter(_place(key) < F.lit(SPARE * rows) / F.col("_size")).drop("_size")
    order = Window.partitionBy(by).orderBy(_place(key), key)
    return thin.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows)


def batches(of: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Slices of a batch whose texts hold at most max_bytes (one longer text is a slice of its own)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(of.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield of.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield of.slice(start)


def utf8_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins (one more than there are texts; null: empty)."""
    import pyarrow.compute as pc

    texts = pa.concat_arrays([pc.fill_null(texts, "")])          # offset 0, no gaps
    wide = texts.cast(pa.large_string())
    if len(wide) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = wide.buffers()
    starts = np.frombuffer(offsets, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0]:starts[-1]], starts - starts[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


__all__ = ["Scratch", "WORD", "ascii_lower", "batches", "bounded_sample", "crc_mod", "fresh", "materialise", "mix64",
           "sample_of_each", "utf8_buffer"]
