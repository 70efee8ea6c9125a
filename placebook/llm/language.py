"""Language identification by the nearest of several centroids per language.

Method: letters of the whole text, lower-cased, as byte n-grams (2 and 3) hashed to DIMS counts; sublinear
TF times IDF, normalised. Each language has CENTROIDS clusters of its training snippets (spherical k-means);
a text gets the language of the centroid with the highest cosine. It is rejected when its best cosine lies
below what training snippets of its length reach at least, times a margin.

The model is fitted on a bounded sample: at most SAMPLE_ROWS rows for each of the LANGUAGES most
frequent languages and MAX_SAMPLE in all, those
with the smallest hashes, one snippet of SNIPPET characters each. Judging reads every whole text.

Null texts and texts without a letter are `und` with score 0, and rejected. Without training rows every text
is `und`. Repeated rows get equal results. Long texts are counted in pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placebook.llm.common import batches, mix64, sample_of_each, utf8_buffer

DIMS, CENTROIDS = 8192, 3
SAMPLE_ROWS, LANGUAGES, MAX_SAMPLE, SNIPPET = 400, 500, 8000, 1500
LENGTHS = (16, 32, 64, 128, 256, 512, 1024)
MARGIN, TEMPERATURE = 0.6, 0.05
PIECE = 1 << 19                                                  # bytes counted at once: the arrays take some 70 times that
UNDETERMINED = "und"

_BYTE = np.full(256, 32, np.uint8)
_BYTE[97:123] = np.arange(97, 123)
_BYTE[65:91] = np.arange(97, 123)
_BYTE[128:] = np.arange(128, 256)
_MIX = mix64(np.arange(1, 4, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_SHIFT = np.uint32(32 - 13)


def counts(texts: pa.Array) -> np.ndarray:
    """(texts, DIMS) n-gram counts of whole texts."""
    raw, starts = utf8_buffer(pc.utf8_lower(texts.cast(pa.string())))
    out = np.zeros(len(texts) * DIMS, np.float32)
    for begin in range(0, len(raw), PIECE):
        at = max(begin - 2, 0)                                   # n-grams over the seam
        b = _BYTE[raw[at:begin + PIECE]]
        of = np.searchsorted(starts, np.arange(at, at + len(b)), "right") - 1
        code = b.astype(np.uint32)
        for n in (2, 3):
            if len(b) < n:
                continue
            gram = sum(code[i:len(b) - n + 1 + i] * _MIX[i] for i in range(n)) * np.uint32(0x9E3779B1)
            gram = (gram >> _SHIFT) ^ np.uint32(n & 1)
            keep = (of[n - 1:] == of[:len(b) - n + 1]) & ~((b[:len(b) - n + 1] == 32) & (b[1:len(b) - n + 2] == 32))
            new = np.arange(len(keep)) + n - 1 + at >= begin     # each n-gram belongs to the piece of its last byte
            keep &= new
            out += np.bincount(of[:len(keep)][keep] * DIMS + gram[keep], minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), DIMS)


@dataclass
class Model:
    names: list[str]
    idf: np.ndarray
    centroids: np.ndarray                                        # (languages * clusters, DIMS)
    language: np.ndarray                                         # of each centroid
    floor: np.ndarray                                            # least cosine of training snippets by length

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        v = np.log1p(tf) * self.idf
        return v / np.maximum(np.sqrt((v * v).sum(1)), 1e-12)[:, None]

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, rejected."""
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(counts(texts)) @ self.centroids.T
        per = np.stack([cosine[:, self.language == i].max(1) for i in range(len(self.names))], 1)
        best = per.argmax(1)
        weight = np.exp((per - per.max(1, keepdims=True)) / TEMPERATURE)
        score = (weight.max(1) / weight.sum(1)).astype(float)
        length = np.array([len(t) if t else 0 for t in texts.to_pylist()])
        least = np.interp(np.log2(np.maximum(length, 1)), np.log2(LENGTHS), self.floor) * MARGIN
        least[length < LENGTHS[0]] = 0
        blank = np.array([not any(map(str.isalpha, t or "")) for t in texts.to_pylist()], bool)   # Unicode category L
        names = [UNDETERMINED if b else self.names[i] for i, b in zip(best, blank, strict=True)]
        return names, np.where(blank, 0.0, score), blank | (per.max(1) < least)


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from spread-out starts."""
    starts = [0]
    while len(starts) < min(k, len(x)):
        starts.append(int((x @ x[starts].T).max(1).argmin()))
    c = x[starts]
    for _ in range(12):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
        c = c / np.maximum(np.sqrt((c * c).sum(1)), 1e-12)[:, None]
    return c


def train(docs: DataFrame) -> Model:
    """docs (doc_id, text, lang): the rows to learn from."""
    cut = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SNIPPET, F.lit(0)) + 1) + 1
    able = docs.filter("text is not null and lang is not null and text rlike '[A-Za-z\\\\u0080-\\\\uFFFF]'")
    able = able.select("lang", "doc_id", F.substr("text", cut.cast("int"), F.lit(SNIPPET)).alias("text"))
    rows = (sample_of_each(able, "lang", "doc_id", SAMPLE_ROWS, LANGUAGES, docs.filter("lang is not null"))
            .orderBy("nth", "lang").limit(MAX_SAMPLE).select("lang", "text").collect())
    names = sorted({r["lang"] for r in rows})
    none = np.zeros((0, DIMS), np.float32)
    if not names:
        return Model([], np.ones(DIMS, np.float32), none, np.zeros(0, int), np.zeros(len(LENGTHS)))
    lang = np.array([names.index(r["lang"]) for r in rows])
    texts = [r["text"] for r in rows]

    def tf(some: list[str]) -> np.ndarray:
        return np.concatenate([counts(pa.array(some[i:i + 256])) for i in range(0, len(some), 256)])

    seen = tf(texts)
    model = Model(names, np.log((1 + len(rows)) / (1 + (seen > 0).sum(0))).astype(np.float32) + 1, none, np.zeros(0, int), np.zeros(len(LENGTHS)))
    x = model.vectors(seen)
    parts = [_clusters(x[lang == i], CENTROIDS) for i in range(len(names))]
    model.centroids = np.concatenate(parts).astype(np.float32)
    model.language = np.repeat(np.arange(len(names)), [len(p) for p in parts])
    for i, n in enumerate(LENGTHS):
        short = [t[:n] for t in texts]
        cosine = model.vectors(tf(short)) @ model.centroids.T
        own = np.array([cosine[j, model.language == lang[j]].max() for j in range(len(short))])
        model.floor[i] = np.quantile(own[[len(t) >= n // 2 for t in short]] if any(len(t) >= n // 2 for t in short) else own, 0.002)
    return model


def identify(docs: DataFrame, model: Model, with_text: bool = True) -> DataFrame:
    """The rows with columns lang_pred, score, rejected behind them (columns of these names are replaced)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)                 # (languages x CENTROIDS x DIMS floats)
    names = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in names])
    kept = [c for c in docs.columns if with_text or c != "text"]

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in batches(batch, "text"):
                for i in range(0, part.num_rows, 256):
                    some = part.slice(i, 256)
                    lang, score, rejected = shared.value.judge(some.column("text"))
                    yield pa.RecordBatch.from_arrays(
                        [*[some.column(c) for c in kept], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                        names=[*kept, *names])

    schema = StructType([docs.schema[c] for c in kept]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(judge, schema)
