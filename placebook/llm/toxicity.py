"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Method: a word enters as its embedding (frequent words of the sample) and the scaled sum of the embeddings of its
character n-grams (3 to 5). Windows of WINDOW words, each overlapping the next, run through a GRU in both directions; attention
pools the states and a logistic unit scores the window. A text's score is its highest window's: all windows of
the whole text are scored. Training knows labels of texts only, so it alternates between finding each text's
highest window and fitting the network to those windows (the first passes use windows at random).

Training is bounded: at most SAMPLE labelled rows per class, those with the smallest hashes among texts of at
most SAMPLE_CHARS characters and SPARE times as many labels; of one id's texts the least. Scoring reads everything. A worker keeps a bounded cache of words' inputs.

Null, empty and blank texts score 0. Without rows of both classes every text scores 0. Null labels teach
nothing; repeated rows get equal scores. Long texts are scored in pieces of windows. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placebook.llm.common import SPARE, batches, sample_of_each

WINDOW, STRIDE = 32, 24
SAMPLE, SAMPLE_CHARS = 1000, 12_000
WORDS, GRAMS = 4000, 8192
EMBED, HIDDEN = 8, 8
PASSES, BATCH, RATE, DROP = 10, 64, 0.01, 0.3
CACHE, CHUNK = 300_000, 2048
SIZES = (3, 4, 5)
_EDGES = "\"'.,;:!?()[]{}<>*_-~`|/\\"


def plain(word: str) -> str:
    return word.strip(_EDGES).lower()


def grams(word: str) -> list[int]:
    """Buckets of the word's character n-grams, its ends marked: stems and endings carry over to unseen words."""
    w = f"<{word}>"
    return [zlib.crc32(w[i:i + n].encode("utf-8", "surrogatepass")) % GRAMS for n in SIZES for i in range(max(len(w) - n + 1, n == 3))]


# CRC-32 of every byte, from which the checksums of all n-grams of many words follow at once
_STEP = np.array([zlib.crc32(bytes([i ^ 255])) ^ 0xFF000000 for i in range(256)], np.uint32)


def all_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """What `grams` gives for each word, one after the other, and how many each has."""
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    per = [np.maximum(length - n + 1, int(n == 3)) for n in SIZES]
    count = sum(per)
    start = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    plain_ones = np.fromiter((bool(w) and w.isascii() for w in words), bool, len(words))
    for i in np.flatnonzero(~plain_ones):
        out[start[i]:start[i] + count[i]] = grams(words[i])
    some = np.flatnonzero(plain_ones)
    if not len(some):
        return out, count
    text = np.frombuffer("".join([f"<{words[i]}>" for i in some.tolist()]).encode() + bytes(max(SIZES)), np.uint8)
    size = length[some]
    total = int(size.sum())
    of = np.repeat(some, size)
    place = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    state, left = np.full(total, 0xFFFFFFFF, np.uint32), length[of] - place
    to = start[of] + place
    for k in range(max(SIZES)):
        state = _STEP[(state ^ text[k:k + total]) & 255] ^ (state >> 8)
        if k + 1 in SIZES:
            fits = left > k
            out[to[fits]] = (~state[fits]) % GRAMS
            to = to + per[SIZES.index(k + 1)][of]
    return out, count


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def gru(g: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: bool):
    """States (T, B, H) for inputs (T, B, 3H) of the gates; what the way back needs, if kept."""
    t_max, b, _ = g.shape
    h, n_h = np.zeros((b, HIDDEN), np.float32), HIDDEN
    states, memory = np.empty((t_max, b, n_h), np.float32), []
    for t in range(t_max):
        a = h @ u
        zr = sigmoid(g[t, :, :2 * n_h] + a[:, :2 * n_h])
        z, r = zr[:, :n_h], zr[:, n_h:]
        n = np.tanh(g[t, :, 2 * n_h:] + r * a[:, 2 * n_h:])
        m = mask[t][:, None]
        new = h + m * (1 - z) * (n - h)
        if keep:
            memory.append((h, z, r, n, a[:, 2 * n_h:], m))
        h = new
        states[t] = h
    return states, memory


def gru_back(d_states: np.ndarray, u: np.ndarray, memory: list):
    t_max, b, n_h = d_states.shape
    dh, du, dg = np.zeros((b, n_h), np.float32), np.zeros_like(u), np.zeros((t_max, b, 3 * n_h), np.float32)
    for t in range(t_max - 1, -1, -1):
        h, z, r, n, un, m = memory[t]
        dh = dh + d_states[t]
        dn = dh * m * (1 - z)
        dz = dh * m * (h - n)
        dan = dn * (1 - n * n)
        da = np.concatenate([dz * z * (1 - z), dan * un * r * (1 - r), dan * r], 1)
        dg[t] = np.concatenate([da[:, :2 * n_h], dan], 1)
        du += h.T @ da
        dh = dh - dn + da @ u.T
    return dg, du


@dataclass
class Network:
    vocabulary: dict[str, int]
    p: dict[str, np.ndarray]

    def inputs(self, words: list[str]) -> np.ndarray:
        """(words, 2, 3H): gate inputs in both directions."""
        return self.gates(*self.features(words))

    def features(self, words: list[str]):
        ids = np.array([self.vocabulary.get(w, 0) for w in words], np.int64)
        return ids, *all_grams(words)

    def embed(self, ids, flat, n) -> np.ndarray:
        starts = np.cumsum(n) - n
        chars = np.add.reduceat(self.p["char"][flat], starts, axis=0) / np.sqrt(n)[:, None]
        return np.concatenate([self.p["word"][ids], chars], 1).astype(np.float32)

    def gates(self, ids, flat, n) -> np.ndarray:
        return (self.embed(ids, flat, n) @ self.p["w"] + self.p["b"]).reshape(-1, 2, 3 * HIDDEN)

    def forward(self, table: np.ndarray, codes: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows (codes: T x B rows of the table)."""
        forth, m1 = gru(table[codes, 0], self.p["u0"], mask, keep)
        back, m2 = gru(table[codes[::-1], 1], self.p["u1"], mask[::-1], keep)
        s = np.concatenate([forth, back[::-1]], 2)
        q = np.tanh(s @ self.p["wa"])
        a = np.where(mask > 0, q @ self.p["va"], -1e9)
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = (a[:, :, None] * s).sum(0)
        logit = pooled @ self.p["wo"] + self.p["bo"][0]
        return (logit, (m1, m2, s, q, a, pooled)) if keep else logit

    def gradients(self, ids, flat, n, codes, mask, label) -> dict[str, np.ndarray]:
        x = self.embed(ids, flat, n)
        table = (x @ self.p["w"] + self.p["b"]).reshape(-1, 2, 3 * HIDDEN)
        logit, (m1, m2, s, q, a, pooled) = self.forward(table, codes, mask, True)
        d = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        g = {"wo": pooled.T @ d, "bo": np.array([d.sum()], np.float32)}
        dp = d[:, None] * self.p["wo"]
        ds = a[:, :, None] * dp
        da = (s * dp).sum(2)
        da = a * (da - (a * da).sum(0))
        g["va"] = np.einsum("tb,tbk->k", da, q)
        dq = da[:, :, None] * self.p["va"] * (1 - q * q)
        g["wa"] = np.einsum("tbi,tbk->ik", s, dq)
        ds = ds + dq @ self.p["wa"].T
        dg0, g["u0"] = gru_back(ds[:, :, :HIDDEN], self.p["u0"], m1)
        dg1, g["u1"] = gru_back(ds[::-1, :, HIDDEN:], self.p["u1"], m2)
        dt = np.zeros_like(table)
        np.add.at(dt[:, 0], codes.ravel(), dg0.reshape(-1, 3 * HIDDEN))
        np.add.at(dt[:, 1], codes[::-1].ravel(), dg1.reshape(-1, 3 * HIDDEN))
        dt = dt.reshape(len(table), -1)
        g["w"], g["b"] = x.T @ dt, dt.sum(0)
        dx = dt @ self.p["w"].T
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], ids, dx[:, :EMBED])
        np.add.at(g["char"], flat, np.repeat(dx[:, EMBED:] / np.sqrt(n)[:, None], n, axis=0))
        return g


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of n words one after the other: text, first word and length of each window; the last ends with its text."""
    per = np.where(n > 0, 1 + np.maximum(-(-(n - WINDOW) // STRIDE), 0), 0)
    of = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)
    start = np.minimum(k * STRIDE, np.maximum(n[of] - WINDOW, 0))
    return of, (np.cumsum(n) - n)[of] + start, np.minimum(n[of], WINDOW)


def lay_out(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(T, windows) codes and mask."""
    step = np.arange(int(length.max()))[:, None]
    mask = (step < length).astype(np.float32)
    return codes[np.minimum(start + np.minimum(step, length - 1), len(codes) - 1)], mask


class Scorer:
    """Scores of texts with a bounded cache of words' inputs."""

    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.table = np.zeros((1024, 2, 3 * HIDDEN), np.float32)

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.code) > CACHE:
            self._clear()
        got = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        if (got < 0).any():
            new = list(dict.fromkeys(w for w, c in zip(words, got.tolist(), strict=True) if c < 0))
            at = len(self.code)
            while at + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at:at + len(new)] = self.net.inputs([plain(w) for w in new])
            self.code.update(zip(new, range(at, at + len(new)), strict=True))
            got = np.fromiter(map(self.code.get, words), np.int64, len(words))
        return got

    def logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per window its text and logit; per text its highest logit (-inf without words)."""
        n = np.array([len(t) for t in texts], np.int64)
        best = np.full(len(texts), -np.inf)
        of, start, length = windows(n)
        if not len(of):
            return of, np.zeros(0), best
        codes = self.codes([w for t in texts for w in t])
        order = np.argsort(length, kind="stable")
        out = np.empty(len(of))
        for i in range(0, len(order), CHUNK):
            some = order[i:i + CHUNK]
            out[some] = self.net.forward(self.table, *lay_out(codes, start[some], length[some]))
        np.maximum.at(best, of, out)
        return of, out, best


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> Network | None:
    words = [t.split() for t in texts]
    label = np.array([y for y, w in zip(toxic, words, strict=True) if w], np.float32)
    words = [w for w in words if w]
    if len(set(label.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    seen: dict[str, int] = {}
    for ws in words:
        for w in {plain(x) for x in ws}:
            seen[w] = seen.get(w, 0) + 1
    common = sorted((w for w, k in seen.items() if k >= 3), key=lambda w: (-seen[w], w))[:WORDS - 1]
    size = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    p = {"word": size(WORDS, EMBED), "char": size(GRAMS, EMBED), "w": size(2 * EMBED, 6 * HIDDEN), "b": np.zeros(6 * HIDDEN, np.float32),
         "u0": size(HIDDEN, 3 * HIDDEN), "u1": size(HIDDEN, 3 * HIDDEN), "wa": size(2 * HIDDEN, HIDDEN), "va": size(HIDDEN),
         "wo": size(2 * HIDDEN), "bo": np.zeros(1, np.float32)}
    p["word"][0] = 0
    net = Network({w: i + 1 for i, w in enumerate(common)}, p)
    distinct = sorted({w for ws in words for w in ws})
    number = {w: i for i, w in enumerate(distinct)}
    ids, flat, n_tri = net.features([plain(w) for w in distinct])
    tri_start = np.cumsum(n_tri) - n_tri
    codes = np.array([number[w] for ws in words for w in ws], np.int64)
    of, start, length = windows(np.array([len(w) for w in words], np.int64))
    first = np.searchsorted(of, np.arange(len(words)))
    count = np.bincount(of, minlength=len(words))
    one, two, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for turn in range(PASSES):
        if turn < 3:
            chosen = first + (rng.random(len(words)) * count).astype(np.int64)
        else:
            table, logit = net.gates(ids, flat, n_tri), np.empty(len(of))
            for i in range(0, len(of), CHUNK):
                logit[i:i + CHUNK] = net.forward(table, *lay_out(codes, start[i:i + CHUNK], length[i:i + CHUNK]))
            rank = np.lexsort((-logit, of))
            chosen = rank[first]
        order = rng.permutation(len(words))
        for i in range(0, len(order), BATCH):
            some = chosen[order[i:i + BATCH]]
            grid, mask = lay_out(codes, start[some], length[some])
            used, place = np.unique(grid, return_inverse=True)
            n = n_tri[used]
            tri = flat[np.repeat(tri_start[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            known = np.where(rng.random(len(used)) < DROP, 0, ids[used])  # some words must be told by their characters
            g = net.gradients(known, tri, n, place.reshape(grid.shape), mask, label[order[i:i + BATCH]])
            step += 1
            for k, v in g.items():
                one[k] += 0.1 * (v - one[k])
                two[k] += 0.01 * (v * v - two[k])
                p[k] -= RATE * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-6)
    return net


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """docs (doc_id, text) and labels (doc_id, toxic): the rows to learn from."""
    taught = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # ids first, from the labels alone, some more than needed: only their texts leave the scan
    ids = sample_of_each(taught, "toxic", "doc_id", SPARE * SAMPLE, 2).select("doc_id", "toxic", "nth")
    texts = (docs.filter(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text").join(F.broadcast(ids), "doc_id")
             .groupBy("doc_id", "toxic", "nth").agg(F.min("text").alias("text")))
    order = Window.partitionBy("toxic").orderBy("nth")
    rows = (texts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE)
            .orderBy("toxic", "place").select("text", "toxic").collect())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, net: Network | None, with_text: bool = True) -> DataFrame:
    """The rows with a column `score` (0 to 1) behind them; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(net)       # a few hundred KB whatever the input
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "score"])
    kept = [c for c in docs.columns if with_text or c != "text"]

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for batch in stream:
            for part in batches(batch, "text", 1 << 20):
                out = np.zeros(part.num_rows)
                if scorer:
                    texts = [(t or "").split() for t in part.column("text").to_pylist()]
                    if sum(map(len, texts)) < 1 << 20:
                        out = sigmoid(np.maximum(scorer.logits(texts)[2], -700))
                    else:                                        # pieces overlap by a window, so no window is lost
                        for i, t in enumerate(texts):
                            step = STRIDE * 8192
                            out[i] = max((float(sigmoid(np.maximum(scorer.logits([t[a:a + step + WINDOW]])[2], -700))[0])
                                          for a in range(0, len(t), step)), default=0.0)
                    out[[not t for t in texts]] = 0.0
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(out, pa.float64())], names=[*kept, "score"])

    return docs.mapInArrow(judge, StructType([docs.schema[c] for c in kept]).add("score", "double"))
