"""Personal data by fixed patterns and a skip-chain conditional random field.

Method: patterns find the base spans (e-mail, IP, card, phone). The CRF labels tokens: node potentials over
hashed shape features, chain potentials between neighbours, and skip potentials between distant tokens of the
document that repeat or share their last digits, each occurrence tied to the next. Loopy sum-product passes
messages over both kinds of edges, so evidence for one mention reaches the others. Tokens without a digit or
an '@' can't be personal data of these kinds; those next to a candidate are nodes held at `outside`, others
carry no message and are left out. Tokens labelled with at least CONFIDENT probability that no base span
touches become added spans, of kinds named crf_email, crf_ip, crf_card and crf_phone; base spans always stay.

The CRF learns from the base spans of a bounded sample: at most SAMPLE documents with a digit or '@' and at
most SAMPLE_CHARS characters, those with the smallest hashes. Its weights are found by gradient ascent on the
likelihood with the marginals of loopy message passing. Judging reads every whole text.

Null and empty texts have no spans. Repeated rows get equal results; an empty sample adds no spans. Other
columns pass through. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placebook.llm.common import batches, bounded_sample

KINDS = ("email", "ip", "card", "phone")
FEATURES, CONFIDENT = 4096, 0.95
SAMPLE, SAMPLE_CHARS = 800, 12_000
PASSES, SWEEPS, RATE, RIDGE = 60, 6, 0.15, 1e-4
BATCH_NODES = 20_000

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")              # a run of digits is entered at its start only, and not given back: linear
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, by way of their '@': what stands before it starts the match, at the last match's end earliest."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(token: str) -> str:
    return _RUNS.sub(lambda m: "9" if m[0][0] in "0123456789" else "a", token)


def features(before: str, token: str, after: str) -> list[int]:
    digits = _NOT_DIGIT.sub("", token)
    core = token.strip(".,;:!?\"'")
    said = [f"s{shape(core)}", f"r{_RUNS.sub(lambda m: f'{m[0][0].isdigit():d}{min(len(m[0]), 20)}', core)}", f"n{min(len(digits), 20)}",
            f"@{'@' in token}", f"l{12 <= len(digits) <= 19 and luhn(digits)}", f"+{core[:1] == '+'}", f"b{shape(before)[:12]}", f"a{shape(after)[:12]}",
            f"x{shape(before)[:12]} {shape(core)} {shape(after)[:12]}", "."]
    return [zlib.crc32(s.encode("utf-8", "surrogatepass")) % FEATURES for s in said]


class Graph:
    """Nodes and edges of a batch of documents."""

    def __init__(self) -> None:
        self.features: list[list[int]] = []
        self.gold: list[int] = []
        self.free: list[bool] = []                               # not held at outside
        self.where: list[tuple[int, int, int]] = []              # document, start, end
        self.edges: list[tuple[int, int, int]] = []              # node, node, 0 chain or 1 skip

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        wanted = [i for i, (a, b) in enumerate(tokens) if _ANY.search(text, a, b)]
        nodes = sorted({j for i in wanted for j in (i - 1, i, i + 1) if 0 <= j < len(tokens)})
        chosen, last, seen = set(wanted), -2, {}
        word = lambda i: text[tokens[i][0]:tokens[i][1]] if 0 <= i < len(tokens) else ""
        at = 0
        for j in nodes:
            start, end = tokens[j]
            while at < len(base) and base[at][2] <= start:
                at += 1
            label = next((k + 1 for a, k, b in base[at:at + 8] if a < end and b > start), 0)
            me = len(self.features)
            self.features.append(features(word(j - 1), word(j), word(j + 1)))
            self.free.append(j in chosen)
            self.gold.append(label if j in chosen else 0)
            self.where.append((doc, start, end))
            if j == last + 1:
                self.edges.append((me - 1, me, 0))
            last = j
            if j in chosen:
                digits = _NOT_DIGIT.sub("", word(j))
                keys = {"w" + word(j).strip(".,;:!?\"'()").lower()} | ({"d" + digits[-7:]} if len(digits) >= 7 else set())
                for other in sorted({seen[k] for k in keys if k in seen}):
                    self.edges.append((other, me, 1))
                seen.update(dict.fromkeys(keys, me))


@dataclass
class Crf:
    node: np.ndarray                                             # (FEATURES, labels)
    pair: np.ndarray                                             # (2, labels, labels)

    def beliefs(self, g: Graph):
        """Node marginals, and edge marginals with the edges, by loopy sum-product."""
        n, k = len(g.features), self.node.shape[1]
        unary = self.node[np.array(g.features)].sum(1)
        unary[~np.array(g.free), 1:] = -30.0
        e = np.array(g.edges, np.int64).reshape(-1, 3)
        src, dst = np.concatenate([e[:, 0], e[:, 1]]), np.concatenate([e[:, 1], e[:, 0]])
        pair = np.concatenate([self.pair[e[:, 2]], self.pair[e[:, 2]].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))])
        m = np.zeros((len(src), k))
        total = unary.copy()
        for sweep in range(SWEEPS if len(e) else 0):
            out = total[src] - m[back]
            joint = out[:, :, None] + pair
            top = joint.max(1, keepdims=True)
            new = np.log(np.exp(joint - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            m = new if sweep == 0 else 0.5 * m + 0.5 * new
            total = unary + np.stack([np.bincount(dst, m[:, i], n) for i in range(k)], 1)
        p = np.exp(total - total.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        half = len(e)
        joint = (total[src] - m[back])[:half, :, None] + pair[:half] + (total[dst[:half]] - m[:half])[:, None, :]
        q = np.exp(joint - joint.max((1, 2), keepdims=True)) if half else np.zeros((0, k, k))
        return p, q / np.maximum(q.sum((1, 2), keepdims=True), 1e-300), e


def fit(texts: list[str]) -> Crf | None:
    g = Graph()
    for i, t in enumerate(texts):
        g.add(i, t, base_spans(t))
    labels = len(KINDS) + 1
    if not any(g.gold):
        return None
    crf = Crf(np.zeros((FEATURES, labels)), np.zeros((2, labels, labels)))
    feats, gold, n = np.array(g.features), np.array(g.gold), len(g.gold)
    want = np.eye(labels)[gold]
    one, two = [np.zeros_like(crf.node), np.zeros_like(crf.pair)], [np.zeros_like(crf.node), np.zeros_like(crf.pair)]
    for step in range(1, PASSES + 1):
        p, q, e = crf.beliefs(g)
        d_node, d_pair = np.zeros_like(crf.node), np.zeros_like(crf.pair)
        for c in range(feats.shape[1]):
            np.add.at(d_node, feats[:, c], want - p)
        real = np.zeros_like(q)
        real[np.arange(len(e)), gold[e[:, 0]], gold[e[:, 1]]] = 1
        np.add.at(d_pair, e[:, 2], real - q)
        for i, (w, d) in enumerate(((crf.node, d_node), (crf.pair, d_pair))):
            d = d / n - RIDGE * w
            one[i] += 0.1 * (d - one[i])
            two[i] += 0.01 * (d * d - two[i])
            w += RATE * (one[i] / (1 - 0.9 ** step)) / (np.sqrt(two[i] / (1 - 0.99 ** step)) + 1e-8)
    return crf


def train(docs: DataFrame) -> Crf | None:
    """docs (doc_id, text): the rows to learn from."""
    rows = docs.filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    return fit([r["text"] for r in bounded_sample(rows, "doc_id", SAMPLE).collect()])


def added_spans(g: Graph, p: np.ndarray, texts: dict[int, str], base: dict[int, list]) -> dict[int, list[tuple[int, str, int]]]:
    """Confident tokens next to each other are one span, cut to its letters and digits; none touches a base span."""
    best = p.argmax(1)
    sure = (best > 0) & (p.max(1) >= CONFIDENT)
    runs: list[list[int]] = []
    for i in np.flatnonzero(sure).tolist():
        doc, start, _ = g.where[i]
        last = runs[-1] if runs else None
        if last and last[0] == doc and last[4] == i - 1 and last[3] == best[i] and not texts[doc][last[2]:start].strip():
            last[2], last[4] = g.where[i][2], i
        else:
            runs.append([doc, start, g.where[i][2], int(best[i]), i])
    out: dict[int, list[tuple[int, str, int]]] = {}
    for doc, start, end, kind, _ in runs:
        said = texts[doc]
        while start < end and not said[start].isalnum() and said[start] != "+":
            start += 1
        while start < end and not said[end - 1].isalnum():
            end -= 1
        if start < end and not any(a < end and b > start for a, _, b in base[doc]):
            out.setdefault(doc, []).append((start, f"crf_{KINDS[kind - 1]}", end))
    return out


def find(docs: DataFrame, crf: Crf | None, with_text: bool = True) -> DataFrame:
    """The rows with n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans behind them; columns of
    these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)       # FEATURES x 5 weights
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in names])
    kept = [c for c in docs.columns if with_text or c != "text"]
    digest = lambda said: hashlib.sha256(said.encode()).hexdigest()

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in stream:
            for part in batches(batch, "text"):
                texts = part.column("text").to_pylist()
                some = {i: t for i, t in enumerate(texts) if t and _ANY.search(t)}
                base = {i: base_spans(t) for i, t in some.items()}
                more: dict[int, list] = {}
                g = Graph()
                todo = list(some) if model else []
                for at, i in enumerate(todo):
                    g.add(i, some[i], base[i])
                    if len(g.features) >= BATCH_NODES or at == len(todo) - 1:
                        if g.features:
                            more |= added_spans(g, model.beliefs(g)[0], some, base)
                        g = Graph()
                counts = np.zeros((len(KINDS), len(texts)), np.int64)
                sums, spans = [digest("")] * len(texts), [""] * len(texts)
                for i, found in base.items():
                    for _, kind, _ in found:
                        counts[kind, i] += 1
                    own = [(a, k, f"{KINDS[k]}:{a}:{b}") for a, k, b in found]
                    sums[i] = digest(",".join(x[2] for x in own))
                    own += [(a, len(KINDS), f"{k}:{a}:{b}") for a, k, b in more.get(i, [])]
                    spans[i] = ",".join(x[2] for x in sorted(own))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *map(pa.array, counts), pa.array(sums, pa.string()), pa.array(spans, pa.string())],
                                                 names=[*kept, *names])

    schema = StructType([docs.schema[c] for c in kept])
    for c in names:
        schema = schema.add(c, "long" if c.startswith("n_") else "string")
    return docs.mapInArrow(judge, schema)
