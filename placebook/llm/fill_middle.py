"""Fill-in-the-middle rows from whole documents, cut between lines.

Method: a gear hash rolls over the bytes of a text and cuts it into chunks where its top bits are zero, so equal
passages fall into equal chunks wherever they stand. What a chunk adds is a summary (line ends, code points),
kept in a memo of the worker under the chunk's bytes: a look-up compares them, so a collision can't mix two chunks.
The sums of a document's summaries tell how many units it has, which chunk holds the end of unit k and how many code points
stand before it; only that one chunk is searched.

A unit is a line with its end, or the last line without one. The first four 8-digit groups of the sha256 of `seed:doc_id`
choose the two cuts, whether a text is transformed and which order its parts take. A text that is null (taken as empty),
empty, or holds a marker stays plain, as does the share of texts beyond `rate`.

A null doc_id draws as `seed:`. Repeated rows give repeated rows, each by itself; equal ids draw equal numbers. Long texts are
whole; a chunk holds MAX bytes at most. An empty table gives an empty one. Input columns stay, also such as are called
`form` or `output`: what is added is one struct whose name is returned and gives way.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placebook.llm.common import batches, fresh, mix64, utf8_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = "7", 100, 50
#: Bits of the hash that are zero at a cut (a chunk in 2^BITS bytes), bounds of a chunk, bytes that the hash sees.
BITS, MIN, MAX, SEEN = 9, 64, 1 << 14, 32
MEMO_BYTES = 48 << 20
_CONTINUATION = bytes(range(0x80, 0xC0))


@cache
def _gear() -> np.ndarray:
    return (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def cut_places(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the rolling hash of the last SEEN bytes calls for a cut: ends of chunks, ascending.

    starts: where the texts begin in data; a hash that would see two texts counts for nothing.
    """
    h = _gear()[data]
    width = 1
    while width < SEEN:                                     # the sum over 2w bytes from two sums over w bytes
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    hits = np.flatnonzero(h >> np.uint32(32 - BITS) == 0)
    begin = starts[np.searchsorted(starts, hits, side="right") - 1]
    return hits[hits - begin >= SEEN - 1] + 1


def chunk_ends(places: list[int], start: int, end: int) -> Iterator[int]:
    """Ends of one text's chunks, MIN to MAX bytes each (its last may be shorter)."""
    at = bisect_left(places, start + MIN)
    while start < end:
        while at < len(places) and places[at] < start + MIN:
            at += 1
        stop = places[at] if at < len(places) and places[at] < end else end
        start = min(stop, start + MAX)
        yield start


class Memo:
    """Summaries of chunks by their bytes, emptied when its keys hold `limit` bytes."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held, self.hits, self.misses = limit, 0, 0, 0
        self.known: dict[bytes, tuple[int, int]] = {}

    def summary(self, chunk: bytes) -> tuple[int, int]:
        """(line ends, code points that begin in the chunk)."""
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        if self.held + len(chunk) > self.limit:
            self.known, self.held = {}, 0
        found = chunk.count(b"\n"), len(chunk.translate(None, _CONTINUATION))
        self.known[chunk] = found
        self.held += len(chunk)
        return found


class Summed:
    """One text as the sums of its chunks' summaries."""

    def __init__(self, text: bytes, ends: list[int], memo: Memo):
        self.text, self.ends = text, ends
        self.lines, self.chars = [0], [0]                   # before each chunk, and in all
        start = 0
        for end in ends:
            lines, chars = memo.summary(text[start:end])
            self.lines.append(self.lines[-1] + lines)
            self.chars.append(self.chars[-1] + chars)
            start = end

    @property
    def units(self) -> int:
        return self.lines[-1] + (bool(self.text) and not self.text.endswith(b"\n"))

    def after(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first units."""
        if units == 0:
            return 0, 0
        if units > self.lines[-1]:
            return len(self.text), self.chars[-1]
        chunk = bisect_left(self.lines, units) - 1          # its line ends reach units
        begin = at = self.ends[chunk - 1] if chunk else 0
        for _ in range(units - self.lines[chunk]):
            at = self.text.index(b"\n", at) + 1
        return at, self.chars[chunk] + len(self.text[begin:at].translate(None, _CONTINUATION))


def arrange(text: Summed, draws: tuple[int, int, int, int], rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n, raw = text.units, text.text
    h1, h2, h3, h4 = draws
    if not raw or h3 % 100 >= rate or any(m.encode() in raw for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = text.after(first), text.after(second)
    p, m, s = PREFIX.encode() + raw[:a], MIDDLE.encode() + raw[a:b], SUFFIX.encode() + raw[b:]
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, a_chars, b_chars - a_chars, (s + p + m if form == "spm" else p + s + m)


@cache
def _memo() -> Memo:
    return Memo()


def _arranged(texts: pa.Array, draws: list[tuple[int, int, int, int]], rate: int, spm: int) -> pa.Array:
    data, starts = utf8_buffer(texts)
    places, raw, memo = cut_places(data, starts[:-1]).tolist(), data.tobytes(), _memo()
    rows, bounds = [], starts.tolist()
    for start, end, draw in zip(bounds, bounds[1:], draws):
        ends = [e - start for e in chunk_ends(places, start, end)]
        rows.append(arrange(Summed(raw[start:end], ends, memo), draw, rate, spm))
    n, form, prefix, middle, output = zip(*rows)
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
         pa.array(output, pa.binary()).cast(pa.string())], names=["n", "form", "prefix_chars", "middle_chars", "output"])


def _draws(seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def transform(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM, with_text: bool = True) -> tuple[DataFrame, str]:
    """docs (doc_id, text, ...) with a struct (n, form, prefix_chars, middle_chars, output), and that struct's name.

    rate: of 100 texts, how many are transformed; spm: of 100 of those, how many get the suffix first.
    """
    name, drawn = fresh(docs, "fim"), fresh(docs, "_draws")
    kept = [c for c in docs.columns if with_text or c != "text"]

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in batches(batch, "text"):
                done = _arranged(part.column("text"), part.column(drawn).to_pylist(), rate, spm)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], done], names=[*kept, name])

    added = StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    schema = StructType([docs.schema[c] for c in kept]).add(name, added)
    return docs.withColumn(drawn, _draws(seed)).mapInArrow(work, schema), name


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of: the markers stand in it once each."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(parts[2], parts[3], parts[1]))
