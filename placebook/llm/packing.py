"""Packing documents into training windows by sum-of-squares.

Method: a document is its token ids and an end id. Whole windows are cut from its start; its remainder is
placed online: a level array counts the partly filled windows per fill level, and a piece of length s goes to
that level h (0: a new window) whose change to the sum of squared counts is smallest; a window that becomes
full leaves the array. What is partly filled when a block ends is joined end to end and cut into full windows;
the last one is cut at powers of two, which need no padding. So no window is padded.

Documents are dealt into blocks of some BLOCK_DOCS by a running number, whatever their ids, so copies and hot
ids spread; in a given order, blocks are ranges of it. Blocks pack on their own. Tokens come from a public vocabulary, with a cache per worker, bounded in
words and characters, of the ids of words between spaces (no token of these vocabularies reaches over a space).

Null and empty texts are the end id alone. Repeated rows and ids are documents of their own. A long text is
tokenised in pieces cut at spaces. An empty table gives no windows. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.llm.common import batches

WINDOW, END = 2048, 1
BLOCK_DOCS = 4096
CACHE_WORDS, CACHE_CHARS, PIECE, BATCH = 1_000_000, 16 << 20, 1 << 20, 4 << 20
SPELL = 1 << 16                                                 # characters spelt in one call, whose splits and offsets take some hundred bytes each
MARKS = ",.;:!?"


def vocabulary_path(vocabulary: str) -> str:
    """A file, or a name among the installed public vocabularies."""
    if os.path.sep in vocabulary:
        return vocabulary
    import public_tokenizers
    return public_tokenizers.path(vocabulary)


class Words:
    """Token ids of texts, by words between spaces and line ends."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # the task's core is all it gets
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.last = None                                        # by token: whether a piece ends with it, if the vocabulary says so
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            vocab = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, self.kind)
        self.ends, self.known = np.zeros(1 << 16, np.int64), 0   # of the ids of word i: ends[i] to ends[i + 1]
        self.chars = 0                                          # of all words held

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words with their ids one after the other."""
        begin, more = int(self.ends[self.known]), self.known + len(words) + 1
        while begin + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while more > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[begin:begin + len(ids)] = ids
        self.ends[self.known + 1:more] = begin + np.cumsum(sizes)
        self.code.update(zip(words, range(self.known, more - 1), strict=True))
        self.known = more - 1

    def _flat(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words one after the other, and how many each has."""
        start = self.ends[codes]
        n = self.ends[codes + 1] - start
        total = np.cumsum(n)
        size = int(total[-1]) if len(total) else 0
        kind = np.int32 if max(size, len(self.flat)) < 1 << 31 else np.int64
        at = np.repeat((start - total + n).astype(kind), n)
        at += np.arange(size, dtype=kind)
        return self.flat[at], n

    def _spelt(self, new: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words one after the other, and how many each has: some SPELL characters to a call."""
        calls = np.cumsum([len(w) + 1 for w in new]) // SPELL
        cuts = [0, *(np.flatnonzero(np.diff(calls)) + 1).tolist(), len(new)]
        ids, n = zip(*(self._spelt_at_once(new[a:b], letters) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), strict=True)
        return np.concatenate(ids), np.concatenate(n)

    def _spelt_at_once(self, new: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        text = " ".join(new)
        if letters and self.last is not None:
            # letters only: at least one piece a word, so with as many last tokens as words each of them ends its word
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(new):
                return ids, np.diff(ends, prepend=0)
        e = self.tokenizer.encode(text, add_special_tokens=False)    # a token belongs to the word in which it starts
        begins = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
        cuts = np.searchsorted(begins, np.cumsum([0, *(len(w) + 1 for w in new)]))
        return np.array(e.ids, self.kind), np.diff(cuts)

    def _learn(self, words: list[str]) -> None:
        # a mark behind a letter is a piece of its own, and ASCII letters are lower-cased: few words are new
        cores = [w[:-1] if len(w) > 1 and w[-1] in MARKS and w[-2].lower().isalpha() else w for w in words]
        cores = [c.lower() if c.isascii() and "<" not in c else c for c in cores]
        new: tuple[list[str], list[str]] = [], []
        for c in dict.fromkeys([*MARKS, *cores]):
            if c not in self.code:
                new[c.isalpha()].append(c)
        for letters, some in enumerate(new):
            if some:
                self._add(some, *self._spelt(some, bool(letters)))
        marked = []
        for w, c in zip(words, cores, strict=True):
            if len(c) < len(w):
                marked.append(w)
            elif w not in self.code:
                self.code[w] = self.code[c]
        if marked:
            parts = [self.code[c] for w, c in zip(words, cores, strict=True) if len(c) < len(w)]
            both = np.array([parts, [self.code[w[-1]] for w in marked]]).T
            ids, n = self._flat(both.ravel())
            self._add(marked, ids, n.reshape(-1, 2).sum(1))

    def _codes(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; those not met before are learnt."""
        if len(self.code) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._clear()
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero(codes < 0)
        if len(missed):
            new = [words[i] for i in missed.tolist()]
            self._learn(distinct := list(dict.fromkeys(new)))
            self.chars += sum(map(len, distinct))
            codes[missed] = np.fromiter(map(self.code.get, new), np.int64, len(new))
        return codes

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        return self._flat(self._codes(words))

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text with the end id."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if column.nbytes <= 2 * BATCH:
            # split and told apart in Arrow: only the distinct words of a batch become Python's
            words = pc.split_pattern(pc.replace_substring(pc.fill_null(column, ""), "\n", " "), " ")
            distinct = words.flatten().dictionary_encode()
            per_text = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
            codes, of = self._codes(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), distinct.indices
            del words, distinct
            flat, n = self._flat(codes[of.to_numpy()])
            ends = np.concatenate([[0], np.cumsum(n)])[per_text]
            del n
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield np.append(flat[a:b], self.kind(END))
            return
        short = [t or "" for t in column.to_pylist()]
        for t in short:
            parts, at = [], 0
            while at < len(t):
                cut = t.find(" ", at + PIECE)
                cut = len(t) if cut < 0 else cut
                parts.append(self._ids(t[at:cut].replace("\n", " ").split(" "))[0])
                at = cut
            yield np.concatenate([*parts, np.array([END], self.kind)]).astype(self.kind)


@cache
def words_of(vocabulary: str) -> Words:
    """One for each Python worker, which serves task after task."""
    return Words(vocabulary)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Levels:
    """Partly filled windows by fill level, and the sum-of-squares rule."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)               # level 0 and full windows stay 0
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def place(self, piece, length: int) -> list | None:
        """Add a piece; the window's pieces if it is now full."""
        levels = np.flatnonzero(self.count[:self.size - length + 1])
        after = np.where(levels + length < self.size, 2 * self.count[np.minimum(levels + length, self.size)] + 1, 0)
        cost = after - 2 * self.count[levels] + 1
        new = 2 * self.count[length] + 1 if length < self.size else 0
        level = 0
        if len(levels) and cost.min() <= new:
            level = int(levels[np.flatnonzero(cost == cost.min())[-1]])
        window = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        window.append(piece)
        if level + length == self.size:
            return window
        self.count[level + length] += 1
        self.open[level + length].append(window)
        return None

    def rest(self) -> list:
        return [piece for windows in reversed(self.open) for window in windows for piece in window]


def pack_block(pieces: list[tuple], window: int = WINDOW) -> Iterator[list[tuple]]:
    """Pieces (row, start, length) of one block -> windows, each a list of such pieces, cut where needed."""
    levels = Levels(window)
    for p in pieces:
        if p[2] == window:
            yield [p]
        elif full := levels.place(p, p[2]):
            yield full
    rest = levels.rest()
    left = sum(p[2] for p in rest)
    made, room = [], 0
    for row, start, length in rest:
        while length:
            if not room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
            take = min(length, room)
            made.append((row, start, take))
            start, length, room, left = start + take, length - take, room - take, left - take
            if not room:
                yield made
                made = []


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", window: int = WINDOW, with_ids: bool = True,
         block_docs: int = BLOCK_DOCS, order: str | None = None) -> DataFrame:
    """docs (doc_id, text) -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, if asked for, its ids (little-endian, 2 or 4 bytes each by the vocabulary's size). `order` may name a column
    with running numbers 1, 2, 3, ...: blocks are then ranges of it, and sequence_ids go up with it block by block."""
    place = F.lit(None) if order is None else F.col(order)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", place.cast("long").alias("place"))
    blocks = max(1, -(-rows.count() // block_docs))
    cols = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"

    def tokenize(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = words_of(vocabulary), TaskContext.get().partitionId() << 40
        for batch in stream:
            for part in batches(batch, "text", BATCH):
                out = []
                for doc, place, ids in zip(part.column("doc_id").to_pylist(), part.column("place").to_pylist(),
                                           words.encode(part.column("text")), strict=True):
                    number = number + 1 if place is None else place
                    for start in range(0, len(ids), window):
                        some = ids[start:start + window]
                        whole = len(some) == window
                        out.append((number, doc, start, len(some), crc(some) if whole else None, len(ids),
                                    some.tobytes() if with_ids or not whole else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, (*[pa.int64()] * 6, pa.binary()), strict=True)],
                    names=["number", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    def pack_one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["number", "start"], kind="stable").reset_index(drop=True)
        doc, begin, tokens = (pdf[c].tolist() for c in ("doc_id", "start", "doc_tokens"))
        sums, ids, width = pdf["ids_crc32"].tolist(), pdf["ids"].tolist(), None
        out, sequence = [], int(key[0]) << 32
        for made in pack_block(list(zip(range(len(pdf)), repeat(0), pdf["length"].tolist())), window):
            offset = 0
            for row, start, length in made:
                own = None
                if ids[row] is not None:
                    width = len(ids[row]) // int(pdf["length"].iat[row])
                    own = ids[row][start * width:(start + length) * width]
                check = int(sums[row]) if length == window and start == 0 and not pd.isna(sums[row]) else crc(np.frombuffer(own, f"<u{width}"))
                out.append((doc[row], begin[row] + start, length, check, tokens[row], own if with_ids else None, sequence, offset))
                offset += length
            sequence += 1
        made = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"])
        return made.astype({"doc_id": "Int64"})

    dealt = F.pmod(F.xxhash64("number"), F.lit(blocks)) if order is None else F.floor((F.col("number") - 1) / block_docs)
    pieces = rows.mapInArrow(tokenize, f"number long, {cols}").withColumn("block", dealt)
    out = pieces.groupBy("block").applyInPandas(pack_one, f"{cols}, sequence_id long, offset long")
    return out if with_ids else out.drop("ids")
