"""Conversation structure repair by Four-Russians block tables.

Method: a row is one of nine symbols (its role's initial s, u, a or another, sound or truncated; or a row that must go). What
the rows from some place on cost at least is a vector over the four states of the wanted form `(s?(ua)+)?` (nothing yet, after
s, after u, after a). Less its minimum, few such vectors exist, so a table holds for each of them and each block of BLOCK
symbols the vector before the block and what the minimum grew by. A conversation is worked off from its end, a look-up per
block. Then each block is expanded: the vectors at its rows are worked out backward from its end, and forward the
least letter is taken that keeps the cost. From a state each letter leads to one state only, so the letters taken are the
ASCII-least of all cheapest edits, and they alone fix the repaired rows.

On Spark: duplicates are found by a grouped minimum over digests, then every conversation passes through its task twice,
sorted: first its symbols, which decide the edits, then its texts, which go into the hash as they come. What a task holds of
a conversation is a few bytes a row, and never its texts.

Nulls are one space, in roles, texts and in what the damage hashes. Null turns come first; equal turns go by role, then the
text's digest. Repeated rows are rows (a later one is a duplicate). Null conversations are one. Long texts are whole. An
empty table gives none. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.llm.common import batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 4
#: Symbols: role (s, u, a, other) + 4 if truncated; a row that must go; a place without a row (fills a block).
GONE, NOTHING, SYMBOLS = 8, 9, 10
#: States: nothing yet, after s, after u, after a. What a kept s, u or a leads to from each; -1: not allowed.
NEXT = np.array([[1, 2, -1], [-1, 2, -1], [-1, -1, 3], [-1, 2, -1]])
#: What a rerole or an insertion leads to.
TURN = np.array([2, 2, 3, 2])
FAR = 1 << 20
#: Letters in the order of ties.
D, I, K, R = b"DIKR"


def damage(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) as crc32(conv_id:turn) % 20 spoils them; nulls of role and text become a space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    out = rows.filter(fate != 0).select("conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"), text.alias("text"),
                                        F.when(fate == 3, 2).otherwise(1).alias("times"))
    return out.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def _relax(costs: np.ndarray) -> np.ndarray:
    """Cost-to-go vectors (last axis: states) with insertions allowed."""
    for _ in range(3):                                      # s, u, a: no chain of useful insertions is longer
        costs = np.minimum(costs, INSERT + costs[..., TURN])
    return costs


def _before(symbol: int, costs: np.ndarray) -> np.ndarray:
    """Cost-to-go vectors before a row, from those behind it."""
    if symbol == NOTHING:
        return costs
    best = DELETE + costs
    if symbol != GONE:
        extra = TRUNCATED * (symbol >= 4)
        best = np.minimum(best, REROLE + extra + costs[..., TURN])
        if symbol % 4 < 3:
            to = NEXT[:, symbol % 4]
            best = np.minimum(best, np.where(to >= 0, KEEP + extra + costs[..., to], FAR))
    return _relax(best)


class Tables:
    """All normalised vectors, one symbol's transitions, and those of all blocks of BLOCK symbols."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _relax(np.array([0, FAR, FAR, 0]))
        known = {tuple(end - end.min()): 0}
        self.vectors = [np.array(v) for v in known]
        steps: list[list[tuple[int, int]]] = []
        for vector in self.vectors:                         # grows meanwhile, until no new vector comes
            steps.append([])
            for symbol in range(SYMBOLS):
                new = _before(symbol, vector)
                key = tuple(new - new.min())
                if key not in known:
                    known[key] = len(known)
                    self.vectors.append(np.array(key))
                steps[-1].append((known[key], int(new.min())))
        self.step = np.array([[s[0] for s in v] for v in steps], np.int32)          # [vector, symbol]
        self.grow = np.array([[s[1] for s in v] for v in steps], np.int32)
        at = np.broadcast_to(np.arange(len(steps), dtype=np.int32)[:, None], (len(steps), SYMBOLS ** block)).copy()
        total = np.zeros_like(at)
        code = np.arange(SYMBOLS ** block)
        for i in reversed(range(block)):                    # the block's last symbol comes first
            symbol = code // SYMBOLS ** (block - 1 - i) % SYMBOLS
            total += self.grow[at, symbol]
            at = self.step[at, symbol]
        self.to, self.total = at, total                     # [vector behind, block]
        self.traced: dict[tuple[int, int, int], tuple[bytes, int]] = {}

    def expand(self, behind: int, block: int, state: int) -> tuple[bytes, int]:
        """The letters of a block that is entered in a state, and the state it leaves."""
        if (found := self.traced.get((behind, block, state))) is not None:
            return found
        symbols = [block // SYMBOLS ** (self.block - 1 - i) % SYMBOLS for i in range(self.block)]
        after = [behind]
        for symbol in reversed(symbols):
            after.append(int(self.step[after[-1], symbol]))
        after.reverse()
        letters, now = bytearray(), state
        for i, symbol in enumerate(symbols):
            if symbol == NOTHING:
                continue
            # costs on one scale: those of `here` are less by `grow` than what a step to `rest` gives
            here, rest, grown = self.vectors[after[i]], self.vectors[after[i + 1]], int(self.grow[after[i + 1], symbol])
            while True:
                left = int(here[now]) + grown
                extra = TRUNCATED * (4 <= symbol < GONE)
                kept = int(NEXT[now, symbol % 4]) if symbol != GONE and symbol % 4 < 3 else -1
                if DELETE + rest[now] == left:
                    letters.append(D)
                elif INSERT + here[TURN[now]] + grown == left:
                    letters.append(I)
                    now = int(TURN[now])
                    continue
                elif kept >= 0 and KEEP + extra + rest[kept] == left:
                    letters.append(K)
                    now = kept
                else:
                    letters.append(R)
                    now = int(TURN[now])
                break
        self.traced[behind, block, state] = found = bytes(letters), now
        return found

    def repair(self, symbols: bytes) -> tuple[int, bytes]:
        """(cost, audit) of a conversation's symbols."""
        n = -(-len(symbols) // self.block)
        padded = np.full(n * self.block, NOTHING, np.int64)
        padded[n * self.block - len(symbols):] = np.frombuffer(symbols, np.uint8)
        codes = padded.reshape(n, self.block) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))
        behind, cost = np.zeros(n, np.int32), 0             # 0: the vector at the end, whose minimum is 0
        at = 0
        for i in range(n - 1, -1, -1):
            behind[i] = at
            cost += int(self.total[at, codes[i]])
            at = int(self.to[at, codes[i]])
        cost += int(self.vectors[at][0])
        audit, state = bytearray(), 0
        for i in range(n):
            letters, state = self.expand(int(behind[i]), int(codes[i]), state)
            audit += letters
        while state in (1, 2):                              # what the end still asks for
            audit.append(I)
            state = int(TURN[state])
        return cost, bytes(audit)


@cache
def tables() -> Tables:
    return Tables()


class Repaired:
    """The repaired rows of an audit, hashed as their texts come."""

    def __init__(self, audit: bytes):
        self.letters, self.state, self.sha, self.any = iter(audit), 0, hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def _turn(self) -> str:
        self.state = int(TURN[self.state])
        return "user" if self.state == 2 else "assistant"

    def row(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == I:
                self._line(self._turn(), "")
                continue
            if letter == K:
                self.state = int(NEXT[self.state, "sua".index(role[0])])
                self._line(role, text)
            elif letter == R:
                self._line(self._turn(), text)
            return

    def digest(self) -> str:
        for _ in self.letters:
            self._line(self._turn(), "")
        return self.sha.hexdigest()


SCHEMA = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class Conversation:
    """What is gathered of one conversation: symbols and counts, then the hash."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.symbols, self.last, self.role = bytearray(), None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.repaired: Repaired | None = None
        self.cost, self.audit = 0, b""

    def take(self, turn: int | None, role: int, fault: int, later: bool, key: bytes) -> None:
        """A row of the first pass: role s, u, a or other; fault 0 none, 1 blank, 2 truncated; later: its key was at an earlier turn."""
        again = later or (turn, key) == self.last           # copies at one turn are neighbours
        if fault == 1:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif fault == 2:
            self.truncated += 1
        self.symbols.append(GONE if fault == 1 or again else role + 4 * (fault == 2))
        if self.role is not None and (self.role, role) not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.turns += self.last is None or self.last[0] != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last, self.role = (turn, key), role

    def say(self, role: str, text: str) -> None:
        self._decide()
        self.repaired.row(role, text)

    def _decide(self) -> None:
        if self.repaired is None:
            self.cost, self.audit = tables().repair(bytes(self.symbols))
            self.repaired = Repaired(self.audit)

    def result(self) -> tuple:
        self._decide()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit.decode(),
                self.repaired.digest())


def _features(rows: DataFrame) -> DataFrame:
    """The rows with their role's class, fault and a digest of role and text."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    seen = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(seen == "", 1).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    return rows.select("conv_id", "turn", "role", "text", role.cast("tinyint").alias("kind"), fault.cast("tinyint").alias("fault"),
                       F.unhex(F.sha2("text", 256)).alias("digest"))


def _later(rows: DataFrame) -> DataFrame:
    """Without the texts; later: the same role and text stands at an earlier turn (null turns come first)."""
    key = ["conv_id", "role", "digest"]
    first = rows.groupBy(*key).agg(F.min("turn").alias("f_turn"), F.max(F.col("turn").isNull()).alias("f_null")).select(
        *[F.col(c).alias(f"f_{c}") for c in key], "f_turn", "f_null")
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in key]
    later = F.col("turn").isNotNull() & (F.col("f_null") | (F.col("turn") > F.col("f_turn")))
    return rows.join(first, same[0] & same[1] & same[2]).select(*key, "turn", "kind", "fault", later.alias("later"))


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation of `conversations` (conv_id; None: of rows): faults, the cheapest edits, the repaired rows' hash.

    rows (conv_id, turn, role, text) without null roles and texts. `audit` has K(eep), R(erole), D(elete), I(nsert) in order.
    """
    rows = _features(rows)
    nothing = {"pass": "int", "kind": "tinyint", "fault": "tinyint", "later": "boolean", "text": "string"}
    first = _later(rows.drop("text")).withColumns({"pass": F.lit(1), "text": F.lit(None).cast("string")})
    second = rows.select("conv_id", "turn", "role", "digest", "text").withColumn("pass", F.lit(2))
    every = first.unionByName(second, allowMissingColumns=True)
    if conversations is not None:
        every = every.unionByName(conversations.select("conv_id").distinct().withColumn("pass", F.lit(0)), allowMissingColumns=True)
    columns = ["conv_id", "turn", "role", "digest", *nothing]
    every = every.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "pass", "turn", "role", "digest")
    return every.mapInArrow(_walk, SCHEMA)


def _walk(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = [pa.string() if part.endswith("string") else pa.int64() for part in SCHEMA.split(", ")]

    def emit(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    now: Conversation | None = None
    done: list[tuple] = []
    for part in (p for batch in stream for p in batches(batch, "text")):
        columns = [part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "pass", "kind", "fault", "later", "text")]
        for conv, turn, role, digest, step, kind, fault, later, text in zip(*columns):
            if now is None or conv != now.conv_id:
                if now is not None:
                    done.append(now.result())
                now = Conversation(conv)
            if step == 1:
                now.take(turn, kind, fault, later, role.encode() + b"\0" + digest)
            elif step == 2:
                now.say(role, text)
        if done:
            yield emit(done)
            done = []
    if now is not None:
        yield emit([now.result()])
