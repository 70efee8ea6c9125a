"""Fill-in-the-middle, chat windows and conversation repair against plain Python, and on the cases that break things."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placebook.llm import chat_windows, fill_middle, repair


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle ----

def filled(doc_id, text, rate=100, spm=50):
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    odd = [None, "", "\n", "a", "a\n", "\n\nx", "é\n\U0001F600", "has <S> inside\nand more", "<\n<P", "a" * 90_000, "y\n" * 40_000,
           "same line\n" * 3, "same line\n" * 3]
    some = ["".join(rng.choice("abcé\n \U0001F600") for _ in range(rng.randint(1, 3000))) for _ in range(120)]
    passage = "".join(rng.choice("abcdef \n") for _ in range(6000))
    return odd + some + [some[i] + passage + some[-i] for i in range(20)]


@pytest.mark.parametrize("rate", [100, 40])
def test_fill_middle(spark, texts, rate):
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim string, output long")
    out, name = fill_middle.transform(docs, rate=rate)
    assert name == "_fim" and out.columns[:-1] == docs.columns
    back = fill_middle.restore(F.col(f"{name}.output"), F.col(f"{name}.form"))
    got = {r["output"]: r for r in out.withColumn("back", back).collect()}
    assert len(got) == len(rows)
    for doc_id, text, _, i in rows:
        assert tuple(got[i][name]) == filled(doc_id, text, rate)
        assert got[i]["back"] == (text or "") and got[i]["text"] == text
    assert fill_middle.transform(docs.limit(0))[0].count() == 0
    assert {r[name]["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_fill_middle_chunks_are_content_defined_and_verified():
    rng = random.Random(2)
    passage = bytes(rng.randrange(256) for _ in range(20_000))

    def chunks(text):
        ends = list(fill_middle.chunk_ends(fill_middle.cut_places(np.frombuffer(text, np.uint8), np.zeros(1, np.int64)).tolist(), 0, len(text)))
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    one, two = chunks(passage), chunks(b"moved by a few bytes" + passage + b"and ended elsewhere")
    assert b"".join(one) == passage and len(set(one) & set(two)) >= len(one) - 3
    assert all(fill_middle.MIN <= len(c) <= fill_middle.MAX for c in one[:-1])
    assert max(map(len, chunks(b"z" * 100_000))) <= fill_middle.MAX and chunks(b"") == []
    memo = fill_middle.Memo(limit=1000)
    assert [memo.summary("é\n".encode() * 3) for _ in range(2)] == [(3, 6)] * 2 and memo.hits == 1
    for i in range(50):
        memo.summary(b"%d\n" % i * 40)
    assert memo.held <= 1000                                                       # emptied, never above its limit
    texts = [passage[:5000].decode("latin-1"), passage.decode("latin-1"), None, "\n"]
    data = [(t or "").encode() for t in texts]
    for raw in data:
        whole = fill_middle.Summed(raw, np.cumsum([len(c) for c in chunks(raw)]).tolist(), fill_middle.Memo(100))
        units = re.findall(rb"[^\n]*\n|[^\n]+", raw)
        assert whole.units == len(units)
        for k in range(0, len(units) + 1, 7):
            head = b"".join(units[:k])
            assert whole.after(k) == (len(head), len(head.decode()))


# ---- chat windows ----

TURNS = "conv_id long, turn long, role string, text string, formatted string, tokens string"


def said(rng, n):
    return " ".join(rng.choice(["no.", "<|im_end|>", "<||", "a%0Ab", "\n", "yes", "é", "<|im_start|>user"]) for _ in range(n))


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(9)
    rows = []
    for conv in range(12):
        if conv % 3 == 0:
            rows.append((conv, 0, "system", said(rng, 20)))
        rows += [(conv, i, "user" if i % 2 else "assistant", said(rng, rng.randint(0, 90))) for i in range(1, rng.randint(2, 12))]
    rows += [(50, i, "user" if i % 2 else "assistant", said(rng, 10)) for i in range(0, 700)] + [(50, -1, "system", "always <|here|>")]
    rows += [(51, None, "user", "null turn"), (51, None, "assistant", None), (51, 0, None, "no role"), (51, 3 * 10 ** 18, "tool\nname%", "far"),
             (51, 2 ** 63 - 1, "assistant", "last"), (51, -(2 ** 63), "assistant", "first"), (51, 0, "assistant", "tie"), (51, 0, "assistant", "tie")]
    rows += [(None, 1, "assistant", "of no one"), (None, 0, "user", ""), (52, 0, "assistant", "word " * 3000), (52, 1, "user", "short")]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def test_chat_windows(spark, turns):
    groups = defaultdict(list)
    for r in turns.collect():
        groups[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    shown = chat_windows.windows(turns)
    got = {r["conv_id"]: r for r in chat_windows.digest(shown).collect()}
    assert set(got) == set(groups)
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        loss = "".join(t for _, role, t in rows if role == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)))
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))
    windows = sorted(shown.collect(), key=lambda r: (str(r["conv_id"]), r["block"] is not None, r["block"] or 0, r["n"]))
    for w in windows:
        assert w["formatted"].count("<|im_start|>") == w["formatted"].count("<|im_end|>")
        own = w["formatted"].count("<|im_end|>") - w["repeated"]
        assert own >= 1 and (w["tokens"] <= chat_windows.BUDGET or own == 1)
    long = [w for w in windows if w["conv_id"] == 50]
    assert len({w["block"] for w in long}) == 4 and sum(w["formatted"].count("<|im_end|>") - w["repeated"] for w in long) == 701
    for before, w in zip(long, long[1:]):                                         # the system turn and the last two turns come again
        if w["block"] is not None and w["block"] >= 0 and before["block"] >= 0:
            assert w["formatted"].startswith("<|im_start|>system\nalways <||here|><|im_end|>\n") and w["repeated"] == 3
            assert before["formatted"].split("<|im_start|>")[-2:] == w["formatted"].split("<|im_start|>")[2:4]
    assert max(w["tokens"] for w in windows if w["conv_id"] == 52) > chat_windows.BUDGET
    assert chat_windows.digest(chat_windows.windows(turns.limit(0))).count() == 0


def test_chat_windows_repeat_only_what_fits(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} " * 100) for i in range(6)]
    for history, tokens, want in ((2, 1000, [0, 2, 2]), (1, 1000, [0, 1, 1]), (2, 110, [0, 1, 1]), (2, 50, [0, 0, 0]), (0, 1000, [0, 0, 0])):
        shown = chat_windows.windows(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), 208 + tokens, history, tokens)
        got = sorted(shown.collect(), key=lambda r: r["n"])
        assert [w["repeated"] for w in got] == want
        assert all(len(w["targets"]) == 1 for w in got)


# ---- repair ----

def cheapest(rows):
    """(cost, audit, repaired rows) by trying all edits, row by row: for each state the least (cost, audit)."""
    best = {"": (0, "", [])}

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def turn(state):
        return "a" if state == "u" else "u"

    def insert(table):
        for _ in range(4):
            for state, (cost, audit, out) in list(table.items()):
                put(table, turn(state), (cost + 5, audit + "I", out + [("user:" if turn(state) == "u" else "assistant:")]))
        return table

    best = insert(best)
    for role, text, gone, cut in rows:
        after = {}
        for state, (cost, audit, out) in best.items():
            put(after, state, (cost + 2, audit + "D", out))
            if not gone:
                extra = 5 if cut else 0
                name = "user" if turn(state) == "u" else "assistant"
                put(after, turn(state), (cost + 1 + extra, audit + "R", out + [f"{name}:{text}"]))
                initial = role[:1]
                if initial == turn(state) or (initial == "s" and state == ""):
                    put(after, initial, (cost + extra, audit + "K", out + [f"{role}:{text}"]))
        best = insert(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))


def repaired(conv, rows):
    rows, seen, faults = damaged(rows), set(), []
    for turn, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit, out = cheapest([(r, t, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(rows, faults)])
    numbers = [t for t, _, _ in rows if t is not None]
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, sha("\n".join(out)))


def test_block_tables_give_the_least_of_all_cheapest_edits():
    rng = random.Random(4)
    names = ["s", "u", "a", "x"]
    for block in (1, 3, 4):
        tables = repair.Tables(block)
        assert len(tables.vectors) < 100
        for _ in range(1500):
            symbols = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 1, 2]) for _ in range(rng.randint(0, 13)))
            rows = [(names[s % 4], "t", s == repair.GONE, 4 <= s < 8) for s in symbols]
            cost, audit = tables.repair(symbols)
            assert (cost, audit.decode()) == cheapest(rows)[:2]


def test_repair(spark):
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "sys", "tool", "Admin", "", None, "user", "assistant"]
    texts = ["Yes.", "no", "What? ", "", None, " \t\n", "Well!\r\n", "é…", "Yes.", "x" * 200_000 + "."]
    rows = []
    for conv in [None, *range(-2, 120)]:
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3, 5]), rng.choice(roles[:5] if conv and conv % 2 else roles),
                         rng.choice(texts[:4] if conv and conv % 3 else texts)))
    rows += [(500, i, "user" if i % 2 == 0 else "assistant", f"Row {i % 900}.") for i in range(3000)]         # longer than a batch of blocks
    rows += [(501, t, "user", "Same.") for t in (None, 2, 2, 1, None)]
    dropped = next(i for i in range(600, 700) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "All gone."))
    df = spark.createDataFrame([(*r, "1", "2") for r in rows], "conv_id long, turn long, role string, text string, audit string, pass string")
    got = {r["conv_id"]: tuple(r) for r in repair.repair(repair.damage(df), df).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    assert set(got) == set(groups)
    for conv, some in groups.items():
        assert got[conv] == repaired(conv, some)
    assert got[dropped] == (dropped, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert repair.repair(repair.damage(df.limit(0)), df.limit(0)).count() == 0
    assert repair.repair(repair.damage(df.filter("conv_id = 500"))).count() == 1


def test_repair_walks_many_batches(spark):
    """A conversation goes on over batches of Arrow rows; conversations end within them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, t, ["user", "assistant"][t % 2], f"{c} {t}.") for c in range(5) for t in range(20)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        got = {r["conv_id"]: tuple(r) for r in repair.repair(repair.damage(df), df).collect()}
        assert got == {c: repaired(c, [r for r in rows if r[0] == c]) for c in range(5)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
