"""Every registered query against its SQL, over the smallest test tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="test tables not here")

from placebook.catalog import oracles  # noqa: E402
from placebook.catalog.queries import QUERIES  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ORACLES = oracles.build()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return round(float(v), 6) if hasattr(v, "as_tuple") else v


def test_the_entry_registers_them_all():
    import __spark_entry__ as entry
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want
