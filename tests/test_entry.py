"""Every query runs on the smallest data, with a stable schema; those with SQL give the same rows as it."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert ours == Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_sql_has_a_query_each():
    assert set(entry.oracle_sql()) <= set(entry.queries())
