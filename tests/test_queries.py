"""Every query with a SQL twin, run beside DuckDB on the smallest given tables."""

import datetime
import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry_point

ROOT = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not ROOT.exists(), reason="given tables are not here")
TABLES = sorted(p.stem for p in ROOT.glob("*.parquet"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value.date() if isinstance(value, datetime.datetime) else value


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, str(ROOT))
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = duck.execute(entry_point.oracle_sql()[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    want = [tuple(plain(r[named.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)


def test_flagship(spark):
    assert entry_point.entry(spark).count() == 150
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
