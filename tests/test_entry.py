"""The driver contract, and every registered query against its DuckDB oracle at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from smoglake.catalog import QUERIES
from smoglake.oracle import SQL

SF = "/root/testdata/sf0.001"


def _key(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.3f}"
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return repr(v)


def _canon(cols, rows):
    """Rows with columns in name order, sorted on a coarse key."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple(_key(v) for v in r))


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    if hasattr(a, "isoformat") and hasattr(b, "isoformat"):
        return _key(a) == _key(b)
    return a == b


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Pollutant", "HourOfDay", "AvgValue", "NormalizedValue"]


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    for got, want in zip(_canon(cols, rows), _canon(ocols, orows)):
        assert all(_same(a, b) for a, b in zip(got, want)), (got, want)
