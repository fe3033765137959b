"""Every registered query against its DuckDB oracle on the smallest fixture
(the driver runs the same check at sf0.01)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from hirelake.sources.fixtures import TABLES

from hirelake.plans.queries import QUERIES  # noqa: E402
from oracle.sql import ORACLE as ORACLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in data)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == [], f"queries without oracle: {missing}"
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    sdf = QUERIES[name](spark, sf_small)
    got = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _canon(sdf.columns, got) == _canon(ocols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["major_category", "middle_category", "count"]
    assert df.count() > 0
