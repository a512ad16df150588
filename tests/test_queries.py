"""Registered queries vs their DuckDB oracle on the smallest tables (the driver does sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from retail_pulse.plans.queries import QUERIES
from retail_pulse.sources.tables import TABLES
from retail_pulse.streaming.jobs import STREAM_QUERIES

SF_SMALL = "/root/testdata/sf0.001"

NAMES = list(E.oracle_sql())
# Spark simpleString -> DuckDB type name, for the schema comparison
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.6g}") if not math.isnan(v) else "nan"
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    duck = dict(zip(res.columns, [str(t) for t in res.types]))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == duck
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(res.columns, res.fetchall())


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) | set(STREAM_QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["mid", "log_date", "log_hour", "event_id", "ts_ms"]
