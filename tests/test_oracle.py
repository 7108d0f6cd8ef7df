"""Every catalog query against its DuckDB oracle (the driver's check, small scale)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerwarden.plans.catalog import QUERIES


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, decimal.Decimal):
        return ("num", str(v.normalize()))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return (type(v).__name__, v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ["nation", "customer", "supplier", "orders", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    a = sorted(tuple(_norm(r[c]) for c in df.columns) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert a == b


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() >= 0
