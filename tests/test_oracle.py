"""Every catalog query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from opslake.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple(str(x) for x in r))
    return [cols[i] for i in order], out


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "orders", "customer", "supplier", "nation"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["airline_name", "flights", "avg_dep_delay", "avg_arr_delay", "dep_on_time_pct"]
    assert df.count() > 0
