"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.catalog import oracle_statements, spark_queries

from paths import SF_SMALL
from test_plans import FORBIDDEN

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = spark_queries()
SQL = oracle_statements()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def _sorted(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _sorted([tuple(r[c] for c in cols) for r in df.collect()])
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = _sorted([tuple(r[i] for i in idx) for r in res.fetchall()])
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["subsidiary_id", "fiscal_year", "fiscal_month"]
