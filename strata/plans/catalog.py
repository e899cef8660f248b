"""Query registry: one entry per operator, with its DuckDB oracle.

A query is a function ``Lake -> DataFrame`` plus (when the operator is
SQL-expressible) an oracle statement for DuckDB over the raw test tables.
Query modules register themselves with ``@query(name, sql)``.

Result policy for comparison: money leaves as DOUBLE on both sides (decimal
sums widen differently per engine, SURVEY §2.15); integer sums as BIGINT.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.oracle import with_ctes
from strata.session import compiled_methods
from strata.sources.lake import FixtureLake, Lake


@dataclass
class Query:
    name: str
    build: Callable[[Lake], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def doubles(df: DataFrame) -> DataFrame:
    """Money (decimal) columns as double, everything else unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _load_all():
    # Importing the query modules fills REGISTRY.
    from strata.plans import (queries_cdc, queries_feeds, queries_models, queries_quality, queries_reports,  # noqa: F401
                              queries_stream)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def runner(q: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            compiled_methods(spark)
            return doubles(q.build(FixtureLake(spark, sf_dir)))
        run.__name__ = q.name
        run.__doc__ = q.doc
        return run

    return {name: runner(q) for name, q in REGISTRY.items()}


@functools.lru_cache(maxsize=1)
def _describe_conn():
    import os

    import duckdb
    con = duckdb.connect()
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        d = f"/root/testdata/{sf}"
        if os.path.isdir(d):
            break
    else:
        return None
    from strata.sources.testdata import SOURCE_TABLES
    for t in SOURCE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    return con


def normalise_sql(sql: str) -> str:
    """Wrap an oracle statement so money is DOUBLE and HUGEINT sums are BIGINT."""
    try:
        con = _describe_conn()
        if con is None:
            return sql
        desc = con.execute(f"describe {sql}").fetchall()
    except Exception:
        return sql
    repl = []
    for name, ty, *_ in desc:
        u = ty.upper()
        q = '"' + name.replace('"', '""') + '"'
        if u.startswith("DECIMAL"):
            repl.append(f"cast({q} as double) as {q}")
        elif u in ("HUGEINT", "UHUGEINT"):
            repl.append(f"cast({q} as bigint) as {q}")
    if not repl:
        return sql
    return f"select * replace ({', '.join(repl)}) from (\n{sql}\n) oracle_q"


def oracle_statements() -> dict[str, str]:
    _load_all()
    out = {}
    for name, q in REGISTRY.items():
        if q.sql:
            out[name] = normalise_sql(with_ctes(q.sql))
    return out
