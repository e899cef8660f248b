"""Row filters and argument checks.

All filters are plain predicates, so Catalyst pushes them into the Parquet
scan (``PushedFilters``) and prunes ``subsidiary_id`` partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.monitor import since  # noqa: F401 - F4, one definition
from strata.schemas import CDC_TABLES, TABLES
from strata.sources.lake import live_predicate


def live(df: DataFrame, sub: str | None = None) -> DataFrame:
    """rows not soft-deleted, optionally of one tenant (``tenant_view``)."""
    out = df.filter(live_predicate())
    return out if sub is None else out.filter(F.col("subsidiary_id") == sub)


tenant_view = live


def get(df: DataFrame, id_value: int, sub: str) -> DataFrame:
    """point lookup by surrogate id within a tenant (live rows only)."""
    return live(df, sub).filter(F.col("id") == id_value)


def in_year(df: DataFrame, year: int, col: str = "fiscal_year") -> DataFrame:
    """rows of one fiscal year."""
    return df.filter(F.col(col) == year)


def future_dated(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """rows dated after ``as_of`` (violations)."""
    return df.filter(F.col(col) > F.lit(as_of).cast("date"))


def dept_allowed(table: str, dept: str) -> bool:
    """F8: whether ``dept`` serves ``table`` (purchase_orders: ops or procurement)."""
    return table in CDC_TABLES.get(dept, [])


def validate_lookback(days: int | None = None, months: int | None = None,
                      month: int | None = None, year: int | None = None) -> None:
    """look-back argument ranges, checked before any plan is built."""
    if days is not None and not 1 <= days <= 365:
        raise ValueError("days must be between 1 and 365")
    if months is not None and not 1 <= months <= 12:
        raise ValueError("months must be between 1 and 12")
    if month is not None and not 0 <= month <= 12:
        raise ValueError("month must be between 0 and 12")
    if year is not None and year < 2000:
        raise ValueError("year must be 2000 or later")


def limit_rows(df: DataFrame, days: int, order: str = "id") -> DataFrame:
    """L3: the reference's ``days`` row cap (``days * 5`` rows), ordered for determinism."""
    validate_lookback(days=days)
    return df.orderBy(order).limit(days * 5)


def serve(df: DataFrame, order_by: list[str], limit: int = 5000) -> DataFrame:
    """The BI result cap — top ``limit`` rows in a stable order."""
    return df.orderBy(*order_by).limit(limit)


def records(lake, dept: str, table: str, days: int, as_of: str) -> DataFrame:
    """A department's live records of ``table`` dated within ``days`` days
    before ``as_of`` (by the table's business date); all of them where it has none."""
    if not dept_allowed(table, dept):
        raise ValueError(f"{dept} does not serve {table}")
    validate_lookback(days=days)
    if TABLES[table].date_col is None:
        return lake.bronze(table)
    col = F.col(TABLES[table].date_col)
    end = F.lit(as_of).cast("date")
    return lake.bronze(table).filter((col > F.date_sub(end, days)) & (col <= end))
