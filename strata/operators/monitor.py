"""A8-A10 and offset lag: monitors over the CDC event log.

Each takes an explicit ``as_of`` (never the wall clock) so results are
reproducible. All are filtered aggregates: the time filter is pushed into
the log scan, and the aggregates are partial + final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ts(x: str):
    return F.lit(x).cast("timestamp_ntz")


def since(df: DataFrame, ts_col: str, as_of: str, interval: str, strict: bool = False) -> DataFrame:
    """rows with ``ts_col`` within ``interval`` before ``as_of``, never later than it."""
    lo = _ts(as_of) - F.expr(f"INTERVAL {interval}")
    c = F.col(ts_col)
    return df.filter((c > lo if strict else c >= lo) & (c <= _ts(as_of)))


def cdc_event_audit(log: DataFrame, as_of_date: str, days: int = 7) -> DataFrame:
    """Count per event date, department and operation over ``days`` days
    before the start of ``as_of_date`` and that day itself; newest day first."""
    day = F.lit(as_of_date).cast("date")
    lo, hi = F.date_sub(day, days).cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    return (log.filter((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))
               .groupBy(F.to_date("event_ts").alias("event_date"), "source_dept", "operation")
               .agg(F.count(F.lit(1)).alias("event_count"))
               .orderBy(F.col("event_date").desc(), "source_dept"))


def cdc_status(log: DataFrame, as_of: str, window: str = "30 minutes") -> DataFrame:
    """One row (even when empty): events and newest event time in the window."""
    return since(log, "event_ts", as_of, window).agg(
        F.count(F.lit(1)).alias("total_events"), F.max("event_ts").alias("last_event_ts"))


def cdc_freshness(log: DataFrame, as_of: str, window: str = "5 minutes") -> DataFrame:
    """A10: 'ok' when the newest event is strictly inside the window, else 'warning'."""
    last = since(log, "event_ts", as_of, window, strict=True).agg(
        F.max("event_ts").alias("last_event_ts"))
    return last.select(F.when(F.col("last_event_ts").isNotNull(), "ok").otherwise("warning")
                        .alias("status"), "last_event_ts")


def offset_lag(log: DataFrame, latest_offsets: DataFrame) -> DataFrame:
    """Newest offset per topic-partition minus the newest consumed one.

    ``latest_offsets``: kafka_topic, kafka_partition, latest_offset (one row
    per topic-partition). A partition with nothing consumed lags by
    ``latest_offset + 1``.
    """
    consumed = (log.groupBy("kafka_topic", "kafka_partition")
                   .agg(F.max("kafka_offset").alias("consumed_offset")))
    j = latest_offsets.join(consumed, ["kafka_topic", "kafka_partition"], "left")
    return j.select("kafka_topic", "kafka_partition", "latest_offset", "consumed_offset",
                    (F.col("latest_offset") - F.coalesce("consumed_offset", F.lit(-1))).alias("lag"))
