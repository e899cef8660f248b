"""Catalogue entries that run Structured Streaming queries to completion.

Each run lands the change messages (derived by Spark from the test tables) as
Parquet files in a fresh folder under the shared checkpoint directory, runs
the stream with ``trigger(availableNow=True)`` and returns what the sink
wrote. Results must equal the batch computation of the same operators.

The messages land in waves of ascending offsets, one after another, each a
micro-batch: files are taken in the order they were written. A wave has as
many files as its size asks for, so no task reads or sorts a fixed share of
the whole feed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import cdc
from strata.plans.catalog import query
from strata.plans.queries_cdc import FED, fed_state, fed_state_sql
from strata.session import scratch_path
from strata.streaming import cdc_stream

WAVES = 4


def _land_waves(feed, folder, target, waves, copies=1):
    """Append the messages of ``feed`` to ``target`` in ``waves`` parts of about as many offsets, each message ``copies`` times in the same
    part; returns how many files each has. ``folder`` keeps the feed, which is derived once."""
    spark = feed.sparkSession
    feed.write.parquet(folder)
    stored = spark.read.parquet(folder)
    cuts = stored.agg(F.percentile_approx("offset", [i / waves for i in range(1, waves)], 10000)).first()[0] if waves > 1 else []
    part = F.lit(0) + sum((F.coalesce(F.col("offset") > c, F.lit(False)).cast("int") for c in cuts or []), F.lit(0))
    files = -(-cdc_stream.files_for(spark, folder) * copies // waves)
    for wave in range(waves):
        rows = stored.filter(part == wave)
        for _ in range(copies - 1):
            rows = rows.unionByName(stored.filter(part == wave))
        rows.repartition(files).write.mode("append").parquet(target)
    return files


def _land(lake):
    """Land the change feed in a few waves: each wave becomes a micro-batch."""
    spark = lake.spark
    root = scratch_path(spark, "stream-runs", uuid.uuid4().hex)
    src = f"{root}/source"
    return spark, root, src, _land_waves(lake.cdc_messages(), f"{root}/feed", src, WAVES)


@query("stream_cdc_state", fed_state_sql())
def stream_cdc_state(lake):
    """The change stream applied micro-batch by micro-batch (foreachBatch,
    availableNow; log appended per batch, state compacted every 3 batches and
    merged on read) gives the same states as the one-shot merge, for every fed table."""
    spark, root, src, files = _land(lake)
    stream = cdc_stream.read_cdc_stream(spark, "files", src, max_per_trigger=files)
    q = cdc_stream.run_cdc_stream(spark, stream, f"{root}/out", f"{root}/ckpt", tables=list(FED),
                                  compact_every=3)
    q.awaitTermination()
    return fed_state({t: cdc_stream.read_state(spark, f"{root}/out", t) for t in FED})


@query("stream_log_dedup", "select * exclude (consumed_at) replace (true as is_processed) from ox_cdc_log")
def stream_log_dedup(lake):
    """Every message lands twice in its file and the whole feed lands again; state in the stream drops what comes again within the
    window, the log's own comparison the rest, so each position is logged once, and all are processed once the state is compacted."""
    spark = lake.spark
    root = scratch_path(spark, "stream-runs", uuid.uuid4().hex)
    feed = lake.cdc_messages()
    files = _land_waves(feed, f"{root}/feed", f"{root}/source", 2, copies=2)
    again = spark.read.parquet(f"{root}/feed").repartitionByRange(2 * files, "offset")
    again.write.mode("append").parquet(f"{root}/source")
    stream = cdc_stream.read_cdc_stream(spark, "files", f"{root}/source", max_per_trigger=files)
    q = cdc_stream.run_cdc_stream(spark, stream, f"{root}/out", f"{root}/ckpt", tables=list(FED), compact_every=2, dedup_window="1 hour")
    q.awaitTermination()
    return cdc_stream.read_log(spark, f"{root}/out").drop("consumed_at")


def _parsed_stream(lake):
    spark, root, src, files = _land(lake)
    stream = cdc_stream.read_cdc_stream(spark, "files", src, max_per_trigger=files)
    ok, _bad = cdc.split_valid(cdc.parse_envelope(stream))
    return spark, root, ok


@query("stream_30min_windows", """
select time_bucket(interval '30 minutes', event_ts) as window_start,
  time_bucket(interval '30 minutes', event_ts) + interval '30 minutes' as window_end,
  source_dept, operation, count(*) as events, max(event_ts) as last_event_ts
from ox_cdc_log group by 1, 2, 3, 4""")
def stream_30min_windows(lake):
    """Tumbling 30-minute windows of the change stream per department and operation."""
    spark, root, ok = _parsed_stream(lake)
    agg = cdc_stream.stream_monitor(ok, "30 minutes", watermark="365 days")
    out = f"{root}/windows"
    cdc_stream.run_to_table(agg, out, f"{root}/ckpt", mode="update").awaitTermination()
    return cdc_stream.read_latest(spark, out, ["window_start", "window_end", "source_dept", "operation"])


@query("stream_sessions", """
with e as (select source_table, event_ts,
    lag(event_ts) over (partition by source_table order by event_ts) as p from ox_cdc_log),
s as (select *, sum(case when p is null or event_ts >= p + interval '30 minutes' then 1 else 0 end)
    over (partition by source_table order by event_ts rows unbounded preceding) as sid from e)
select source_table, min(event_ts) as session_start, max(event_ts) + interval '30 minutes' as session_end,
  count(*) as events
from s group by source_table, sid""")
def stream_sessions(lake):
    """Activity sessions (30-minute gap) per captured table from the stream."""
    spark, root, ok = _parsed_stream(lake)
    agg = cdc_stream.stream_sessions(ok, "30 minutes", watermark="365 days")
    out = f"{root}/sessions"
    cdc_stream.run_to_table(agg, out, f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(out).select("source_table", "session_start", "session_end",
                                          F.col("events"))
