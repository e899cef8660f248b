"""Structured Streaming for change capture.

``read_cdc_stream`` subscribes to the change topics (Kafka, or a file source
of the same shape for tests); ``CdcBatchWriter`` is the ``foreachBatch``
sink that appends the immutable event log, quarantines bad messages and
merges each captured table into versioned bronze state — the same operators
the batch path uses. ``stream_monitor`` / ``stream_sessions`` are the
windowed monitors.

Exactly-once: Spark's checkpoint records the offsets of each micro-batch;
every write of batch ``b`` goes to a location named by ``b`` and is written
with overwrite, and the state version ``b`` is derived from version ``< b``.
Replaying ``b`` after a failure therefore rewrites identical output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cdc, images
from strata.schemas import CDC_TABLES, TOPIC_PATTERN
from strata.sources import store

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string"
LOG_SCHEMA = ("kafka_topic string, kafka_partition int, kafka_offset bigint, subsidiary_id string, source_dept string, source_table string, "
              "operation string, record_id string, before_state string, after_state string, event_ts timestamp_ntz, "
              "consumed_at timestamp_ntz, is_processed boolean, _batch bigint, _range bigint")
OFFSETS_PER_RANGE = 1_000_000
MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
MESSAGES_PER_FILE = 100_000  # where the size is not known before a file is written
BYTES_PER_FILE = 8_000_000  # of compressed messages; a file is read by one task


def read_cdc_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                    bootstrap_servers: str | None = None, max_per_trigger: int | None = None,
                    options: dict | None = None) -> DataFrame:
    """The change stream as (topic, partition, offset, timestamp, value).

    ``source="kafka"`` subscribes by pattern from the earliest offset with
    ``maxOffsetsPerTrigger`` as back-pressure (the Kafka connector jar must be
    on the cluster's classpath). ``source="files"`` reads Parquet files of the
    same shape with ``maxFilesPerTrigger``.
    """
    if source == "kafka":
        r = (spark.readStream.format("kafka")
             .option("subscribePattern", TOPIC_PATTERN)
             .option("startingOffsets", "earliest"))
        if bootstrap_servers:
            r = r.option("kafka.bootstrap.servers", bootstrap_servers)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        raw = r.load()
        return raw.select("topic", "partition", "offset",
                          F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                          F.col("value").cast("string").alias("value"))
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.parquet(path)


def files_for(spark: SparkSession, path: str, least: int = 1) -> int:
    """How many files the messages stored at ``path`` are dealt into, so that none outgrows a task."""
    return max(least, -(-store.size_of(spark, path) // BYTES_PER_FILE))


def once_per_position(messages: DataFrame, window: str = "1 hour") -> DataFrame:
    """Messages delivered again within ``window`` of their first arrival go in the stream, by state on (topic, partition,
    offset). The watermark runs on the time of arrival, so no message is ever late and none is lost, however old the change
    it carries; state holds the positions that arrived within ``window``. What comes again later is caught by
    the log's own comparison (``cdc.append_cdc_log``)."""
    arrived = messages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", window)
    return arrived.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("_arrived")


def offset_range() -> Column:
    """The range of offsets a log row is stored under."""
    return F.floor(F.col("kafka_offset") / F.lit(OFFSETS_PER_RANGE)).cast("long")


def log_in_ranges(log: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored log's rows in the offset ranges that ``batch`` touches, as a partition filter: files of other ranges are not
    opened. The ranges come to the driver as numbers; they are at most as many as topic-partitions plus one
    for each ``OFFSETS_PER_RANGE`` rows of the batch."""
    ranges = [r[0] for r in batch.select(offset_range().alias("r")).distinct().collect() if r[0] is not None]
    return log.filter(F.col("_range").isin(ranges)) if ranges else log.filter(F.lit(False))


class CdcBatchWriter:
    """The ``foreachBatch`` sink (merge-on-read).

    Layout under ``root``: ``log/_batch=<b>/_range=<r>``, ``quarantine/_batch=<b>``,
    ``state/<table>/v=<b>``; ``r`` numbers ranges of offsets, so the comparison of a batch with
    the log opens only the ranges the batch touches. Every micro-batch appends its new log rows; every
    ``compact_every`` batches the log rows since the last compacted version
    are merged into a new state version (so a micro-batch never rewrites the
    whole state). ``read_state`` = last version merged with the log tail, so
    readers always see every appended change. The set of tables in a batch
    is read from the batch (at most the size of the capture registry).
    """

    def __init__(self, root: str, tables: list[str] | None = None, compact_every: int = 1):
        self.root = root.rstrip("/")
        self.tables = tables
        self.compact_every = max(1, compact_every)

    def log(self, spark: SparkSession) -> DataFrame | None:
        return stored_log(spark, self.root)

    def state(self, spark: SparkSession, table: str) -> DataFrame | None:
        return read_state(spark, self.root, table)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = images.with_faults(cdc.parse_envelope(batch)).withColumn(
            "consumed_at", F.current_timestamp().cast("timestamp_ntz"))
        parsed = parsed.persist()
        try:
            ok, bad = cdc.split_valid(parsed)[0], images.dead_letters(parsed)
            bad.write.mode("overwrite").parquet(f"{self.root}/quarantine/_batch={batch_id}")
            log = self.log(spark)
            if log is not None:
                log = log_in_ranges(log.filter(F.col("_batch") != batch_id), ok).drop("_batch", "_range")
            new = cdc.append_cdc_log(log, ok).withColumn("_range", offset_range())
            # Static: under dynamic overwrite a replayed batch could keep ranges of an attempt that failed.
            (new.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_range")
             .parquet(f"{self.root}/log/_batch={batch_id}"))
        finally:
            parsed.unpersist()
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merge log batches ``(last version, upto]`` into state version ``upto``."""
        log = stored_log(spark, self.root)
        tables = self.tables or [r[0] for r in log.filter(F.col("_batch") <= upto)
                                 .select("source_table").distinct().collect()]
        for t in tables:
            if t not in cdc.TABLES:
                continue
            base = f"{self.root}/state/{t}"
            done = store.committed_versions(spark, base)
            if done and done[-1] >= upto:
                continue  # already compacted (replayed batch)
            last = max([v for v in done if v < upto], default=-1)
            prev = store.read_version(spark, base, last) if last >= 0 else None
            tail = log.filter((F.col("_batch") > last) & (F.col("_batch") <= upto)).drop("_batch", "_range")
            store.write_version(cdc.merge_changes(prev, tail, t), base, upto)


def stored_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The event log under ``root`` with its ``_batch`` and ``_range``; None before the first batch. The schema is given, so a log whose batches are
    all empty reads as no rows, and planning opens no file."""
    path = f"{root.rstrip('/')}/log"
    return spark.read.schema(LOG_SCHEMA).parquet(path) if store.exists(spark, path) else None


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The event log as readers see it: ``is_processed`` is true for rows whose batch is merged into a committed state version of their
    table (D24). The versions are one number per captured table."""
    log = stored_log(spark, root)
    if log is None:
        return None
    base = f"{root.rstrip('/')}/state"
    merged = {t: v[-1] for ts in CDC_TABLES.values() for t in ts if (v := store.committed_versions(spark, f"{base}/{t}"))}
    upto = F.try_element_at(F.create_map(*[F.lit(x).cast(k) for t, v in merged.items() for x, k in ((t, "string"), (v, "long"))]),
                            F.col("source_table")) if merged else F.lit(None).cast("long")
    return log.withColumn("is_processed", F.coalesce(F.col("_batch") <= upto, F.lit(False))).drop("_batch", "_range")


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Current state of ``table``: the last compacted version merged with the
    log batches appended after it (merge-on-read)."""
    root = root.rstrip("/")
    base = f"{root}/state/{table}"
    done = store.committed_versions(spark, base)
    last = done[-1] if done else -1
    prev = store.read_version(spark, base, last) if done else None
    log = stored_log(spark, root)
    if log is None:
        return prev
    tail = log.filter(F.col("_batch") > last).drop("_batch", "_range")
    return cdc.merge_changes(prev, tail, table)


def run_cdc_stream(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str,
                   tables: list[str] | None = None, available_now: bool = True,
                   compact_every: int = 1, dedup_window: str | None = None):
    """Start the change-capture stream; with ``available_now`` it drains the
    source and stops (``trigger(availableNow=True)``). With ``dedup_window`` messages that come again within it
    are dropped in the stream (``once_per_position``)."""
    if dedup_window:
        messages = once_per_position(messages, dedup_window)
    q = (messages.writeStream.foreachBatch(CdcBatchWriter(root, tables, compact_every))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def events_with_time(parsed: DataFrame) -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ) event time; the session zone is UTC."""
    return parsed.withColumn("event_time", F.col("event_ts").cast("timestamp"))


def stream_monitor(parsed: DataFrame, window: str = "30 minutes", watermark: str = "1 day") -> DataFrame:
    """Events and newest event per tumbling window, department and operation."""
    e = events_with_time(parsed).withWatermark("event_time", watermark)
    return (e.groupBy(F.window("event_time", window).alias("w"), "source_dept", "operation")
             .agg(F.count(F.lit(1)).alias("events"), F.max("event_ts").alias("last_event_ts"))
             .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                     "source_dept", "operation", "events", "last_event_ts"))


def stream_sessions(parsed: DataFrame, gap: str = "30 minutes", watermark: str = "1 day") -> DataFrame:
    """Activity sessions per captured table; a gap longer than ``gap`` ends one. There are few tables, so tasks merge their events into sessions
    before the exchange (``MERGE_FIRST``): what reaches a table's task are the sessions of each task, not its events."""
    e = events_with_time(parsed).withWatermark("event_time", watermark)
    return (e.groupBy(F.session_window("event_time", gap).alias("s"), "source_table")
             .agg(F.count(F.lit(1)).alias("events"))
             .select("source_table", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                     F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events"))


def run_to_table(df: DataFrame, out: str, checkpoint: str, mode: str = "complete"):
    """Drain a streaming aggregate into Parquet at ``out``.

    ``complete``: every micro-batch overwrites ``out`` with the whole result
    (needed when a key can change, as a merged session window's start does).
    ``update``: a micro-batch writes only the rows it changed, to
    ``out/_batch=<id>`` (overwritten on replay, so exactly-once); state and
    output per batch stay bounded by the watermark. Read with ``read_latest``.
    """
    spark = df.sparkSession
    set_before = spark.conf.get(MERGE_FIRST, None)
    spark.conf.set(MERGE_FIRST, "true")  # the query takes the session's settings when it starts

    def sink(batch: DataFrame, batch_id: int) -> None:
        if mode == "update":
            batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        else:
            batch.write.mode("overwrite").parquet(out)
    try:
        return (df.writeStream.outputMode(mode).foreachBatch(sink)
                  .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(MERGE_FIRST, set_before) if set_before is not None else spark.conf.unset(MERGE_FIRST)


def read_latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Merge-on-read of an ``update``-mode table: per key, the row of the
    newest batch (an aggregate with map-side partials, no global sort)."""
    df = spark.read.parquet(out)
    vals = [c for c in df.columns if c not in keys and c != "_batch"]
    latest = F.max_by(F.struct(*[F.col(c) for c in vals]), "_batch").alias("_v")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])