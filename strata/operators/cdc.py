"""Change capture: envelope parsing, the immutable event log, and merging
changes into bronze state (T1, T2, T5, T7, X6-X10, F7, M1-M5, S4).

Everything is a DataFrame transformation, usable in batch or inside a
streaming ``foreachBatch`` (``strata.streaming.cdc_stream``).

Scale notes
* Parsing is row-local (``from_json``/``get_json_object``); no shuffle. Each
  envelope and image is parsed once (``columns.once``), where the rows were
  dealt out, whatever is filtered afterwards.
* ``append_cdc_log`` compares a batch with log rows at or above its lowest
  offset per Kafka topic-partition. That bound is a join condition, so the
  three key columns of the log are scanned; the bounds table has one row per
  topic-partition, a number fixed by topic configuration.
* ``merge_changes`` is one hash aggregate on (subsidiary_id, id) built from
  ``max_by`` — a declarative aggregate with a map-side partial, so a key
  updated millions of times is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import (epoch_ms_to_ts, epoch_us_to_ts, once, operation_name, record_id,
                                     topic_parts)
from strata.schemas import CDC_TABLES, TABLES

LOG_KEYS = ["kafka_topic", "kafka_partition", "kafka_offset"]

_ENVELOPE = ("op string, before string, after string, ts_ms bigint, "
             "__op string, __ts_ms bigint, __deleted string, _corrupt string")
_ENVELOPE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _json_text(c: Column) -> Column:
    """Raw JSON text of a string-typed field; JSON null -> SQL NULL."""
    return F.when(c.isNull() | (F.trim(c) == "null"), F.lit(None)).otherwise(c)


def parse_envelope(messages: DataFrame, consumed_at: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Kafka-shaped rows -> candidate event-log rows plus a ``reject_reason``.

    Input columns: ``topic, partition, offset, value`` (+ optional ``timestamp``).
    Accepts the full Debezium envelope (op/before/after/ts_ms) and the
    flattened record (row columns + ``__op``/``__ts_ms``): a row is flattened
    when it has ``__op`` and no ``op``; its image is the record without the
    fields that begin with ``__``. Tombstones (NULL value) are dropped.
    ``keep`` names further input columns to carry.
    """
    from strata.operators.images import strip_metadata
    keep = keep or []
    v = F.col("value").cast("string")
    m = messages.filter(F.col("value").isNotNull())
    env = F.from_json("value", _ENVELOPE, _ENVELOPE_OPTIONS)  # one parse; bad documents land in _corrupt
    m = (m.select("topic", "partition", "offset", *keep, v.alias("value"), F.split("topic", r"\.").alias("s"))
          .select("topic", "partition", "offset", *keep, "value", topic_parts("topic", "s").alias("t"))
          .select("topic", "partition", "offset", *keep, "value", "t", once(env).alias("e")))
    flat = F.col("e.op").isNull() & F.col("e.__op").isNotNull()
    op = F.when(flat, F.col("e.__op")).otherwise(F.col("e.op"))
    is_del = op == "d"
    after = F.when(flat, F.when(~is_del, strip_metadata(F.col("value")))).otherwise(_json_text(F.col("e.after")))
    before = F.when(flat, F.when(is_del, strip_metadata(F.col("value")))).otherwise(_json_text(F.col("e.before")))
    ts_ms = F.when(flat, F.col("e.__ts_ms")).otherwise(F.col("e.ts_ms"))
    valid_json = F.col("e._corrupt").isNull()
    m = m.select("topic", "partition", "offset", *keep, "value", "t",
                 once(F.named_struct(F.lit("op"), op, F.lit("after"), after, F.lit("before"), before, F.lit("ts_ms"), ts_ms,
                                     F.lit("valid"), valid_json)).alias("r"))
    op, after, before, ts_ms, valid_json = (F.col(f"r.{c}") for c in ("op", "after", "before", "ts_ms", "valid"))
    known = F.concat_ws(".", F.col("t.source_dept"), F.col("t.source_table")).isin(
        [f"{d}.{t}" for d, ts in CDC_TABLES.items() for t in ts])
    reason = (F.when(~valid_json, "invalid json")
               .when(F.col("t.reason").isNotNull(), F.col("t.reason"))
               .when(~known, "table not captured for department"))
    consumed = (F.lit(consumed_at).cast("timestamp_ntz") if consumed_at
                else F.lit(None).cast("timestamp_ntz"))
    return m.select(
        F.col("topic").alias("kafka_topic"), F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("t.subsidiary_id").alias("subsidiary_id"), F.col("t.source_dept").alias("source_dept"),
        F.col("t.source_table").alias("source_table"),
        operation_name(op).alias("operation"),
        record_id(after, before).alias("record_id"),
        before.alias("before_state"), after.alias("after_state"),
        epoch_ms_to_ts(ts_ms).alias("event_ts"),
        consumed.alias("consumed_at"), F.lit(False).alias("is_processed"),
        reason.alias("reject_reason"), F.col("value").alias("raw_value"), *keep)


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(log rows, quarantine rows). Quarantine keeps the raw value and reason."""
    ok = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_value")
    bad = parsed.filter(F.col("reject_reason").isNotNull()).select(
        *LOG_KEYS, "raw_value", "reject_reason")
    return ok, bad


def position() -> Column:
    """Where a log row stands among all changes of its record: (commit time, topic, partition, offset). Within a topic-partition the
    commit time follows the offset; a record captured on several topics has offsets that say nothing about each other,
    and there the commit time decides."""
    return F.struct(F.coalesce(F.col("event_ts"), F.lit("1970-01-01").cast("timestamp_ntz")).alias("t"), F.col("kafka_topic").alias("p"),
                    F.col("kafka_partition").alias("q"), F.col("kafka_offset").alias("o"))


def append_cdc_log(log: DataFrame | None, batch: DataFrame) -> DataFrame:
    """M1: the rows of ``batch`` to append — new (topic, partition, offset) only.

    Duplicates inside the batch collapse to one row; rows already in ``log``
    are dropped (re-delivery is harmless). Returns only the rows to append.
    """
    fresh = batch.dropDuplicates(LOG_KEYS)
    if log is None:
        return fresh
    bounds = (batch.groupBy("kafka_topic", "kafka_partition")
                   .agg(F.min("kafka_offset").alias("_lo")))
    # One row per topic-partition: bounded by topic configuration.
    recent = (log.select(*LOG_KEYS)
                 .join(F.broadcast(bounds), ["kafka_topic", "kafka_partition"])
                 .filter(F.col("kafka_offset") >= F.col("_lo"))
                 .select(*LOG_KEYS))
    return fresh.join(recent, LOG_KEYS, "left_anti")


# ---------------------------------------------------------------------------
# Typed merge into bronze state
# ---------------------------------------------------------------------------
_PROTECTED = {"id", "subsidiary_id", "ingested_at"}
STATE_EXTRA = [("cdc_operation", T.StringType()), ("cdc_event_ts", T.TimestampNTZType()),
               ("cdc_topic", T.StringType()), ("cdc_partition", T.IntegerType()), ("cdc_offset", T.LongType())]


def _typed(text: Column, dtype: T.DataType, epoch: bool = True) -> Column:
    """JSON scalar text -> typed value. Dates accept ISO text or epoch days,
    timestamps ISO text or epoch micros; decimals accept JSON doubles. Polled
    feeds (``epoch=False``) send no epoch numbers: there a bare number is a
    date only as yyyymmdd, and no timestamp."""
    digits = text.rlike(r"^-?\d+$")
    if not epoch and isinstance(dtype, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        if isinstance(dtype, T.DateType):
            iso = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
            return F.when(~digits, F.to_date(F.try_to_timestamp(text))).when(text.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(iso)))
        return F.when(~digits, F.try_to_timestamp(text).cast("timestamp_ntz"))
    if isinstance(dtype, T.DateType):
        return F.when(digits, F.date_add(F.lit("1970-01-01").cast("date"), text.try_cast("int"))) \
                .otherwise(F.to_date(F.try_to_timestamp(text)))
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.when(digits, epoch_us_to_ts(text)) \
                .otherwise(F.try_to_timestamp(text).cast("timestamp_ntz"))
    if isinstance(dtype, T.BooleanType):
        return F.when(F.lower(text).isin("true", "t", "1"), F.lit(True)).when(
            F.lower(text).isin("false", "f", "0"), F.lit(False))
    if isinstance(dtype, T.StringType):
        return text
    return text.try_cast(dtype)


def data_columns(table: str) -> list[T.StructField]:
    t = TABLES[table]
    return [f for f in t.schema.fields if f.name not in _PROTECTED
            and f.name not in ("is_deleted", "deleted_at")]


def image_id() -> Column:
    """The id in a log row's image: the one before a delete, else the one after the change."""
    image = F.when(F.col("operation") == "DELETE", F.col("before_state")).otherwise(F.col("after_state"))
    return F.get_json_object(image, "$.id").try_cast("bigint")


def merge_changes(state: DataFrame | None, changes: DataFrame, table: str,
                  batch_time: str | None = None) -> DataFrame:
    """M2-M5: apply log rows of one table to its bronze state.

    * INSERT / UPDATE / SNAPSHOT set every column *present* in ``after``
      (absent keeps the old value, an explicit null sets NULL), except
      id / subsidiary_id / ingested_at. ``ingested_at`` is first-seen.
    * DELETE marks ``is_deleted`` and ``deleted_at`` (the event time), keeps
      the content; a delete of an unknown key is a no-op.
    * An upsert after a delete clears the flag unless its image says
      ``is_deleted: true`` (decision M4).
    * Order within a key is ``position``: commit time, topic, partition,
      offset. The state row stands where its last change stood, so replayed
      old changes lose against it.

    ``state`` has the bronze columns plus ``STATE_EXTRA``; the result has the
    same shape. A column ``id`` of ``changes`` is taken as their ``image_id``.
    """
    fields = data_columns(table)
    names = [f.name for f in fields]
    ch = changes.filter(F.col("source_table") == table)
    is_del = F.col("operation") == "DELETE"
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in names + ["is_deleted",
                                                                                    "deleted_at"]])
    ordv = position()
    up = ~is_del & F.col("after_state").isNotNull()
    of_image = F.col("id") if "id" in ch.columns else image_id()
    ids = ch.select("subsidiary_id", of_image.alias("id")).filter(F.col("id").isNotNull())  # keys alone: no image is parsed for them
    image = F.named_struct(F.lit("id"), of_image,
                           F.lit("parsed"), F.from_json(F.col("after_state"), text_schema),
                           F.lit("keys"), F.coalesce(F.json_object_keys(F.col("after_state")), F.array().cast("array<string>")))
    brought = ["id"] if "id" in ch.columns else []
    ch = (ch.select("subsidiary_id", "operation", "event_ts", *LOG_KEYS, *brought, "before_state", "after_state", up.alias("_up"))
            .select("subsidiary_id", "operation", "event_ts", *LOG_KEYS, "_up", once(image).alias("_i")))
    up, parsed, keys = F.col("_up"), F.col("_i.parsed"), F.col("_i.keys")
    cols = [F.col("subsidiary_id"),
            F.col("_i.id").alias("id"),
            F.when(up | is_del, ordv).alias("_ord"),
            F.when(up, ordv).alias("_content_ord"),
            F.when(up, F.col("operation")).alias("_op")]
    for f in fields:
        value = _typed(parsed[f.name], f.dataType)
        # A value that does not parse as the column's type never replaces a good one.
        present = up & F.array_contains(keys, f.name) & (parsed[f.name].isNull() | value.isNotNull())
        cols.append(F.struct(present.alias("p"), value.alias("v")).alias(f"_c_{f.name}"))
    img_del = F.array_contains(keys, "is_deleted")
    del_flag = F.when(is_del, F.lit(True)).when(
        img_del, _typed(parsed["is_deleted"], T.BooleanType())).otherwise(F.lit(False))
    cols += [del_flag.alias("_del"),
             F.when(is_del, F.col("event_ts")).when(
                 img_del & del_flag, _typed(parsed["deleted_at"], T.TimestampNTZType()))
              .alias("_del_at"),
             F.lit(batch_time).cast("timestamp_ntz").alias("_seen")
             if batch_time else F.col("event_ts").alias("_seen")]
    events = ch.select(*cols).filter(F.col("id").isNotNull())

    untouched = None
    if state is not None:
        # Only state rows whose key occurs in this batch take part in the
        # aggregate; the rest pass through unchanged. The batch's key set is
        # small, so AQE broadcasts it and the state is scanned, not shuffled.
        touched = ids.select("subsidiary_id", "id").distinct()
        untouched = state.join(touched, ["subsidiary_id", "id"], "left_anti")
        state = state.join(touched, ["subsidiary_id", "id"], "left_semi")
        s_ord = F.struct(F.coalesce(F.col("cdc_event_ts"), F.lit("1970-01-01").cast("timestamp_ntz")).alias("t"), F.col("cdc_topic").alias("p"),
                         F.col("cdc_partition").alias("q"), F.coalesce(F.col("cdc_offset"), F.lit(-1).cast("long")).alias("o"))
        scols = [F.col("subsidiary_id"), F.col("id").cast("bigint").alias("id"),
                 s_ord.alias("_ord"), s_ord.alias("_content_ord"),
                 F.col("cdc_operation").alias("_op")]
        for f in fields:
            scols.append(F.struct(F.lit(True).alias("p"), F.col(f.name).alias("v"))
                         .alias(f"_c_{f.name}"))
        scols += [F.coalesce(F.col("is_deleted"), F.lit(False)).alias("_del"),
                  F.col("deleted_at").alias("_del_at"), F.col("ingested_at").alias("_seen")]
        events = events.unionByName(state.select(*scols))

    aggs = [F.max("_content_ord").alias("_has_content"),
            F.max_by("_op", "_content_ord").alias("cdc_operation"),
            F.max_by("_del", "_ord").alias("is_deleted"),
            F.max_by("_del_at", "_ord").alias("_del_at"),
            F.min("_seen").alias("ingested_at"),
            F.max("_ord").alias("_last")]
    for f in fields:
        aggs.append(F.max_by(F.col(f"_c_{f.name}.v"),
                             F.when(F.col(f"_c_{f.name}.p"), F.col("_content_ord"))).alias(f.name))
    merged = events.groupBy("subsidiary_id", "id").agg(*aggs).filter(F.col("_has_content").isNotNull())
    final = []
    for c in TABLES[table].columns:
        if c.name == "deleted_at":
            e = F.when(F.col("is_deleted"), F.col("_del_at"))
        elif c.name in names and c.not_null and c.default is not None:
            e = F.coalesce(F.col(c.name), default_value(c, F.col("ingested_at")))
        else:
            e = F.col(c.name)
        final.append(e.cast(c.dtype).alias(c.name))
    out = merged.select(*final, "cdc_operation", F.col("_last.t").alias("cdc_event_ts"), F.col("_last.p").alias("cdc_topic"),
                        F.col("_last.q").alias("cdc_partition"), F.col("_last.o").alias("cdc_offset"))
    if untouched is not None:
        out = out.unionByName(untouched.select(*out.columns))
    return out


def default_value(c, now: Column) -> Column:
    """The DDL default of a column as a Column (``now`` for NOW())."""
    d = c.default
    if d == "now":
        return now
    if d.startswith("'"):
        return F.lit(d.strip("'"))
    if d in ("true", "false"):
        return F.lit(d == "true")
    return F.lit(d).cast(c.dtype)


def empty_state(spark, table: str) -> DataFrame:
    schema = T.StructType(list(TABLES[table].schema.fields) + [T.StructField(n, t) for n, t in STATE_EXTRA])
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------
# Record-level (schemaless) state and history over the event log
# ---------------------------------------------------------------------------
def record_state(log: DataFrame) -> DataFrame:
    """Latest state of every captured record, straight from the event log.

    One row per (source_table, subsidiary_id, record_id) with the last content
    image (JSON), the last operation, the soft-delete flag and its time,
    first/last event time and the event count. Delete-only keys are dropped.
    """
    is_del = F.col("operation") == "DELETE"
    up = ~is_del & F.col("after_state").isNotNull()
    ordv = position()
    g = (log.groupBy("source_table", "subsidiary_id", "record_id")
            .agg(F.max_by(F.when(up, F.col("after_state")), F.when(up, ordv)).alias("after_state"),
                 F.max_by(F.when(up, F.col("operation")), F.when(up, ordv)).alias("cdc_operation"),
                 F.max_by(is_del, ordv).alias("is_deleted"),
                 F.max(F.when(is_del, F.col("event_ts"))).alias("_last_delete"),
                 F.max(F.when(up, F.lit(1))).alias("_has_content"),
                 F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"),
                 F.count(F.lit(1)).alias("n_events"), F.max("kafka_offset").alias("last_offset")))
    return g.filter(F.col("_has_content").isNotNull()).select(
        "source_table", "subsidiary_id", "record_id", "after_state", "cdc_operation", "is_deleted",
        F.when(F.col("is_deleted"), F.col("_last_delete")).alias("deleted_at"),
        "first_event_ts", "last_event_ts", "n_events", "last_offset")
