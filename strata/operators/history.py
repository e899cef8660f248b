"""De-duplication, type-2 history, ownership closing.

``neighbours`` is the skew-safe building block for ordered per-key scans
(lag / lead). A plain ``Window.partitionBy(key)`` sends every row of a key to
one task; if one record holds a third of the log that task holds a third of
the data. Instead:

1. ``repartitionByRange(key, order)`` — range bounds are sampled, so a hot
   key is cut into many slices (partitions), each a contiguous run;
2. lag / lead inside each (key, slice) — a window whose groups are at most
   one partition;
3. the first / last row of every (key, slice) gets its neighbour from the
   adjacent slice through a small edge table (one row per key and slice).
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import shared_dir

_pinned = threading.local()


def _pin(df: DataFrame) -> DataFrame:
    """Persist ``df`` and remember it for ``release_pinned`` (per thread, so
    parallel job tasks release only their own tables)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if not hasattr(_pinned, "frames"):
        _pinned.frames = []
    _pinned.frames.append(df)
    return df


def release_pinned() -> int:
    """Unpersist the slice tables ``neighbours`` cached in this thread. Call it
    once the query that used them has run; returns how many were released."""
    frames = getattr(_pinned, "frames", [])
    for df in frames:
        df.unpersist()
    _pinned.frames = []
    return len(frames)


def neighbours(df: DataFrame, keys: list[str], order: list[str], values: list[str],
               slices: int | None = None, slice_col: str | None = None,
               slice_width: int = 1_000_000) -> DataFrame:
    """Add ``_prev`` / ``_next``: struct(values) of the previous / next row of the
    same key in ``order`` (which must be a total order within a key).

    Slicing: with ``slice_col`` (an integer column unique within a key, such
    as a Kafka offset) a slice is ``floor(slice_col / slice_width)`` — at most
    ``slice_width`` rows of a key per slice, deterministic, no sampling.
    Otherwise slices are a sampled range partitioning on (key, order),
    materialised once with a reliable checkpoint so recomputation after a
    lost executor cannot re-slice differently.
    """
    spark = df.sparkSession
    if slice_col is not None:
        r = df.withColumn("_slice", F.floor(F.col(slice_col) / slice_width))
    else:
        n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
        r = (df.repartitionByRange(n, *[F.col(c) for c in keys + order])
               .withColumn("_slice", F.spark_partition_id()))
    r = (r.withColumn("_v", F.struct(*[F.col(c) for c in values]))
          .withColumn("_o", F.struct(*[F.col(c) for c in order])))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    r = r.withColumn("_prev", F.lag("_v").over(w)).withColumn("_next", F.lead("_v").over(w))
    if slice_col is None:
        shared_dir(spark)
        r = r.checkpoint(eager=True)
    else:
        # Deterministic slices: a cached copy (recomputed identically if an
        # executor is lost) feeds the row, border and edge branches.
        r = _pin(r)
    # Only the first and last row of each (key, slice) can miss a neighbour;
    # they alone build the edge table and take part in the join.
    border = r.filter(F.col("_prev").isNull() | F.col("_next").isNull())
    inner = r.filter(F.col("_prev").isNotNull() & F.col("_next").isNotNull())
    edges = (border.groupBy(*keys, "_slice")
                   .agg(F.first(F.when(F.col("_prev").isNull(), F.col("_v")), ignorenulls=True).alias("_first"),
                        F.first(F.when(F.col("_next").isNull(), F.col("_v")), ignorenulls=True).alias("_last")))
    we = Window.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(*keys, "_slice", F.lag("_last").over(we).alias("_prev_edge"),
                         F.lead("_first").over(we).alias("_next_edge"))
    fixed = (border.join(edges, keys + ["_slice"], "left")
                   .withColumn("_prev", F.coalesce("_prev", "_prev_edge"))
                   .withColumn("_next", F.coalesce("_next", "_next_edge"))
                   .drop("_prev_edge", "_next_edge"))
    return inner.unionByName(fixed).drop("_slice", "_v", "_o")


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` (ties: by all columns).

    ``max_by`` over a struct of the row is a hash aggregate with a map-side
    partial, so duplicates of a hot key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in order]
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(*keys).agg(F.max_by(row, rank).alias("_row"))
              .select("_row.*"))


def scd2(log: DataFrame, keys: list[str] | None = None, table: str | None = None,
         tracked: list[str] | None = None) -> DataFrame:
    """Type-2 history of captured records from the event log.

    A version starts at an upsert whose image (or, with ``tracked``, whose
    tracked fields) differs from the previous event of the key, or that
    follows a delete; consecutive unchanged images are one version. A version ends at the next version or delete of the key.
    Output: key, after_state, valid_from, valid_to (NULL = open),
    is_current, version_offset. A record's events share one topic-partition,
    so offsets are unique within a key and slice the scan (``neighbours``).
    """
    keys = keys or ["source_table", "subsidiary_id", "record_id"]
    order = ["kafka_offset", "event_ts", "kafka_topic", "kafka_partition"]
    is_del = F.col("operation") == "DELETE"
    if table is not None:
        log = log.filter(F.col("source_table") == table)
    # Only tracked fields define a change (all of the image by default).
    # The digest is over a JSON array, which keeps the place of every NULL.
    h = F.sha2("after_state" if not tracked else
               F.to_json(F.array(*[F.get_json_object("after_state", f"$.{c}") for c in tracked])), 256)
    ev = (log.filter(is_del | F.col("after_state").isNotNull())
             .select(*keys, *order, "after_state", is_del.alias("_del"), h.alias("_h")))
    nb = neighbours(ev, keys, order, ["_h", "_del"], slice_col="kafka_offset")
    p = F.col("_prev")
    new_version = ~F.col("_del") & (p.isNull() | p["_del"] | (p["_h"] != F.col("_h")))
    closes = F.col("_del") & p.isNotNull() & ~p["_del"]
    b = nb.filter(new_version | closes).drop("_prev", "_next")
    nb2 = neighbours(b, keys, order, ["event_ts"], slice_col="kafka_offset")
    return nb2.filter(~F.col("_del")).select(
        *keys, "after_state", F.col("event_ts").alias("valid_from"),
        F.col("_next.event_ts").alias("valid_to"), F.col("_next").isNull().alias("is_current"),
        F.col("kafka_offset").alias("version_offset"))


def scd2_merge(stored: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The history after ``changes``, the log rows that came since ``stored`` (an earlier result of ``scd2`` or of this
    function, over a log that ends before them).

    The open version of a key that changes is carried into the scan as its first event, so it ends, goes on or stays as it would in one scan of the whole
    log; closed versions and keys without changes pass through. Only the changes and the open versions of their keys are sorted.
    """
    if stored is None:
        return scd2(changes)
    keys = ["source_table", "subsidiary_id", "record_id"]
    touched = changes.select(*keys).distinct()
    carried = stored.filter("is_current").join(touched, keys, "left_semi")
    none = F.lit(None)
    first = carried.select(
        *keys, none.cast("string").alias("kafka_topic"), none.cast("int").alias("kafka_partition"), F.col("version_offset").alias("kafka_offset"),
        F.col("valid_from").alias("event_ts"), F.lit("SNAPSHOT").alias("operation"), "after_state")
    new = scd2(first.unionByName(changes.select(*first.columns)))
    rest = stored.filter("not is_current").unionByName(stored.filter("is_current").join(touched, keys, "left_anti"))
    return rest.unionByName(new.select(*rest.columns))


def close_to_100(df: DataFrame, group: str = "subsidiary_id", holder: str = "stockholder_id",
                 shares: str = "ownership_pct", out: str = "ownership_pct") -> DataFrame:
    """Ownership percentages that sum to exactly 100 per group.

    Each holder gets ``shares / total`` as a percentage rounded half-up to
    cents (exact integer arithmetic); the last holder (greatest id) absorbs
    the rounding residual. The per-group totals are one row per group and
    are broadcast back, so the holders are not shuffled.
    """
    units = (F.col(shares) * 100).cast("long")
    t = df.groupBy(group).agg(F.sum(units).alias("_total"), F.max(holder).alias("_last"))
    # One row per group (the group is the tenant: a registry-bounded count),
    # broadcast so the holders are never shuffled on a three-valued key.
    r = (df.join(F.broadcast(t), group)
           .withColumn("_num", units * 20000 + F.col("_total"))
           .withColumn("_den", F.col("_total") * 2)
           .withColumn("_bp", F.expr("_num div _den")))  # basis points, rounded half-up
    others = (r.filter(F.col(holder) != F.col("_last")).groupBy(group)
               .agg(F.sum("_bp").alias("_others")))
    r = r.join(F.broadcast(others), group, "left")
    final_bp = F.when(F.col(holder) == F.col("_last"),
                      F.lit(10000) - F.coalesce(F.col("_others"), F.lit(0))).otherwise(F.col("_bp"))
    return (r.withColumn(out, (final_bp.cast("decimal(12,0)") / 100).cast("decimal(6,2)"))
             .drop("_total", "_last", "_bp", "_others", "_num", "_den"))
