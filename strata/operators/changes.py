"""DML as DataFrame operators.

* ``ingest`` — polled text records -> typed bronze rows (renames, fallbacks,
  defaults, generated columns) and a quarantine of rows that break NOT NULL
  or carry a value that does not parse.
* ``insert_ignore`` — insert-if-absent on the natural key, first write wins.
* ``patch`` — partial updates: only fields *present* in a patch change.
* ``create`` — validated insert with defaults and audit columns.

All are single-pass aggregates / anti joins on the natural key; a batch is
reduced to one row per key (``min_by`` / ``max_by``, with map-side partial
aggregation) before it meets the target, so a hot key never fans out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import once, penalty
from strata.operators.cdc import _typed, default_value
from strata.schemas import FEED_FALLBACKS, FEED_RENAMES, TABLES

# Fields a partial update may change, per table.
PATCHABLE = {
    "journal_entries": ["entry_date", "account_code", "debit_amount", "credit_amount",
                        "description", "status", "posted_by", "approved_by"],
    "ap_invoices": ["status", "payment_amount", "payment_date", "approved_by"],
    "sales_transactions": ["transaction_date", "gross_amount", "discount_amount", "vat_amount",
                           "net_amount", "status"],
    "employees": ["position", "basic_salary", "department"],
    "customers": ["customer_name", "contact_email", "phone", "is_active"],
    "vendors": ["vendor_name", "is_accredited", "payment_terms"],
}


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols, F.lit(True))


def with_generated(df: DataFrame, table: str) -> DataFrame:
    """Stored generated columns (bir_filings_log.penalty_amount)."""
    for col, parts in TABLES[table].generated.items():
        df = df.withColumn(col, penalty(*parts))
    return df


def ingest(records: DataFrame, table: str, ingested_at: str, feed: str | None = None
           ) -> tuple[DataFrame, DataFrame]:
    """Polled records (any column types, usually text) -> (bronze rows, quarantine).

    * field renames and fallbacks of the feed (X15, X16);
    * every bronze column typed with ``try``-casts; a present value that does
      not parse sends the row to quarantine;
    * NULL in a NOT NULL column with a default takes the default (D15, X17);
      NULL in a NOT NULL or natural-key column without one sends the row to
      quarantine;
    * fields outside the bronze schema are dropped; ``ingested_at`` is stamped.
    """
    t = TABLES[table]
    feed = feed or table
    df = records
    for src, dst in FEED_FALLBACKS.get(feed, {}).items():
        if dst in df.columns:
            df = df.withColumn(src, F.coalesce(F.col(src), F.col(dst)) if src in df.columns
                               else F.col(dst))
    for src, dst in FEED_RENAMES.get(feed, {}).items():
        if src in df.columns:
            df = df.withColumn(dst, F.coalesce(F.col(dst), F.col(src)) if dst in df.columns
                               else F.col(src))
    now = F.lit(ingested_at).cast("timestamp_ntz")
    read = [c for c in t.columns if c.name in df.columns and c.name != "ingested_at"]
    # Each text and each typed value is worked out once a row; as projections they would be repeated in every problem, filter and join above.
    df = df.select(once(F.struct(*[F.trim(F.col(c.name).cast("string")).alias(c.name) for c in read])).alias("_r")) if read else df
    df = df.select("_r", once(F.struct(*[_typed(F.col("_r")[c.name], c.dtype, epoch=False).alias(c.name) for c in read])).alias("_v")) if read else df
    typed, problems = [], []
    for c in t.columns:
        if c.name == "ingested_at":
            typed.append(now.alias(c.name))
            continue
        v = F.lit(None).cast("string")
        if c in read:
            v = F.col("_v")[c.name]
            problems.append(F.when((F.col("_r")[c.name] != "") & v.isNull(), F.lit(f"bad value in {c.name}")))
        if c.default is not None:
            v = F.coalesce(v, default_value(c, now))
        elif (c.not_null or c.name in t.keys) and c.name != "id":
            problems.append(F.when(v.isNull(), F.lit(f"{c.name} is null")))
        typed.append(v.cast(c.dtype).alias(c.name))
    reason = F.concat_ws("; ", *problems)  # leaves out nulls
    out = df.select(*typed, once(reason).alias("_reason"))
    out = with_generated(out, table)
    good = out.filter(F.col("_reason") == "").drop("_reason")
    bad = out.filter(F.col("_reason") != "").withColumnRenamed("_reason", "reject_reason")
    return good, bad


def insert_ignore(target: DataFrame | None, batch: DataFrame, table: str,
                  order: str | None = None, dedupe_keyless: bool = True) -> DataFrame:
    """M6: rows of ``batch`` to append to ``target`` (insert-if-absent).

    Keyed tables: one row per natural key — the first by ``order`` (poll
    order; ties and a missing order fall back to all columns) — and only keys
    absent from ``target``. Keyless tables (D16): a row identical in all
    business columns to one already present is skipped (``dedupe_keyless``).
    Rows with a NULL key component cannot be inserted and are dropped here;
    ``ingest`` quarantines them beforehand.
    """
    t = TABLES[table]
    keys = list(t.keys)
    keyless = not keys
    if keyless:
        if not dedupe_keyless:
            return batch
        keys = [c for c in t.names if c in batch.columns
                and c not in ("id", "ingested_at", "is_deleted", "deleted_at")]
    b = batch if keyless else batch.filter(_all([F.col(k).isNotNull() for k in keys]))
    # The rest of the row is the rank: each row travels once, its key not twice.
    rest = [c for c in ([order] if order and order not in keys else []) + [c for c in batch.columns if c != order] if c not in keys]
    first = b.groupBy(*keys)
    first = first.agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*batch.columns) if rest else b.select(*batch.columns).distinct()
    if target is None:
        return first
    # An anti join needs no distinct keys: the target is not de-duplicated.
    present = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    if keyless:  # NULL-safe equality on every business column
        return first.join(present, _all([F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]), "left_anti")
    present = present.filter(_all([F.col(f"_t_{k}").isNotNull() for k in keys]))
    return first.join(present, _all([F.col(k) == F.col(f"_t_{k}") for k in keys]), "left_anti")


def patch(df: DataFrame, patches: DataFrame, table: str, keys: list[str] | None = None,
          order: str | None = None, now: str | None = None) -> DataFrame:
    """M7/M9: apply partial updates given as JSON text (column ``patch``).

    Only allowed fields change; a field absent from a patch keeps its value,
    a field present with ``null`` becomes NULL, unless its column is NOT NULL,
    and a value that does not parse changes nothing. Several patches of one key
    apply in ``order`` (ties, or no order: by the patch text); patches of
    unknown or soft-deleted rows do nothing.
    ``updated_at`` (when the table has it) is set to ``now`` on patched rows.
    """
    t = TABLES[table]
    keys = keys or ["subsidiary_id", "id"]
    allowed = [f for f in PATCHABLE[table] if f in t.names]
    p = F.col("patch")
    present_keys = F.coalesce(F.json_object_keys(p), F.array().cast("array<string>"))
    text = F.from_json(p, T.StructType([T.StructField(f, T.StringType()) for f in allowed]))
    rank = F.struct(F.col(order).alias("o"), p.alias("p")) if order else p
    sel = [*[F.col(k) for k in keys], rank.alias("_o")]
    for f in allowed:
        value = _typed(text[f], t.column(f).dtype)
        usable = value.isNotNull() if t.column(f).not_null else text[f].isNull() | value.isNotNull()
        sel.append(F.struct((F.array_contains(present_keys, f) & usable).alias("p"),
                            value.alias("v")).alias(f"_{f}"))
    per_key = patches.select(*sel).groupBy(*keys).agg(
        *[F.max_by(F.col(f"_{f}.v"), F.when(F.col(f"_{f}.p"), F.col("_o"))).alias(f"_v_{f}")
          for f in allowed],
        *[F.max(F.col(f"_{f}.p").cast("int")).alias(f"_p_{f}") for f in allowed],
        F.lit(1).alias("_patched"))
    j = df.join(per_key, keys, "left")
    live = ~F.coalesce(F.col("is_deleted"), F.lit(False)) if "is_deleted" in df.columns else F.lit(True)
    hit = F.col("_patched").isNotNull() & live
    cols = []
    for c in df.columns:
        if c in allowed:
            cols.append(F.when(hit & (F.col(f"_p_{c}") == 1), F.col(f"_v_{c}"))
                         .otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        elif c == "updated_at" and now:
            cols.append(F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def create(target: DataFrame, rows: DataFrame, table: str, now: str
           ) -> tuple[DataFrame, DataFrame]:
    """M8: validated insert. Returns (rows to insert, rejected rows with reason).

    Rows are typed and defaulted like ``ingest``; a natural key already in
    ``target`` (or repeated in ``rows``) is a conflict and is rejected.
    """
    good, bad = ingest(rows, table, now)
    keys = list(TABLES[table].keys)
    if not keys:
        return good, bad
    dup = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    existing = target.select(*keys).distinct().withColumn("_exists", F.lit(True))
    g = (good.join(dup, keys, "left").join(existing, keys, "left")
             .withColumn("_reason", F.when(F.col("_exists"), F.lit("key exists"))
                                     .when(F.col("_n") > 1, F.lit("duplicate key in request"))))
    ok = g.filter(F.col("_reason").isNull()).drop("_n", "_exists", "_reason")
    conflict = (g.filter(F.col("_reason").isNotNull()).drop("_n", "_exists")
                 .withColumnRenamed("_reason", "reject_reason"))
    return ok, bad.unionByName(conflict)
