"""Reconciliation between layers (A11, A12, J5, U1-U3, S11, row_diff).

Counts are aggregates (partial + final); the per-pair rows are unioned, so
each table is scanned once however many pairs there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINE = 1 << 27  # buckets of keys whose rows are compared whole: 16 MB of bits at most


def row_count_audit(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Bronze vs silver row counts per table, with the difference.

    ``pairs``: table name -> (bronze frame, silver frame). Sorted by name.
    """
    parts = []
    for name, (b, s) in pairs.items():
        for side, df in (("bronze", b), ("silver", s)):
            parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"))
    counts = reduce(lambda x, y: x.unionByName(y), parts)
    out = counts.groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "bronze", F.col("n"))).alias("bronze_count"),
        F.sum(F.when(F.col("side") == "silver", F.col("n"))).alias("silver_count"))
    return (out.withColumn("diff", F.col("bronze_count") - F.col("silver_count"))
               .orderBy("table_name"))


def row_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present on one side only: ``side`` = 'missing_in_right' / 'missing_in_left'.

    Both sides are reduced to distinct keys first, so duplicates of a hot key
    do not reach the anti joins.
    """
    lk = left.select(*keys).distinct()
    rk = right.select(*keys).distinct()
    a = lk.join(rk, keys, "left_anti").withColumn("side", F.lit("missing_in_right"))
    b = rk.join(lk, keys, "left_anti").withColumn("side", F.lit("missing_in_left"))
    return a.unionByName(b)


def row_diff_values(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """Rows that differ, by content: keys, ``side`` ('missing_in_right', 'missing_in_left', 'changed') and ``columns``, the
    comma-joined names of the columns that differ in a changed row.

    Both sides are first reduced to one digest per bucket of keys (the sum of the left side's row hashes less the right side's, map-side combined),
    so equal buckets cost a few bytes. Of unequal buckets the rows' hashes are compared again by ``FINE`` buckets, two numbers a row; only rows of
    those that differ are compared whole, so the shuffle of whole rows grows with the differences. Rows that repeat a key are compared as the
    set of their contents: a key is equal when its rows hash to the same sum on both sides.
    """
    values = [c for c in left.columns if c not in keys]
    # xxhash64 passes over nulls, so which values are null is hashed too.
    row = F.xxhash64(*keys, *values, *[F.col(c).isNull() for c in keys + values])

    def hashed(df, is_left):
        h = df.select(*keys, *values).withColumns({"_h": row, "_k": F.xxhash64(*[F.col(k) for k in keys]), "_left": F.lit(is_left)})
        return h.withColumns({"_b": F.pmod("_k", F.lit(buckets)), "_f": F.pmod("_k", F.lit(FINE)) + 1, "_d": F.shiftright("_h", 16) * (1 if is_left else -1)})

    def unequal(rows, by):  # a sum that overflows tells nothing: its rows are compared
        return rows.groupBy(by).agg(F.try_sum("_d").alias("x")).filter(F.col("x").isNull() | (F.col("x") != 0)).select(by)

    both = hashed(left, True).unionByName(hashed(right, False))
    some = both.join(F.broadcast(unequal(both, "_b")), "_b", "left_semi")  # at most ``buckets`` numbers: the rows are not dealt out for them
    # The fine buckets that differ are bits, in at most FINE / 32768 maps of 4 kB.
    bits = unequal(some, "_f").groupBy(F.bitmap_bucket_number("_f").alias("_g")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_f")).alias("_bits"))
    at = F.bitmap_bit_position("_f")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    opened = (both.withColumn("_g", F.bitmap_bucket_number("_f")).join(F.broadcast(bits), "_g").filter(F.getbit(byte, (at % 8).cast("int")) == 1)
              .select(*keys, *values, "_h", "_left"))

    def one(side, where):  # of repeated keys the columns of one row stand for all; its hash travels once, not with every column
        names = ", ".join(f"`{c}`" for c in ["_h", *values])
        return [F.expr(f"count(1) FILTER (WHERE {where})").alias(f"{side}_n"), F.expr(f"max(struct({names})) FILTER (WHERE {where})").alias(side)]

    h = F.col("_h").cast("decimal(20,0)")
    j = opened.groupBy(*keys).agg(F.sum(F.when(F.col("_left"), h).otherwise(-h)).alias("_x"), *one("_l", "_left"), *one("_r", "NOT _left"))
    differ = F.concat_ws(",", *[F.when(~F.col("_l")[c].eqNullSafe(F.col("_r")[c]), F.lit(c)) for c in values])
    same = (F.col("_x") == 0) & (F.col("_l_n") == F.col("_r_n"))
    side = F.when(F.col("_r_n") == 0, "missing_in_right").when(F.col("_l_n") == 0, "missing_in_left").otherwise("changed")
    return j.filter(~same).select(*keys, side.alias("side"), F.when(side == "changed", differ).alias("columns"))


def gold_quality(marts: dict[str, DataFrame], year: int) -> DataFrame:
    """Rows per mart in ``year``; FAILED when a mart has none."""
    rows = [m.filter(F.col("fiscal_year") == year).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, m in marts.items()]
    out = reduce(lambda a, b: a.unionByName(b), rows)
    return out.withColumn("status", F.when(F.col("row_count") == 0, "FAILED").otherwise("OK"))


def table_metrics(df: DataFrame, date_col: str | None, name: str) -> DataFrame:
    """Row count and newest business date per subsidiary."""
    last = F.max(date_col).cast("date") if date_col else F.lit(None).cast("date")
    return (df.groupBy("subsidiary_id")
              .agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_date"))
              .select(F.lit(name).alias("table_name"), "subsidiary_id", "row_count", "last_date"))


def all_row_counts(frames: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """U3 for every department: ``frames`` maps a department to its tables."""
    return reduce(DataFrame.unionByName, [dept_row_counts(tables, dept) for dept, tables in frames.items()])


def dept_row_counts(frames: dict[str, DataFrame], dept: str) -> DataFrame:
    """Rows per captured table of a department, plus the department total."""
    rows = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dept).alias("dept"), F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()]
    out = reduce(lambda a, b: a.unionByName(b), rows)
    total = out.agg(F.sum("row_count").alias("row_count")).select(
        F.lit(dept).alias("dept"), F.lit("*total*").alias("table_name"), "row_count")
    return out.unionByName(total)
