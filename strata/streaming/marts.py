"""Bucketed state and marts kept up to date from change deltas.

``BucketedState`` stores a captured table's state by a hash bucket of its key: ``<base>/v=<batch>/bucket=<b>``. A batch reads and
writes only the buckets its keys fall into; all others keep their files. The state of a bucket is that of its newest committed
version, and batch ``b`` is computed from versions before ``b``, so a replayed batch rewrites the same files. A large batch is merged
a few buckets at a time; ``expire`` drops the files that newer versions replace.

``DeltaMarts`` turns each batch into signed rows: every touched record leaves with its sums before the batch (-1) and enters with those
after it (+1). Grouped by the mart's keys these are a few rows, written to ``<root>/<mart>/_batch=<b>`` (overwritten on replay). A mart is the
sum of its deltas: neither facts nor mart partitions are read again, a moved date changes both months, and a group whose last
row left disappears. Sums and counts can be taken back, so these marts are exact; minima and maxima cannot, and are not kept this
way. ``compact`` folds the deltas so far into one base.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import fiscal_month, fiscal_year
from strata.operators import cdc
from strata.sources import store

KEY = ["subsidiary_id", "id"]
LOG_COLUMNS = ["subsidiary_id", "operation", *cdc.LOG_KEYS, "event_ts", "before_state", "after_state"]  # what a merge reads
BYTES_PER_MERGE = 128_000_000  # of stored changes and state; merging shuffles several times that


class BucketedState:
    def __init__(self, base: str, table: str, buckets: int = 64):
        self.base, self.table, self.buckets = base.rstrip("/"), table, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in KEY]), F.lit(self.buckets)).cast("int")

    def versions(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Bucket -> its newest committed version (below ``before``)."""
        out: dict[int, int] = {}
        for v in store.committed_versions(spark, self.base):
            if before is None or v < before:
                out |= {b: v for b in store.numbered_folders(spark, f"{self.base}/v={v}", "bucket=")}
        return out

    def read(self, spark: SparkSession, before: int | None = None, only: set[int] | None = None) -> DataFrame | None:
        """The state; with ``only``, of these buckets. No file of another bucket is opened."""
        paths = [f"{self.base}/v={v}/bucket={b}" for b, v in sorted(self.versions(spark, before).items()) if only is None or b in only]
        return spark.read.schema(cdc.empty_state(spark, self.table).schema).parquet(*paths) if paths else None

    def expire(self, spark: SparkSession, before: int) -> None:
        """Drop files no batch from ``before`` on reads: a bucket's, of versions older than its newest committed one below ``before``. The
        stream repeats none but its last batch, so call it with the number of the batch that runs."""
        newest = self.versions(spark, before)
        for v in store.committed_versions(spark, self.base):
            if v < before:
                for b in store.numbered_folders(spark, f"{self.base}/v={v}", "bucket="):
                    if newest[b] > v:
                        store.remove(spark, f"{self.base}/v={v}/bucket={b}")

    def apply(self, changes: DataFrame, batch: int, size: int = 0) -> DataFrame | None:
        """Merge log rows as version ``batch``. Returns the touched records before and after it: the state's columns
        and ``sign`` (-1, +1); None where the batch has no change of this table. ``size`` is that of the stored changes in bytes: with
        the state's they say how many buckets are merged at a time, so that what a merge shuffles does not grow with the table."""
        spark = changes.sparkSession
        mine = changes.filter(F.col("source_table") == self.table)
        mine = mine if "id" in mine.columns else mine.withColumn("id", cdc.image_id())
        keys = mine.select(*KEY).filter("id is not null").distinct()
        touched = sorted(r[0] for r in mine.filter("id is not null").select(self.bucket()).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            return None
        versions = self.versions(spark, batch)
        size += sum(store.size_of(spark, f"{self.base}/v={versions[b]}/bucket={b}") for b in touched if b in versions)
        at_a_time = max(1, len(touched) * BYTES_PER_MERGE // max(1, size))

        def merged():
            for i in range(0, len(touched), at_a_time):
                some = touched[i:i + at_a_time]
                part = mine if at_a_time >= len(touched) else mine.filter(self.bucket().isin(some))
                after = cdc.merge_changes(self.read(spark, batch, set(some)), part, self.table)
                # Rebalanced, a bucket is one file while it is small and several when it outgrows a task.
                yield after.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        path = store.write_parts(merged(), self.base, batch, ["bucket"])
        after = spark.read.schema(cdc.empty_state(spark, self.table).schema).parquet(*[f"{path}/bucket={b}" for b in touched
                                                                                      if store.exists(spark, f"{path}/bucket={b}")])
        before = self.read(spark, batch, set(touched))
        signed = [after.join(keys, KEY, "left_semi").withColumn("sign", F.lit(1))]
        if before is not None:
            signed.append(before.join(keys, KEY, "left_semi").withColumn("sign", F.lit(-1)))
        return reduce(DataFrame.unionByName, signed)


@dataclass(frozen=True)
class Mart:
    """Sums of ``measures`` (output -> column of the table) by ``keys`` (output -> expression)."""
    table: str
    keys: dict[str, Column]
    measures: dict[str, str]


def _monthly(date: str) -> dict[str, Column]:
    return {"subsidiary_id": F.col("subsidiary_id"), "fiscal_year": fiscal_year(date), "fiscal_month": fiscal_month(date)}


def marts() -> dict[str, Mart]:
    """The additive gold marts, by name."""
    return {
        "group_pnl": Mart("sales_transactions", _monthly("transaction_date"), {
            "revenue_gross": "gross_amount", "revenue_net": "net_amount", "output_vat": "vat_amount"}),
        "exec_kpi": Mart("sales_transactions", _monthly("transaction_date"), {"revenue_net": "net_amount"}),
        "ap_monthly": Mart("ap_invoices", _monthly("invoice_date"), {
            "total_ap_gross": "gross_amount", "total_ap_vat": "vat_amount", "total_ap_net": "net_amount", "total_ap_paid": "payment_amount"}),
        "ar_monthly": Mart("ar_ledger", _monthly("invoice_date"), {
            "total_ar_gross": "gross_amount", "total_ar_vat": "vat_amount", "total_ar_net": "net_amount", "total_ar_collected": "collected_amount"}),
        "vat_monthly": Mart("vat_returns", {"subsidiary_id": F.col("subsidiary_id"), "fiscal_year": F.col("period_year"),
                                            "fiscal_month": F.col("period_month")}, {
            "total_taxable_sales": "taxable_sales", "total_output_vat": "output_vat", "total_input_vat": "input_vat",
            "total_vat_payable": "vat_payable"}),
        "gold_inventory_summary": Mart("inventory_movements", {
            "subsidiary_id": F.col("subsidiary_id"), "movement_type": F.col("movement_type"), "fiscal_year": fiscal_year("movement_date"),
            "fiscal_month": fiscal_month("movement_date")}, {"total_quantity": "quantity", "total_cost": "total_cost"}),
    }


def deltas(signed: DataFrame, mart: Mart) -> DataFrame:
    """Per group: rows, and per measure its sum and how many values are not null, all signed; groups that did not change go."""
    live = signed.filter(~F.coalesce(F.col("is_deleted"), F.lit(False)))
    s = F.col("sign")
    aggs = [F.sum(s).cast("long").alias("_rows")]
    for out, col in mart.measures.items():
        aggs += [F.coalesce(F.sum(F.col(col) * s), F.lit(0)).alias(out), F.coalesce(F.sum(F.when(F.col(col).isNotNull(), s)), F.lit(0)).cast("long").alias(f"_n_{out}")]
    rows = live.groupBy(*[e.alias(k) for k, e in mart.keys.items()]).agg(*aggs)
    changed = [F.col(c) != 0 for c in rows.columns if c not in mart.keys]
    return rows.filter(reduce(lambda a, b: a | b, changed))


def total(parts: DataFrame, mart: Mart) -> DataFrame:
    """Delta rows added up, in the same shape."""
    values = [c for c in parts.columns if c not in mart.keys and c != "_batch"]
    return parts.groupBy(*mart.keys).agg(*[F.sum(c).alias(c) for c in values])


def published(summed: DataFrame, mart: Mart) -> DataFrame:
    """The mart as a batch run gives it: groups with rows; the sum of no values is null."""
    return summed.filter("_rows > 0").select(*mart.keys, *[F.when(F.col(f"_n_{m}") > 0, F.col(m)).alias(m) for m in mart.measures])


class DeltaMarts:
    """A ``foreachBatch`` sink over parsed log rows that keeps states and marts under ``root``."""

    def __init__(self, root: str, names: list[str], buckets: int = 64):
        self.root = root.rstrip("/")
        self.marts = {n: marts()[n] for n in names}
        self.states = {t: BucketedState(f"{self.root}/state/{t}", t, buckets) for t in sorted({m.table for m in self.marts.values()})}

    def __call__(self, log: DataFrame, batch: int) -> None:
        spark = log.sparkSession
        # Stored, not cached: parsed once, and each table, its keys and its images read the columns and rows they need.
        path = f"{self.root}/log/_batch={batch}"
        rows = log.filter(F.col("source_table").isin(list(self.states))).select("source_table", *LOG_COLUMNS, cdc.image_id().alias("id"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("source_table").parquet(path)
        log = spark.read.schema(rows.schema).parquet(path)
        for table, state in self.states.items():
            part = f"{path}/source_table={table}"
            if not store.exists(spark, part):
                continue
            state.expire(spark, batch)
            signed = state.apply(log, batch, store.size_of(spark, part))
            if signed is None:
                continue
            for name, mart in self.marts.items():
                if mart.table == table:
                    deltas(signed, mart).write.mode("overwrite").parquet(f"{self.root}/mart/{name}/_batch={batch}")
        store.remove(spark, path)

    def _parts(self, spark: SparkSession, name: str) -> tuple[int, list[DataFrame]]:
        base = f"{self.root}/base/{name}"
        done = store.committed_versions(spark, base)
        last = done[-1] if done else -1
        out = [store.read_version(spark, base, last)] if done else []
        path = f"{self.root}/mart/{name}"
        out += [spark.read.parquet(f"{path}/_batch={b}") for b in store.numbered_folders(spark, path, "_batch=")
                if b > last and store.exists(spark, f"{path}/_batch={b}/_SUCCESS")]
        return last, out

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        _, parts = self._parts(spark, name)
        return published(total(reduce(DataFrame.unionByName, parts), self.marts[name]), self.marts[name])

    def compact(self, spark: SparkSession, name: str, upto: int) -> None:
        """Fold the deltas of batches up to ``upto`` into one base; call it between batches."""
        last, parts = self._parts(spark, name)
        if parts and upto > last:
            store.write_version(total(reduce(DataFrame.unionByName, parts), self.marts[name]), f"{self.root}/base/{name}", upto)
