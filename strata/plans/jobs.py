"""Job order, run log and incremental gold refresh.

Plain Python calling DataFrame jobs in order; independent jobs of one stage
run from a small driver thread pool (Spark schedules them concurrently on
the same session). Each task's row count comes from ``Observation`` on the
written DataFrame — counted by the executors while writing, no second pass.
The run log is written when a run ends, also when one of its tasks fails.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import changes, gold, history, quality, recon, reports, silver
from strata.operators.staging import stage
from strata.schemas import BRONZE_DOMAIN, FEED_FALLBACKS, FEED_RENAMES, FEEDS
from strata.sources import store
from strata.sources.landing import export_audit_csv, form_codes, read_landing
from strata.sources.lake import Lake, ParquetLake

RUN_LOG = ("run_id string, dag_id string, task_id string, rows_fetched bigint, rows_inserted bigint, "
           "rows_rejected bigint, status string, error_message string, duration_seconds double")


class QualityGateError(RuntimeError):
    pass


@dataclass
class RunContext:
    spark: SparkSession
    lake: Lake
    root: str
    version: int
    as_of: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    log: list = field(default_factory=list)


def log_run(ctx: RunContext, task_id: str, build: Callable[[], DataFrame], write: Callable[[DataFrame], None],
            dag_id: str = "daily") -> None:
    """Q11: build and write one model; record rows, status, error and duration, whether it succeeds or fails."""
    obs = Observation(f"rows_{task_id}_{uuid.uuid4().hex[:8]}")
    started = time.time()
    status, err, rows = "failed", None, None
    try:
        write(build().observe(obs, F.count(F.lit(1)).alias("rows")))
        rows = obs.get.get("rows")
        status = "success"
    except Exception as e:  # noqa: BLE001 - recorded, then re-raised
        err = str(e)
        raise
    finally:
        history.release_pinned()
        ctx.log.append((ctx.run_id, dag_id, task_id, rows, rows or 0, 0, status, err,
                        round(time.time() - started, 2)))


def _parallel(tasks: list[Callable[[], None]], workers: int = 4) -> None:
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def write_run_log(ctx: RunContext, first: int = 0) -> DataFrame:
    """Append the run-log rows from number ``first`` on; returns them."""
    df = ctx.spark.createDataFrame(ctx.log[first:], RUN_LOG)
    df.write.mode("append").parquet(store.table_path(ctx.root, "meta", "pipeline_run_log"))
    return df


@contextmanager
def recorded(ctx: RunContext):
    """Write the run log of the tasks run inside, also when one of them fails."""
    first = len(ctx.log)
    try:
        yield
    finally:
        write_run_log(ctx, first)


def _checked(ctx: RunContext, name: str, checks: Callable[[], DataFrame], gate: bool, bad: str) -> None:
    """Store check results under ``meta/<name>``; with ``gate``, rows matching ``bad`` stop the run."""
    log_run(ctx, name, checks, lambda d: store.write_model(d, ctx.root, "meta", name, ctx.version))
    if gate and store.read_table(ctx.spark, ctx.root, "meta", name).filter(bad).count():
        raise QualityGateError(f"{name} failed")


def _silver(ctx: RunContext, lake: Lake, dag_id: str = "daily") -> None:
    def task(name, fn):
        return lambda: log_run(ctx, f"silver_{name}", lambda: fn(lake),
                               lambda d: store.write_model(d, ctx.root, "silver", name, ctx.version), dag_id)
    _parallel([task(n, f) for n, f in silver.SILVER.items()])


def _gold(ctx: RunContext, lake: Lake, dag_id: str = "daily") -> None:
    """Every mart, from the written silver models."""
    def sv(name):
        return store.read_table(ctx.spark, ctx.root, "silver", name)
    marts = {
        "group_pnl": lambda: gold.group_pnl(sv("fact_sales")),
        "group_pnl_consolidated": lambda: gold.group_pnl_consolidated(sv("fact_sales")),
        "exec_kpi": lambda: gold.exec_kpi(sv("fact_sales")),
        "gold_financial_summary": lambda: gold.financial_summary(
            gold.ap_monthly(sv("fact_ap_invoices")), gold.ar_monthly(sv("fact_ar_ledger")),
            gold.vat_monthly(sv("fact_tax_vat_returns"))),
        "gold_hr_headcount": lambda: gold.hr_headcount(sv("dim_employees")),
        "gold_inventory_summary": lambda: gold.inventory_summary(sv("fact_inventory_movements")),
        "bir_compliance_scorecard": lambda: reports.bir_compliance_scorecard(
            lake.bronze("bir_filings_log"), form_codes(ctx.spark)),
        "interco_elimination": lambda: reports.interco_elimination(sv("fact_sales"), sv("fact_ap_invoices")),
    }

    def task(name, build):
        return lambda: log_run(ctx, f"gold_{name}", build,
                               lambda d: store.write_model(d, ctx.root, "gold", name, ctx.version), dag_id)
    _parallel([task(n, b) for n, b in marts.items()])


def run_daily(ctx: RunContext, year: int, gate: bool = True, landing_root: str | None = None) -> DataFrame:
    """Q8: health -> ingest (of ``landing_root``) or bronze -> silver, from the written bronze -> silver
    tests -> gold -> gold tests -> gold quality. With ``gate``, failing tests or marts stop the run."""
    spark, lake, root, v = ctx.spark, ctx.lake, ctx.root, ctx.version
    with recorded(ctx):
        if landing_root is not None:
            ingested = ingest_all(spark, landing_root, root, ctx.as_of, v)
            ctx.log += [(ctx.run_id, "daily", f"ingest_{r.task_id}", r.rows_fetched, r.rows_inserted,
                         r.rows_rejected, r.status, None, None) for r in ingested.collect()]  # a row per feed
        else:
            for t in BRONZE_DOMAIN:                       # health: every source resolves
                lake.raw(t).schema  # noqa: B018

            def bronze_task(t):
                return lambda: log_run(ctx, f"bronze_{t}", lambda: lake.raw(t),
                                       lambda d: store.write_model(d, root, "bronze", t, v, ["subsidiary_id"]))
            _parallel([bronze_task(t) for t in BRONZE_DOMAIN])
        written = ParquetLake(spark, root)
        _silver(ctx, written)
        _checked(ctx, "silver_tests", lambda: quality.run_checks(
            [quality.assert_not_null(stage(written, m), m, c) for m, c in quality.NOT_NULL_TESTS.items()]
            + [quality.assert_unique(stage(written, m), m, k) for m, k in quality.UNIQUE_TESTS.items()]),
            gate, "status = 'fail'")
        _gold(ctx, written)

        def mart(name):
            return store.read_table(spark, root, "gold", name)
        _checked(ctx, "gold_tests", lambda: quality.run_checks(
            [quality.assert_not_null(mart(m), m, [*gold.KEYS, "revenue_net"]) for m in ("group_pnl", "exec_kpi")]
            + [quality.assert_unique(mart(m), m, gold.KEYS) for m in ("group_pnl", "exec_kpi")]),
            gate, "status = 'fail'")
        _checked(ctx, "gold_quality", lambda: recon.gold_quality(
            {f"gold.{n}": mart(n) for n in ("exec_kpi", "group_pnl", "bir_compliance_scorecard")}, year),
            gate, "status <> 'OK'")
    return store.read_table(spark, root, "meta", "gold_quality")


def run_weekly(ctx: RunContext, log: DataFrame, export_path: str) -> tuple[DataFrame, DataFrame]:
    """Q10: (row-count audit || CDC event audit) -> CSV export of the last 7 days."""
    spark, root = ctx.spark, ctx.root
    pairs = {f"bronze.{b}": (store.read_table(spark, root, "bronze", b),
                             store.read_table(spark, root, "silver", s))
             for b, s in (("journal_entries", "fact_finance_journal_entries"),
                          ("sales_transactions", "fact_sales"), ("employees", "dim_employees"))}
    from strata.operators.monitor import cdc_event_audit
    audit = recon.row_count_audit(pairs)
    events = cdc_event_audit(log, ctx.as_of[:10])
    export_audit_csv(log, ctx.as_of, export_path)
    return audit, events


def refresh_gold_partitions(fact_sales: DataFrame, changed: DataFrame, out: str) -> DataFrame:
    """Recompute group P&L only for the (subsidiary, year, month) keys touched
    by ``changed`` and overwrite just those partitions (dynamic overwrite). A
    touched key that has no sales left loses its partition.

    ``changed`` holds the keys of rows before and after their change, so a moved
    date refreshes both months. Touched keys are months x subsidiaries and join
    as a semi join; the facts are scanned, untouched partitions not rewritten.
    """
    keys = gold.KEYS
    touched = changed.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    recomputed = gold.group_pnl(fact_sales.join(touched, same, "left_semi"))
    (recomputed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*keys).parquet(out))
    left = fact_sales.select(*keys).join(touched, same, "left_semi").distinct()
    emptied = touched.join(left, same, "left_anti").collect()  # at most months x subsidiaries
    store.drop_partitions(fact_sales.sparkSession, out, keys, [tuple(r) for r in emptied])
    return recomputed


def stream_gold(fact_sales_loader: Callable[[], DataFrame], out: str, date_col: str = "invoice_date",
                before_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that refreshes group P&L for the
    (subsidiary, year, month) partitions touched by each micro-batch of sales
    changes; ``fact_sales_loader`` returns the current silver facts and
    ``before_col`` names the date a changed row had before, if the batch has it."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        def keys(col):
            return batch.select("subsidiary_id", F.year(col).alias("fiscal_year"), F.month(col).alias("fiscal_month"))
        changed = keys(date_col)
        if before_col:
            changed = changed.unionByName(keys(before_col).filter("fiscal_year is not null"))
        refresh_gold_partitions(fact_sales_loader(), changed, out)
    return on_batch


def run_incremental(ctx: RunContext, log: DataFrame) -> DataFrame:
    """Q9: snapshot (SCD2 from the change log) -> every silver model -> every mart, from the stored bronze,
    written as version ``v``. Returns this run's log rows."""
    first = len(ctx.log)
    with recorded(ctx):
        log_run(ctx, "snapshot", lambda: history.scd2(log),
                lambda d: store.write_model(d, ctx.root, "silver", "snapshots", ctx.version), "incremental")
        stored = ParquetLake(ctx.spark, ctx.root)
        _silver(ctx, stored, "incremental")
        _gold(ctx, stored, "incremental")
    return ctx.spark.createDataFrame(ctx.log[first:], RUN_LOG)


__all__ = ["RunContext", "run_daily", "run_weekly", "run_incremental", "refresh_gold_partitions",
           "log_run", "QualityGateError", "ingest_all", "stream_gold"]


def ingest_all(spark: SparkSession, landing_root: str, root: str, ingested_at: str, version: int,
               feeds: dict | None = None, workers: int = 4) -> DataFrame:
    """Poll every registered feed from ``<landing_root>/<task_id>/`` and
    insert-ignore it into bronze version ``version`` (previous version + new
    rows); rejected rows go to ``quarantine/<table>/feed=<task_id>`` of that
    version, so a re-run replaces them. Feeds sharing a table (purchase orders
    from ops and procurement) are applied one after another. Returns one
    run-log row per feed (fetched / inserted / rejected); a feed that landed
    nothing has the status ``no files``.
    """
    feeds = FEEDS if feeds is None else feeds
    by_table: dict[str, list[str]] = {}
    for task, (_group, table, _lookback) in feeds.items():
        by_table.setdefault(table, []).append(task)
    log_rows = []

    def one_table(table: str, tasks: list[str]) -> None:
        base = store.table_path(root, "bronze", table)
        current = store.read_latest(spark, base, before=version)
        added = None
        for task in tasks:
            path = f"{landing_root.rstrip('/')}/{task}"
            if not store.exists(spark, path):
                log_rows.append((task, table, 0, 0, 0, "no files"))
                continue
            extra = list(FEED_RENAMES.get(table, {})) + list(FEED_FALLBACKS.get(table, {}).values())
            recs = read_landing(spark, path, table, extra_fields=extra)
            good, bad = changes.ingest(recs, table, ingested_at, feed=table)
            obs = Observation(f"rejected_{task}_{uuid.uuid4().hex[:8]}")
            bad.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
                f"{store.table_path(root, 'quarantine', table)}/v={version}/feed={task}")
            target = current if added is None else (added if current is None else current.unionByName(added))
            new = changes.insert_ignore(target, good, table)
            added = new if added is None else added.unionByName(new)
            log_rows.append((task, table, recs.count(), new.count(), obs.get["rows"], "success"))
        if added is not None:
            full = added if current is None else current.unionByName(added)
            store.write_version(full, base, version)

    _parallel([lambda t=t, ts=ts: one_table(t, ts) for t, ts in by_table.items()], workers)
    return spark.createDataFrame(log_rows, "task_id string, table_name string, rows_fetched bigint, "
                                           "rows_inserted bigint, rows_rejected bigint, status string")
