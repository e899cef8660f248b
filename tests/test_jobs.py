import pytest
from pyspark.sql import functions as F

from strata.operators import silver
from strata.plans import jobs
from strata.schemas import FEEDS
from strata.sources import store
from strata.sources.lake import FixtureLake

from paths import SF_SMALL


def test_run_daily(spark, tmp_root):
    lake = FixtureLake(spark, SF_SMALL)
    ctx = jobs.RunContext(spark, lake, tmp_root, version=1, as_of="1998-12-31")
    gq = jobs.run_daily(ctx, year=1998, gate=False)
    assert {r.status for r in gq.collect()} == {"OK"}
    # sf0.001 holds one duplicated sales invoice number: the silver test records it
    fails = store.read_table(spark, tmp_root, "meta", "silver_tests").filter(F.col("status") == "fail").collect()
    assert [(r.model, r.check_name) for r in fails] == [("stg_sales_transactions", "unique")]
    pnl = store.read_table(spark, tmp_root, "gold", "group_pnl")
    assert pnl.count() == silver.fact_sales(lake).select("subsidiary_id", "fiscal_year", "fiscal_month").distinct().count()
    runlog = spark.read.parquet(f"{tmp_root}/meta/pipeline_run_log")
    assert runlog.filter(F.col("status") != "success").count() == 0
    assert runlog.filter(F.col("task_id") == "bronze_sales_transactions").first().rows_inserted == \
        lake.bronze("sales_transactions").count()


def test_refresh_gold_partitions_only_touched(spark, tmp_root):
    lake = FixtureLake(spark, SF_SMALL)
    fs = silver.fact_sales(lake)
    out = f"{tmp_root}/pnl"
    jobs.refresh_gold_partitions(fs, fs, out)
    before = {tuple(r) for r in spark.read.parquet(out).select("subsidiary_id", "fiscal_year", "fiscal_month").collect()}
    touched = fs.filter((F.col("fiscal_year") == 1998) & (F.col("fiscal_month") == 1))
    jobs.refresh_gold_partitions(fs, touched, out)
    after = {tuple(r) for r in spark.read.parquet(out).select("subsidiary_id", "fiscal_year", "fiscal_month").collect()}
    assert before == after


def test_run_weekly_and_incremental(spark, tmp_root):
    from strata.operators import cdc
    lake = FixtureLake(spark, SF_SMALL)
    ctx = jobs.RunContext(spark, lake, tmp_root, version=1, as_of="2024-01-31 00:00:00")
    jobs.run_daily(ctx, year=1998, gate=False)
    log = cdc.split_valid(cdc.parse_envelope(lake.cdc_messages()))[0]
    audit, events = jobs.run_weekly(ctx, log, f"{tmp_root}/export")
    a = {r.table_name: (r.bronze_count, r.silver_count, r.diff) for r in audit.collect()}
    assert a["bronze.sales_transactions"][2] == 0 and len(a) == 3
    assert events.count() > 0
    exported = spark.read.option("header", True).csv(f"{tmp_root}/export")
    assert exported.count() == log.filter("event_ts >= timestamp'2024-01-24 00:00:00'").count()
    ctx2 = jobs.RunContext(spark, lake, tmp_root, version=2, as_of="2024-01-31 00:00:00")
    runlog = jobs.run_incremental(ctx2, log)
    tasks = {r.task_id for r in runlog.collect()}
    assert {"snapshot", *[f"silver_{n}" for n in silver.SILVER]} <= tasks
    assert {"gold_group_pnl", "gold_gold_financial_summary", "gold_interco_elimination"} <= tasks
    assert store.read_table(spark, tmp_root, "gold", "group_pnl").count() > 0


def test_ingest_all_from_landing_files(spark, tmp_root):
    import json
    import os
    land = f"{tmp_root}/landing"
    os.makedirs(f"{land}/procurement_vendors")
    os.makedirs(f"{land}/sales_customers")
    with open(f"{land}/procurement_vendors/p1.json", "w") as f:
        json.dump([{"subsidiary_id": "ABC", "vendor_id": "V1", "vendor_name": "A"},
                   {"subsidiary_id": "ABC", "vendor_id": "V1", "vendor_name": "dup"},
                   {"subsidiary_id": None, "vendor_id": "V9"}], f)
    with open(f"{land}/sales_customers/p1.json", "w") as f:
        json.dump({"data": [{"subsidiary_id": "XYZ", "customer_id": "C1", "tin": "123"}]}, f)
    feeds = {k: FEEDS[k] for k in ("procurement_vendors", "sales_customers")}
    out = jobs.ingest_all(spark, land, tmp_root, "2024-02-01 00:00:00", 1, feeds=feeds)
    got = {r.task_id: (r.rows_fetched, r.rows_inserted, r.rows_rejected) for r in out.collect()}
    assert got == {"procurement_vendors": (3, 1, 1), "sales_customers": (1, 1, 0)}
    c = store.read_table(spark, tmp_root, "bronze", "customers").first()
    assert c.customer_tin == "123" and c.is_active is True and c.source_dept == "sales"
    # a second poll of the same files inserts nothing new
    out2 = jobs.ingest_all(spark, land, tmp_root, "2024-02-02 00:00:00", 2, feeds=feeds)
    assert {r.task_id: r.rows_inserted for r in out2.collect()} == {"procurement_vendors": 0, "sales_customers": 0}
    assert store.read_table(spark, tmp_root, "bronze", "vendors").count() == 1
    # a re-run of a poll replaces its rejects; a feed without files is reported
    feeds["finance_journal_entries"] = ("finance", "journal_entries", 7)
    out3 = jobs.ingest_all(spark, land, tmp_root, "2024-02-02 00:00:00", 2, feeds=feeds)
    assert {r.task_id: r.status for r in out3.collect()}["finance_journal_entries"] == "no files"
    assert spark.read.parquet(f"{tmp_root}/quarantine/vendors/v=2").count() == 1


def test_failing_task_is_in_the_run_log(spark, tmp_root):
    ctx = jobs.RunContext(spark, None, tmp_root, version=1, as_of="1998-12-31")

    def broken():
        raise ValueError("no such source")
    with pytest.raises(ValueError), jobs.recorded(ctx):
        jobs.log_run(ctx, "good", lambda: spark.range(3), lambda d: d.write.parquet(f"{tmp_root}/good"))
        jobs.log_run(ctx, "bad", broken, lambda d: d.write.parquet(f"{tmp_root}/bad"))
    rows = {r.task_id: (r.status, r.rows_inserted, r.error_message)
            for r in spark.read.parquet(f"{tmp_root}/meta/pipeline_run_log").collect()}
    assert rows == {"good": ("success", 3, None), "bad": ("failed", 0, "no such source")}


def test_refresh_drops_emptied_partition(spark, tmp_root):
    cols = "subsidiary_id string, fiscal_year int, fiscal_month int, gross_amount double, net_amount double, vat_amount double"
    old = spark.createDataFrame([("A B", 2024, 1, 1.0, 1.0, 0.0), ("A B", 2024, 2, 2.0, 2.0, 0.0)], cols)
    out = f"{tmp_root}/pnl_empty"
    jobs.refresh_gold_partitions(old, old, out)
    moved = spark.createDataFrame([("A B", 2024, 3, 1.0, 1.0, 0.0), ("A B", 2024, 2, 2.0, 2.0, 0.0)], cols)
    touched = spark.createDataFrame([("A B", 2024, 1), ("A B", 2024, 3)], "subsidiary_id string, fiscal_year int, fiscal_month int")
    jobs.refresh_gold_partitions(moved, touched, out)
    got = {(r.fiscal_month, r.revenue_net) for r in spark.read.parquet(out).collect()}
    assert got == {(2, 2.0), (3, 1.0)}


def test_stream_gold_refreshes_touched_partitions(spark, tmp_root):
    lake = FixtureLake(spark, SF_SMALL)
    fs = silver.fact_sales(lake)
    out = f"{tmp_root}/pnl_stream"
    jobs.refresh_gold_partitions(fs, fs, out)
    on_batch = jobs.stream_gold(lambda: fs, out)
    changes = lake.bronze("sales_transactions").select(
        "subsidiary_id", F.col("transaction_date").alias("invoice_date")).limit(5)
    on_batch(changes, 0)
    got = spark.read.parquet(out)
    assert got.count() == fs.select("subsidiary_id", "fiscal_year", "fiscal_month").distinct().count()
