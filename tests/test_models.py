from pyspark.sql import functions as F

from strata.operators import gold, monitor, quality, recon

AP = "subsidiary_id string, fiscal_year int, fiscal_month int, total_ap_gross double"
AR = "subsidiary_id string, fiscal_year int, fiscal_month int, total_ar_gross double"
VAT = "subsidiary_id string, fiscal_year int, fiscal_month int, total_taxable_sales double"


def test_financial_summary_full_join_paths(spark):
    ap = spark.createDataFrame([("A", 2024, 1, 1.0), ("A", 2024, 2, 2.0), ("A", 2024, None, 9.0)], AP)
    ar = spark.createDataFrame([("A", 2024, 1, 10.0), ("A", 2024, 3, 30.0)], AR)
    vat = spark.createDataFrame([("A", 2024, 1, 100.0), ("A", 2024, 4, 400.0), ("A", 2024, None, 7.0)], VAT)
    got = [tuple(r) for r in gold.financial_summary(ap, ar, vat).collect()]
    assert ("A", 2024, 1, 1.0, 10.0, 100.0) in got          # all three
    assert ("A", 2024, 2, 2.0, None, None) in got           # only AP
    assert ("A", 2024, 3, None, 30.0, None) in got          # only AR
    assert ("A", 2024, 4, None, None, 400.0) in got         # only VAT
    # NULL month never matches: the AP and VAT rows stay separate
    assert ("A", 2024, None, 9.0, None, None) in got and ("A", 2024, None, None, None, 7.0) in got
    assert len(got) == 6


def test_gold_quality_failed_when_empty(spark):
    m = spark.createDataFrame([("A", 2023)], "subsidiary_id string, fiscal_year int")
    got = {r.table_name: (r.row_count, r.status) for r in recon.gold_quality({"x": m, "y": m.filter("false")}, 2023).collect()}
    assert got == {"x": (1, "OK"), "y": (0, "FAILED")}


def _log(spark, ts_list):
    return spark.createDataFrame([(t,) for t in ts_list], "event_ts string").select(
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


def test_freshness_is_strict(spark):
    exactly_5 = _log(spark, ["2024-01-01 11:55:00"])
    assert monitor.cdc_freshness(exactly_5, "2024-01-01 12:00:00").first().status == "warning"
    inside = _log(spark, ["2024-01-01 11:55:01"])
    assert monitor.cdc_freshness(inside, "2024-01-01 12:00:00").first().status == "ok"


def test_status_row_on_empty_log(spark):
    r = monitor.cdc_status(_log(spark, []), "2024-01-01 12:00:00").collect()
    assert len(r) == 1 and r[0].total_events == 0 and r[0].last_event_ts is None


def test_row_count_audit_and_diff(spark):
    b = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    s = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    audit = recon.row_count_audit({"t": (b, s.limit(2))}).first()
    assert (audit.bronze_count, audit.silver_count, audit.diff) == (3, 2, 1)
    got = sorted((r.k, r.side) for r in recon.row_diff(b, s, ["k"]).collect())
    assert got == [(3, "missing_in_right"), (4, "missing_in_left")]


def test_report_rules_count_faults(spark):
    aging = spark.sql("""select * from values (1, 10.00, 2.50, 0.00, 1.00, 13.50), (2, 10.00, 2.50, 0.00, 1.00, 13.49),
        (3, 10.00, null, 0.00, 1.00, 11.00) t(vendor_id, `current`, aging_31_60, aging_61_90, aging_over_90, total_outstanding)""")
    got = {r["column_name"]: (r["failures"], r["status"]) for r in quality.check_arithmetic(aging, "ap_aging_detail", quality.report_rules()).collect()}
    assert got == {"R10_ap_total": (2, "fail")}  # a null bucket is a fault
    shares = spark.sql("""select * from values ('A', 60.00), ('A', 40.00), ('B', 99.99), ('C', cast(null as decimal(6,2))), (null, 100.00)
        t(subsidiary_id, ownership_pct)""")
    assert [(r["failures"], r["status"]) for r in quality.check_shares(shares, "s").collect()] == [(2, "fail")]
    assert [(r["failures"], r["status"]) for r in quality.check_shares(shares.limit(0), "s").collect()] == [(0, "pass")]
