import json

from pyspark.sql import functions as F

from strata.operators import changes, filters
from strata.sources.landing import read_landing


def test_insert_ignore(spark):
    target = spark.createDataFrame([("ABC", "C1", "old")], "subsidiary_id string, customer_id string, customer_name string")
    batch = spark.createDataFrame(
        [("ABC", "C1", "new", 1), ("ABC", "C2", "first", 1), ("ABC", "C2", "second", 2),
         ("ABC", None, "nullkey", 3), ("XYZ", "C1", "other tenant", 4)],
        "subsidiary_id string, customer_id string, customer_name string, seq int")
    got = sorted((r.subsidiary_id, r.customer_id, r.customer_name)
                 for r in changes.insert_ignore(target, batch, "customers", order="seq").collect())
    assert got == [("ABC", "C2", "first"), ("XYZ", "C1", "other tenant")]


def test_insert_ignore_keyless_dedupes_identical_rows(spark):
    batch = spark.createDataFrame([("ABC", "U1", "READ"), ("ABC", "U1", "READ"), ("ABC", "U2", "READ")],
                                  "subsidiary_id string, user_id string, action string")
    assert changes.insert_ignore(None, batch, "audit_log").count() == 2
    assert changes.insert_ignore(None, batch, "audit_log", dedupe_keyless=False).count() == 3


def test_ingest_defaults_fallbacks_quarantine(spark):
    recs = spark.createDataFrame(
        [("ABC", "INV1", None, "2024-01-05", "100.50", None),      # fallback date, NULL flag -> false
         ("ABC", "INV2", "2024-01-06", None, "abc", "true"),       # bad amount -> quarantine
         (None, "INV3", "2024-01-07", None, "1", None)],           # NOT NULL without default
        "subsidiary_id string, invoice_number string, transaction_date string, invoice_date string, "
        "gross_amount string, is_interco string")
    good, bad = changes.ingest(recs, "sales_transactions", "2024-02-01 00:00:00")
    g = good.collect()
    assert len(g) == 1 and str(g[0].transaction_date) == "2024-01-05" and g[0].is_interco is False
    assert float(g[0].gross_amount) == 100.5 and float(g[0].discount_amount) == 0.0
    assert g[0].source_dept == "sales"
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert reasons == ["bad value in gross_amount", "subsidiary_id is null"]


def test_ingest_missing_date_quarantined(spark):
    recs = spark.createDataFrame([("ABC", "receipt", None)], "subsidiary_id string, movement_type string, movement_date string")
    good, bad = changes.ingest(recs, "inventory_movements", "2024-02-01 00:00:00")
    assert good.count() == 0 and bad.first().reject_reason == "movement_date is null"


def test_ingest_null_key_and_bare_numbers(spark):
    recs = spark.createDataFrame([("ABC", "C1"), ("ABC", None)], "subsidiary_id string, customer_id string")
    good, bad = changes.ingest(recs, "customers", "2024-02-01 00:00:00")
    assert good.count() == 1 and [r.reject_reason for r in bad.collect()] == ["customer_id is null"]
    recs = spark.createDataFrame([("ABC", "I1", "20240131"), ("ABC", "I2", "99999999999"), ("ABC", "I3", "19723")],
                                 "subsidiary_id string, invoice_number string, transaction_date string")
    good, bad = changes.ingest(recs, "sales_transactions", "2024-02-01 00:00:00")
    assert [str(r.transaction_date) for r in good.collect()] == ["2024-01-31"]
    assert {r.reject_reason.split(";")[0] for r in bad.collect()} == {"bad value in transaction_date"}


def test_ingest_types_each_value_once(spark):
    """the check of a row is not written into the join below it, nor is a value parsed again for each problem it may have."""
    a = spark.createDataFrame([(1, "ABC", "I1", "2024-01-05")], "k int, subsidiary_id string, invoice_number string, transaction_date string")
    b = spark.createDataFrame([(1, "5.00")], "k int, gross_amount string")
    for part in changes.ingest(a.join(b, "k"), "sales_transactions", "2024-02-01 00:00:00"):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") == 1, plan
        assert not any("bad value" in line for line in plan.split("\n") if "Join" in line), plan


def test_patch_keeps_value_that_does_not_parse(spark):
    df = spark.createDataFrame([("ABC", 1, "10.00", "x")], "subsidiary_id string, id int, s string, position string").select(
        "subsidiary_id", "id", F.col("s").cast("decimal(18,2)").alias("basic_salary"), "position")
    patches = spark.createDataFrame([("ABC", 1, json.dumps({"basic_salary": "abc", "position": "y"})),
                                     ("ABC", 1, json.dumps({"position": "z"}))], "subsidiary_id string, id int, patch string")
    got = changes.patch(df, patches, "employees").first()
    assert (float(got.basic_salary), got.position) == (10.0, "z")


def test_patch(spark):
    df = spark.createDataFrame(
        [("ABC", 1, "unpaid", None, False), ("ABC", 2, "unpaid", None, True), ("ABC", 3, "unpaid", 5.0, False)],
        "subsidiary_id string, id int, status string, payment_amount double, is_deleted boolean").withColumn(
        "payment_amount", F.col("payment_amount").cast("decimal(18,2)"))
    patches = spark.createDataFrame(
        [("ABC", 1, json.dumps({"status": "paid", "gross_amount": 0})),     # field outside allowed list
         ("ABC", 2, json.dumps({"status": "paid"})),                         # deleted row
         ("ABC", 3, json.dumps({"payment_amount": None})),                   # explicit null
         ("ABC", 9, json.dumps({"status": "paid"}))],                        # unknown id
        "subsidiary_id string, id int, patch string")
    got = {r.id: (r.status, r.payment_amount) for r in changes.patch(df, patches, "ap_invoices").collect()}
    assert got == {1: ("paid", None), 2: ("unpaid", None), 3: ("unpaid", None)}


def test_create_rejects_existing_and_duplicate_keys(spark):
    target = spark.createDataFrame([("ABC", "V1")], "subsidiary_id string, vendor_id string")
    rows = spark.createDataFrame([("ABC", "V1", "x"), ("ABC", "V2", "y"), ("ABC", "V3", "a"), ("ABC", "V3", "b")],
                                 "subsidiary_id string, vendor_id string, vendor_name string")
    ok, bad = changes.create(target, rows, "vendors", "2024-02-01 00:00:00")
    assert [r.vendor_id for r in ok.collect()] == ["V2"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["duplicate key in request", "duplicate key in request",
                                                              "key exists"]


def test_read_landing_shapes(spark, tmp_root):
    import os
    os.makedirs(f"{tmp_root}/in")
    with open(f"{tmp_root}/in/a.json", "w") as f:
        json.dump([{"subsidiary_id": "ABC", "vendor_id": "V1"}], f)
    with open(f"{tmp_root}/in/b.json", "w") as f:
        json.dump({"data": [{"subsidiary_id": "ABC", "vendor_id": "V2"}]}, f)
    with open(f"{tmp_root}/in/c.json", "w") as f:
        json.dump({"message": "nothing"}, f)
    got = sorted(r.vendor_id for r in read_landing(spark, f"{tmp_root}/in", "vendors").collect())
    assert got == ["V1", "V2"]


def test_soft_delete_filter(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_deleted boolean")
    assert sorted(r.id for r in filters.live(df).collect()) == [2, 3]


def test_lookback_validation():
    import pytest
    with pytest.raises(ValueError):
        filters.validate_lookback(days=0)
    with pytest.raises(ValueError):
        filters.validate_lookback(month=13)
    filters.validate_lookback(days=7, months=3, month=0, year=2024)
    assert filters.dept_allowed("purchase_orders", "ops") and filters.dept_allowed("purchase_orders", "procurement")
    assert not filters.dept_allowed("purchase_orders", "sales")


def test_get_since_in_year(spark):
    df = spark.createDataFrame(
        [(1, "ABC", False, "2024-01-01 10:00:00", 2024), (1, "XYZ", False, "2024-01-01 11:56:00", 2023),
         (2, "ABC", True, "2024-01-01 11:59:00", 2024)],
        "id int, subsidiary_id string, is_deleted boolean, ts string, fiscal_year int").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    assert [r.subsidiary_id for r in filters.get(df, 1, "XYZ").collect()] == ["XYZ"]
    assert filters.get(df, 2, "ABC").count() == 0                      # soft-deleted
    assert filters.since(df, "ts", "2024-01-01 12:00:00", "5 minutes").count() == 2
    assert filters.since(df, "ts", "2024-01-01 12:00:00", "4 minutes", strict=True).count() == 1
    assert filters.in_year(df, 2024).count() == 2
    assert filters.limit_rows(df, 1, order="ts").count() == 3


def test_fiscal_calendar_per_subsidiary(spark):
    from strata.operators.silver import with_fiscal_calendar
    subs = spark.createDataFrame([("ABC", 1), ("XYZ", 7)], "subsidiary_id string, fiscal_year_start int")
    df = spark.createDataFrame([("ABC", "2024-07-15"), ("XYZ", "2024-07-15"), ("XYZ", "2024-06-30")],
                               "subsidiary_id string, d string").withColumn("d", F.col("d").cast("date"))
    got = sorted((r.subsidiary_id, str(r.d), r.fiscal_year, r.fiscal_month)
                 for r in with_fiscal_calendar(df, "d", subs).collect())
    assert got == [("ABC", "2024-07-15", 2024, 7), ("XYZ", "2024-06-30", 2024, 12), ("XYZ", "2024-07-15", 2025, 1)]
