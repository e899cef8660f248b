from pyspark.sql import functions as F

from strata.functions import columns as C


def test_aging_bucket_edges(spark):
    days = [-1, 0, 30, 31, 60, 61, 90, 91, None]
    want = ["90+", "0-30", "0-30", "31-60", "31-60", "61-90", "61-90", "90+", "90+"]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r[0] for r in df.select(C.aging_bucket("d")).collect()]
    assert got == want


def test_mask_tin(spark):
    df = spark.createDataFrame([(None,), ("a",), ("ñandú",)], "t string")
    got = [r[0] for r in df.select(C.mask_tin("t")).collect()]
    assert got[0] is None
    assert got[1] == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    import hashlib
    assert got[2] == hashlib.sha256("ñandú".encode()).hexdigest()


def test_topic_parts(spark):
    topics = ["abc.finance.journal_entries", "ABC.hr.employees", "abc.finance.public.journal_entries",
              "abc.finance", "abc.finance.x;drop", "abc.finance.a.b"]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    got = df.select(C.topic_parts("topic").alias("t")).select("t.*").collect()
    assert (got[0].subsidiary_id, got[0].source_dept, got[0].source_table, got[0].reason) == \
        ("ABC", "finance", "journal_entries", None)
    assert got[1].subsidiary_id == "ABC" and got[1].reason is None
    assert got[2].source_table == "journal_entries" and got[2].reason is None
    assert got[3].reason == "topic has fewer than 3 parts"
    assert got[4].reason == "unsafe table identifier"
    assert got[5].reason == "unexpected topic segment"


def test_operation_and_record_id(spark):
    df = spark.createDataFrame(
        [("c", '{"id": 5}', None), ("u", '{"x": 1}', '{"id": 7}'), ("d", None, '{"id": 9}'),
         (None, None, None), ("z", "{}", '{"id": "k"}')], "op string, a string, b string")
    got = df.select(C.operation_name("op").alias("o"), C.record_id("a", "b").alias("r")).collect()
    assert [r.o for r in got] == ["INSERT", "UPDATE", "DELETE", "INSERT", "INSERT"]
    assert [r.r for r in got] == ["5", "", "9", "", "k"]


def test_epoch_ms_missing_is_epoch(spark):
    df = spark.createDataFrame([(None,), (1704067200000,)], "ms bigint")
    got = [str(r[0]) for r in df.select(C.epoch_ms_to_ts("ms")).collect()]
    assert got == ["1970-01-01 00:00:00", "2024-01-01 00:00:00"]


def test_fiscal_year_start_month(spark):
    df = spark.createDataFrame([("2024-06-30",), ("2024-07-01",)], "d string").select(
        F.col("d").cast("date").alias("d"))
    got = df.select(C.fiscal_year("d", 7), C.fiscal_month("d", 7)).collect()
    assert [tuple(r) for r in got] == [(2024, 12), (2025, 1)]


def test_epoch_conversions_ignore_session_zone(spark):
    df = spark.createDataFrame([(1704067200123,)], "ms bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Manila")
        r = df.select(C.epoch_ms_to_ts("ms").alias("t")).select("t", C.ts_to_epoch_ms("t").alias("back")).first()
        assert str(r.t) == "2024-01-01 00:00:00.123000" and r.back == 1704067200123
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
