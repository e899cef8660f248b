import random

from pyspark.sql import functions as F

from strata.operators import history


def test_neighbours_hot_key_matches_brute_force(spark):
    # one key holds most rows (a hot key) plus many small keys
    rnd = random.Random(7)
    data = [("hot", i, rnd.randint(0, 3)) for i in range(3000)]
    data += [(f"k{j}", i, rnd.randint(0, 3)) for j in range(200) for i in range(rnd.randint(1, 5))]
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = history.neighbours(df, ["k"], ["o"], ["v", "o"], slices=16)
    res = {(r.k, r.o): (r._prev.o if r._prev else None, r._next.o if r._next else None)
           for r in got.collect()}
    by_key = {}
    for k, o, _v in data:
        by_key.setdefault(k, []).append(o)
    for k, os_ in by_key.items():
        os_ = sorted(os_)
        for i, o in enumerate(os_):
            want = (os_[i - 1] if i else None, os_[i + 1] if i + 1 < len(os_) else None)
            assert res[(k, o)] == want, (k, o)


def test_neighbours_offset_slices_match_brute_force(spark):
    rnd = random.Random(11)
    data = [("hot", i * 3 + rnd.randint(0, 2), 0) for i in range(2000)]
    data += [(f"k{j}", rnd.randint(0, 10_000), 0) for j in range(300)]
    df = spark.createDataFrame(data, "k string, o long, v int").dropDuplicates(["k", "o"])
    got = history.neighbours(df, ["k"], ["o"], ["o"], slice_col="o", slice_width=100)
    res = {(r.k, r.o): (r._prev.o if r._prev else None, r._next.o if r._next else None)
           for r in got.collect()}
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r.k, []).append(r.o)
    for k, os_ in by_key.items():
        os_ = sorted(os_)
        for i, o in enumerate(os_):
            assert res[(k, o)] == (os_[i - 1] if i else None, os_[i + 1] if i + 1 < len(os_) else None)


def test_hot_key_is_split_across_slices(spark):
    df = spark.createDataFrame([("hot", i) for i in range(4000)], "k string, o int")
    r = df.repartitionByRange(8, "k", "o").withColumn("p", F.spark_partition_id())
    assert r.select("p").distinct().count() > 1


def _log_rows(spark, rows):
    return spark.createDataFrame(
        [("t", "ABC", rid, off, f"2024-01-01 00:00:{off:02d}", "abc.x.t", 0, op, a) for rid, off, op, a in rows],
        "source_table string, subsidiary_id string, record_id string, kafka_offset bigint, event_ts string, "
        "kafka_topic string, kafka_partition int, operation string, after_state string").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp_ntz"))


def test_scd2_versions(spark):
    log = _log_rows(spark, [
        ("1", 1, "INSERT", "a"), ("1", 2, "UPDATE", "a"),        # unchanged -> same version
        ("1", 3, "UPDATE", "b"), ("1", 4, "DELETE", None),       # delete closes b
        ("1", 5, "INSERT", "b"),                                 # re-insert after delete: new version
        ("2", 6, "UPDATE", "x"), ("2", 7, "UPDATE", "x"),
    ])
    out = sorted((r.record_id, r.after_state, r.version_offset, r.is_current,
                  r.valid_to.second if r.valid_to else None)
                 for r in history.scd2(log).collect())
    assert out == [("1", "a", 1, False, 3), ("1", "b", 3, False, 4), ("1", "b", 5, True, None),
                   ("2", "x", 6, True, None)]


def test_dedupe_latest_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, "2024-01-02", "a"), (1, "2024-01-02", "b"), (1, "2024-01-01", "z"),
                                (2, "2024-01-01", "q")], "k int, d string, v string")
    got = sorted(tuple(r) for r in history.dedupe_latest(df, ["k"], ["d"]).collect())
    assert got == [(1, "2024-01-02", "b"), (2, "2024-01-01", "q")]


def test_close_to_100(spark):
    df = spark.createDataFrame([("S", "h1", 1.0), ("S", "h2", 1.0), ("S", "h3", 1.0)],
                               "subsidiary_id string, stockholder_id string, ownership_pct double").withColumn(
        "ownership_pct", F.col("ownership_pct").cast("decimal(6,2)"))
    got = {r.stockholder_id: float(r.ownership_pct) for r in history.close_to_100(df).collect()}
    assert got == {"h1": 33.33, "h2": 33.33, "h3": 33.34}


def test_scd2_tracked_fields_only(spark):
    log = _log_rows(spark, [
        ("1", 1, "INSERT", '{"id":1,"name":"a","seen":1}'),
        ("1", 2, "UPDATE", '{"id":1,"name":"a","seen":2}'),   # untracked change: same version
        ("1", 3, "UPDATE", '{"id":1,"name":"b","seen":3}'),
    ])
    out = sorted((r.version_offset, r.is_current) for r in history.scd2(log, tracked=["name"]).collect())
    assert out == [(1, False), (3, True)]
    assert history.scd2(log, table="other").count() == 0


def test_scd2_slice_tables_are_released(spark):
    """The slice tables ``neighbours`` persists are freed by ``release_pinned``
    (the job runner calls it after each task), and the result stays computable."""
    history.release_pinned()
    log = _log_rows(spark, [("1", 1, "INSERT", "a"), ("1", 2, "UPDATE", "b"), ("2", 3, "INSERT", "x")])
    out = history.scd2(log)
    want = sorted(tuple(r) for r in out.collect())
    pinned = list(history._pinned.frames)
    assert len(pinned) == 2 and all(p.is_cached for p in pinned)
    assert history.release_pinned() == 2
    assert all(not p.is_cached for p in pinned)
    assert sorted(tuple(r) for r in out.collect()) == want
