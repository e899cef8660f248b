"""Change feeds: metadata, faults, replay, order across topics, bucketed state, delta marts, incremental history, content diff."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import cdc, history, images, recon
from strata.session import released_shuffles
from strata.sources import changefeed, store
from strata.sources.lake import FixtureLake
from strata.streaming import marts

from paths import SF_SMALL

MESSAGES = "topic string, partition int, offset bigint, value string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("json, image", [
    ('{"__op":"u","id":5,"name":"a","__ts_ms":1,"__deleted":"false"}', '{"id":5,"name":"a"}'),
    ('{"id":5,"__op":"u","name":"a"}', '{"id":5,"name":"a"}'),
    ('{ "__op" : "d" , "id" : 5 }', '{ "id" : 5 }'),
    ('{"id":5,"note":"say \\"__op\\":\\"u\\", ok","__db":null}', '{"id":5,"note":"say \\"__op\\":\\"u\\", ok"}'),
    ('{"id":5,"note":"{,}","__table":"a\\"b"}', '{"id":5,"note":"{,}"}'),
    ('{"__op":"d"}', "{}"), ('{"id":5}', '{"id":5}')])
def test_metadata_is_stripped(spark, json, image):
    assert spark.createDataFrame([(json,)], "j string").select(images.strip_metadata(F.col("j"))).first()[0] == image


@pytest.mark.parametrize("table, image, fault", [
    ("employees", '{"id":5,"basic_salary":"12.50","date_hired":19000}', None),
    ("employees", '{"id":5,"basic_salary":null}', None),
    ("employees", '{"id":"5"}', None),
    ("employees", '{"id":"x"}', "no numeric id"), ("employees", "{}", "no numeric id"), ("employees", None, "no row image"),
    ("employees", '{"id":1,"a b":2,"c;":3}', "unsafe column name: a b,c;"),
    ("employees", '{"id":1,"basic_salary":"much","date_hired":"soon"}', "value does not parse: date_hired,basic_salary"),
    ("purchase_orders", '{"id":1,"order_date":"2024-02-30"}', "value does not parse: order_date")])
def test_image_faults(spark, table, image, fault):
    df = spark.createDataFrame([(table, image)], "t string, j string")
    got = df.select(images.image_fault(F.col("j"), F.col("t"))).first()[0]
    assert got == fault or sorted(got.partition(": ")[2].split(",")) == sorted(fault.partition(": ")[2].split(","))


def test_replay_adds_each_letter_once(spark):
    lake = FixtureLake(spark, SF_SMALL)
    parsed = images.with_faults(cdc.parse_envelope(changefeed.faulty_feed(lake)))
    log, dead = cdc.split_valid(parsed)[0], images.dead_letters(parsed)
    fix = lambda m: m.withColumn("value", F.regexp_replace("value", '"much"', "1"))
    new, left = images.replay(dead, log, fix)
    assert new.count() == parsed.filter("reject_reason like 'value%'").count() > 0
    assert left.filter("attempts <> 2").count() == 0 and left.count() + new.count() == dead.count()
    again, _ = images.replay(dead, log.unionByName(new), fix)
    assert again.count() == 0
    assert images.replay(dead.unionByName(dead), log, fix)[0].count() == new.count()


def test_order_across_topics_follows_commit_time(spark):
    def env(op, after, ms):
        return f'{{"op":"{op}","before":null,"after":{after},"ts_ms":{ms}}}'
    rows = [("abc.ops.purchase_orders", 0, 900, env("c", '{"id":1,"po_number":"P","status":"open"}', 1000)),
            ("abc.procurement.purchase_orders", 0, 3, '{"id":1,"status":"approved","__op":"u","__ts_ms":2000}'),
            ("abc.ops.purchase_orders", 0, 901, env("u", '{"id":1,"vendor_id":"V"}', 1500)),
            ("abc.ops.purchase_orders", 0, 5, env("c", '{"id":2,"po_number":"Q","status":"a"}', 1000)),
            ("abc.ops.purchase_orders", 0, 6, env("u", '{"id":2,"status":"b"}', 1000))]
    df = spark.createDataFrame(rows, MESSAGES)
    ok, bad = cdc.split_valid(cdc.parse_envelope(df))
    assert bad.count() == 0
    one = cdc.merge_changes(None, ok, "purchase_orders")
    got = {r["id"]: (r["status"], r["vendor_id"], r["cdc_topic"], r["cdc_offset"]) for r in one.collect()}
    assert got == {1: ("approved", "V", "abc.procurement.purchase_orders", 3), 2: ("b", None, "abc.ops.purchase_orders", 6)}
    first = cdc.merge_changes(None, ok.filter("event_ts < '1970-01-01 00:00:01.2'"), "purchase_orders")
    both = cdc.merge_changes(first, ok.filter("event_ts >= '1970-01-01 00:00:01.2'"), "purchase_orders")
    assert _rows(both) == _rows(one)


def _ledger(spark):
    feed = changefeed.ledger_feed(FixtureLake(spark, SF_SMALL)).filter("topic like '%ar_ledger'").persist()
    return [cdc.split_valid(cdc.parse_envelope(feed.filter(F.col("wave") == w).drop("wave")))[0].persist() for w in (1, 2, 3, 4)]


def test_untouched_buckets_keep_their_files(spark, tmp_root):
    waves = _ledger(spark)
    state = marts.BucketedState(f"{tmp_root}/ar", "ar_ledger", buckets=16)
    state.apply(waves[0], 0)
    before = state.versions(spark)
    assert set(before.values()) == {0} and len(before) == 16
    few = waves[1].filter("record_id in ('1', '3')")
    signed = state.apply(few, 1)
    assert signed.filter("sign = 1").count() == signed.filter("sign = -1").count() == few.count() > 0
    after = state.versions(spark)
    changed = {b for b in after if after[b] == 1}
    assert 0 < len(changed) <= 2 and all(after[b] == 0 for b in after if b not in changed)
    read = state.read(spark, only=changed)
    assert all(f"bucket={b}/" in " ".join(read.inputFiles()) for b in changed)
    assert {f.rpartition("bucket=")[2].partition("/")[0] for f in read.inputFiles()} == {str(b) for b in changed}
    assert state.apply(waves[1].filter("false"), 2) is None
    want = cdc.merge_changes(None, waves[0].unionByName(few), "ar_ledger").drop("ingested_at")
    assert _rows(state.read(spark).select(want.columns)) == _rows(want)


def test_marts_from_deltas_survive_replay_and_compaction(spark, tmp_root):
    waves = _ledger(spark)
    sink = marts.DeltaMarts(tmp_root, ["ar_monthly"], buckets=4)
    so_far = None
    for b, wave in enumerate(waves):
        sink(wave, b)
        sink(wave, b)  # the same micro-batch again
        so_far = wave if so_far is None else so_far.unionByName(wave)
        state = cdc.merge_changes(None, so_far, "ar_ledger").filter("not coalesce(is_deleted, false)")
        want = state.groupBy("subsidiary_id", F.year("invoice_date").alias("y"), F.month("invoice_date").alias("m")).agg(
            *[F.sum(c) for c in ("gross_amount", "vat_amount", "net_amount", "collected_amount")])
        got = sink.read(spark, "ar_monthly")
        key = lambda rows: sorted((tuple(str(v if v is None or isinstance(v, (str, int)) else v.normalize()) for v in r) for r in rows))
        assert key(got.collect()) == key(want.collect())
        if b == 1:
            sink.compact(spark, "ar_monthly", 1)
            os.makedirs(f"{tmp_root}/mart/ar_monthly/_batch=99")  # a write that did not commit counts for nothing
    assert store.committed_versions(spark, f"{tmp_root}/base/ar_monthly") == [1]


def test_files_that_no_batch_reads_again_go(spark, tmp_root):
    """A state lies on the disk twice at most, as the batch that runs reads and writes it; the batch's parsed log goes with it."""
    sink = marts.DeltaMarts(tmp_root, ["ar_monthly"], buckets=4)
    for b, wave in enumerate(_ledger(spark)):
        sink(wave, b)
        lying = {v: store.numbered_folders(spark, f"{tmp_root}/state/ar_ledger/v={v}", "bucket=") for v in range(b + 1)}
        assert sum(len(x) for x in lying.values()) <= 8 and len(sink.states["ar_ledger"].versions(spark)) == 4, lying
        assert not store.numbered_folders(spark, f"{tmp_root}/log", "_batch=")


def test_large_batches_are_merged_a_few_buckets_at_a_time(spark, tmp_root, monkeypatch):
    waves, merged = _ledger(spark), []
    merge = cdc.merge_changes
    monkeypatch.setattr(marts, "BYTES_PER_MERGE", 1)
    monkeypatch.setattr(cdc, "merge_changes", lambda *a: merged.append(a) or merge(*a))
    state, so_far = marts.BucketedState(f"{tmp_root}/ar", "ar_ledger", buckets=4), None
    for b, wave in enumerate(waves[:2]):
        signed = state.apply(wave, b, size=1000)
        so_far = wave if so_far is None else so_far.unionByName(wave)
        want = merge(None, so_far, "ar_ledger").drop("ingested_at")
        assert _rows(state.read(spark).select(want.columns)) == _rows(want)
        assert len(merged) == 4 * (b + 1)
        assert signed.groupBy("sign").count().count() == b + 1
    parts = [spark.range(3).withColumn("p", F.lit(0)), spark.range(3).selectExpr("raise_error('x') as id", "1 as p")]
    with pytest.raises(Exception):
        store.write_parts(iter(parts), f"{tmp_root}/v", 0, ["p"])
    assert store.committed_versions(spark, f"{tmp_root}/v") == []  # no part commits a version
    store.write_parts(iter(parts[:1] + [spark.range(2).withColumn("p", F.lit(1))]), f"{tmp_root}/v", 0, ["p"])
    assert store.committed_versions(spark, f"{tmp_root}/v") == [0] and store.read_version(spark, f"{tmp_root}/v", 0).count() == 5


def test_shuffles_are_released_with_their_action(spark, tmp_root):
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with released_shuffles(spark):
        before = kept()
        for i in range(20):
            spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(f"{tmp_root}/{i}")
        assert kept() <= before
    assert spark.conf.get(key, None) == was


def test_partitioned_versions_commit_under_dynamic_overwrite(spark, tmp_root):
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "dynamic")  # what get_spark sets
    try:
        df = spark.range(6).withColumn("p", F.col("id") % 3)
        store.write_version(df, tmp_root, 0, ["p"])
        assert store.committed_versions(spark, tmp_root) == [0]
        store.write_version(df.filter("p = 1"), tmp_root, 0, ["p"])  # a repeated attempt replaces the whole version
        assert {r["id"] for r in store.read_latest(spark, tmp_root).collect()} == {1, 4}
        state = marts.BucketedState(f"{tmp_root}/ar", "ar_ledger", buckets=2)
        waves = _ledger(spark)
        state.apply(waves[0], 0)
        assert state.apply(waves[1], 1).filter("sign = -1").count() == waves[1].count()
    finally:
        spark.conf.unset(mode)


def test_history_merged_in_parts_equals_one_scan(spark):
    lake = FixtureLake(spark, SF_SMALL)
    log = cdc.split_valid(cdc.parse_envelope(lake.cdc_messages()))[0].persist()
    lo, hi = log.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    stored = None
    for k in range(3):
        a, b = lo + (hi - lo + 1) * k // 3, lo + (hi - lo + 1) * (k + 1) // 3
        stored = history.scd2_merge(stored, log.filter((F.col("kafka_offset") >= a) & (F.col("kafka_offset") < b))).checkpoint()
    assert _rows(stored) == _rows(history.scd2(log).select(stored.columns))


def test_row_diff_values(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (4, "d", 4.0), (5, "e", 5.0), (5, "e", 6.0), (None, "n", 1.0)],
                                 "id int, s string, x double")
    right = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, None, 3.5), (5, "e", 6.0), (5, "e", 5.0), (6, "f", 6.0), (None, "n", 1.0)],
                                  "id int, s string, x double")
    got = {r["id"]: (r["side"], r["columns"]) for r in recon.row_diff_values(left, right, ["id"], buckets=4).collect()}
    assert got == {2: ("changed", "s"), 3: ("changed", "x"), 4: ("missing_in_right", None), 6: ("missing_in_left", None)}
    assert recon.row_diff_values(left, left, ["id"]).count() == 0


def test_a_row_differs_by_one_image_per_side(spark):
    """The hash of a row travels once in the comparison, not with each of its columns."""
    df = spark.createDataFrame([(1, "a", 1.0, True)], "id int, s string, x double, b boolean")
    plan = recon.row_diff_values(df, df.filter("id > 0"), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max(struct(_h") == 2, plan


def _nodes(plan):
    """The nodes of a physical plan that ran, those of its stages too."""
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_only_rows_that_differ_are_shuffled_whole(spark):
    """Though every bucket is unequal, whole rows cross one exchange, and few of those that are equal."""
    left = spark.range(20000).selectExpr("id", "concat('text-', id) as s", "id * 2 as n")
    right = left.filter("id % 1000 != 1").selectExpr("id", "if(id % 100 = 7, 'other', s) as s", "n")
    out = recon.row_diff_values(left, right, ["id"], buckets=16)
    got = out.collect()
    assert len(got) == 220 and sum(r["side"] == "changed" and r["columns"] == "s" for r in got) == 200
    wide = [n.metrics().get("shuffleRecordsWritten").get().value() for n in _nodes(out._jdf.queryExecution().executedPlan())
            if n.nodeName() == "Exchange" and any(x in n.output().toString() for x in ("s#", "max#"))]
    assert len(wide) == 1 and 220 <= wide[0] < 1000, wide


def test_rows_differ_whatever_the_buckets(spark, monkeypatch):
    """Few fine buckets open more rows and change no result; rows that repeat do not cancel each other."""
    left = spark.createDataFrame([(1, "a"), (2, "b"), (7, "p"), (7, "p"), (8, "x"), (9, "y"), (9, "y")], "id int, s string")
    right = spark.createDataFrame([(1, "a"), (2, "c"), (7, "q"), (7, "q"), (9, "y"), (9, "y"), (9, "y"), (10, "z")], "id int, s string")
    want = {2: ("changed", "s"), 7: ("changed", "s"), 8: ("missing_in_right", None), 9: ("changed", ""), 10: ("missing_in_left", None)}
    for fine in (1, 3, 1 << 27):
        monkeypatch.setattr(recon, "FINE", fine)
        got = recon.row_diff_values(left, right, ["id"], buckets=3).collect()
        assert {r["id"]: (r["side"], r["columns"]) for r in got} == want


def test_envelopes_and_images_are_parsed_once(spark):
    """A filter on the faults repeats no parse: one of the envelope and one of the image."""
    feed = changefeed.order_feed(FixtureLake(spark, SF_SMALL))
    log = cdc.split_valid(images.with_faults(cdc.parse_envelope(feed)))[0]
    assert log._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
    state = cdc.merge_changes(None, log, "purchase_orders")
    assert state._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 3  # and one of the columns


def test_fan_out_tables_are_spread_by_size(spark, monkeypatch):
    """Partitions of orders grow with the file, so a task's share does not."""
    from strata.sources import testdata
    size = store.size_of(spark, f"{SF_SMALL}/orders.parquet")
    monkeypatch.setitem(testdata.FAN_OUT_BYTES, "orders", size // 50)
    orders = testdata.TestTables(spark, SF_SMALL)("orders")
    assert orders.rdd.getNumPartitions() >= 50
    assert _rows(orders) == _rows(spark.read.parquet(f"{SF_SMALL}/orders.parquet"))
