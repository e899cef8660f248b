from pyspark.sql import functions as F

from strata.operators import cdc
from strata.sources import store
from strata.sources.lake import FixtureLake
from strata.streaming.cdc_stream import CdcBatchWriter, read_state

from paths import SF_SMALL


def test_foreach_batch_replay_is_idempotent(spark, tmp_root):
    msgs = FixtureLake(spark, SF_SMALL).cdc_messages()
    w = CdcBatchWriter(tmp_root, tables=["employees"])
    w(msgs, 0)
    first = sorted(tuple(r) for r in store.read_latest(spark, f"{tmp_root}/state/employees").collect())
    log_n = spark.read.parquet(f"{tmp_root}/log").count()
    w(msgs, 0)  # the same micro-batch delivered again after a failure
    again = sorted(tuple(r) for r in store.read_latest(spark, f"{tmp_root}/state/employees").collect())
    assert first == again
    assert spark.read.parquet(f"{tmp_root}/log").count() == log_n
    w(msgs, 1)  # a later batch re-delivering the same offsets appends nothing
    assert spark.read.parquet(f"{tmp_root}/log").count() == log_n
    batch_state = cdc.merge_changes(None, cdc.split_valid(cdc.parse_envelope(msgs))[0], "employees")
    assert store.read_latest(spark, f"{tmp_root}/state/employees").count() == batch_state.count()


def test_merge_on_read_between_compactions(spark, tmp_root):
    msgs = FixtureLake(spark, SF_SMALL).cdc_messages()
    parts = [msgs.filter((F.col("offset") % 3) == i) for i in range(3)]
    w = CdcBatchWriter(tmp_root, tables=["employees"], compact_every=2)
    for i, p in enumerate(parts):
        w(p, i)                       # compaction after batch 1 only
    assert store.committed_versions(spark, f"{tmp_root}/state/employees") == [1]
    batch_state = cdc.merge_changes(None, cdc.split_valid(cdc.parse_envelope(msgs))[0], "employees")
    got = sorted(tuple(r) for r in read_state(spark, tmp_root, "employees").drop("ingested_at").collect())
    want = sorted(tuple(r) for r in batch_state.drop("ingested_at").collect())
    assert got == want


def test_update_mode_windows_replay_and_merge_on_read(spark, tmp_root):
    """Update-mode tumbling windows: each micro-batch writes only its changed
    windows, a replayed batch overwrites its own output, and the newest row
    per window equals the batch aggregate over all messages."""
    import os
    import shutil
    from strata.streaming.cdc_stream import read_cdc_stream, read_latest, run_to_table, stream_monitor
    msgs = FixtureLake(spark, SF_SMALL).cdc_messages()
    src = f"{tmp_root}/source"
    msgs.repartitionByRange(3, "offset").write.parquet(src)
    ok, _bad = cdc.split_valid(cdc.parse_envelope(read_cdc_stream(spark, "files", src, max_per_trigger=1)))
    out = f"{tmp_root}/windows"
    run_to_table(stream_monitor(ok, "30 minutes", watermark="365 days"), out, f"{tmp_root}/ckpt",
                 mode="update").awaitTermination()
    keys = ["window_start", "window_end", "source_dept", "operation"]
    # Replay: the last batch's folder rewritten with the same rows changes nothing.
    last = max(int(p.split("=")[1]) for p in os.listdir(out) if p.startswith("_batch="))
    again = spark.read.parquet(f"{out}/_batch={last}")
    rows_last = again.collect()
    shutil.rmtree(f"{out}/_batch={last}")
    spark.createDataFrame(rows_last, again.schema).write.mode("overwrite").parquet(f"{out}/_batch={last}")
    got = sorted(tuple(r) for r in read_latest(spark, out, keys).select(*keys, "events", "last_event_ts").collect())
    batch_ok, _ = cdc.split_valid(cdc.parse_envelope(msgs))
    want = stream_monitor(batch_ok, "30 minutes").select(*keys, "events", "last_event_ts")
    assert got == sorted(tuple(r) for r in want.collect())
    assert spark.read.parquet(out).select("_batch").distinct().count() > 1


def test_doubled_feed_is_dropped_by_state_in_the_stream(spark, tmp_root):
    """The stream's own state drops what comes again, whatever the age of the change; a message without a value or offset passes."""
    from strata.streaming.cdc_stream import once_per_position, read_cdc_stream
    schema = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string"
    one = spark.createDataFrame([("a", 0, 1, None, "x"), ("a", 0, 2, None, None), ("b", 0, 1, None, "y")], schema)
    one.unionByName(one).coalesce(1).write.parquet(f"{tmp_root}/in")
    one.unionByName(spark.createDataFrame([("a", 0, 3, None, "old")], schema)).coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
    seen = []

    def sink(batch, _id):
        seen.extend((r.topic, r.offset, r.value) for r in batch.collect())
    stream = once_per_position(read_cdc_stream(spark, "files", f"{tmp_root}/in", max_per_trigger=1))
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(seen, key=str) == sorted([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), ("a", 3, "old")], key=str)


def test_log_comparison_opens_only_touched_ranges(spark, tmp_root):
    """The batch's offset ranges are a partition filter on the stored log, and only their files are read."""
    from strata.streaming import cdc_stream
    schema = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string"
    topic = FixtureLake(spark, SF_SMALL).cdc_messages().first()["topic"]

    def feed(*offsets):
        return spark.createDataFrame([(topic, 0, o, None, '{"op":"c","before":null,"after":"{\\"id\\": %d}","ts_ms":1}' % o) for o in offsets], schema)
    w = CdcBatchWriter(tmp_root, tables=[], compact_every=100)
    w(spark.createDataFrame([], schema), 0)                      # an empty first batch
    assert w.log(spark).count() == 0
    far = 7 * cdc_stream.OFFSETS_PER_RANGE
    w(feed(1, 2, far), 1)
    w(feed(2, 3), 2)
    assert sorted(r.kafka_offset for r in w.log(spark).collect()) == [1, 2, 3, far]
    again = cdc.split_valid(cdc.parse_envelope(feed(far, far + 1)))[0]
    part = cdc_stream.log_in_ranges(w.log(spark), again)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan or "PartitionFilters: [(_range" in plan, plan
    assert [r.kafka_offset for r in part.collect()] == [far]
    assert part.select(F.input_file_name()).distinct().count() == 1
    assert cdc_stream.read_log(spark, tmp_root).where("is_processed").count() == 0
    w.tables = [again.first()["source_table"]]
    w.compact(spark, 2)
    assert cdc_stream.read_log(spark, tmp_root).where("not is_processed").count() == 0
    w(feed(5), 3)
    assert [r.kafka_offset for r in cdc_stream.read_log(spark, tmp_root).where("not is_processed").collect()] == [5]


def test_waves_have_files_by_size_and_ascend(spark, tmp_root, monkeypatch):
    """A large feed lands in many files, wave after wave, so no task holds a fixed share of it."""
    import glob
    import os
    from strata.plans import queries_stream
    from strata.streaming import cdc_stream
    feed = FixtureLake(spark, SF_SMALL).cdc_messages()
    assert queries_stream._land_waves(feed, f"{tmp_root}/f0", f"{tmp_root}/s0", 4) == 1  # a small one: a file each
    monkeypatch.setattr(cdc_stream, "BYTES_PER_FILE", cdc_stream.store.size_of(spark, f"{tmp_root}/f0") // 12 + 1)
    files = queries_stream._land_waves(feed, f"{tmp_root}/f", f"{tmp_root}/s", 4, copies=2)
    assert files >= 5
    names = sorted(glob.glob(f"{tmp_root}/s/*.parquet"), key=os.path.getmtime)
    waves = [spark.read.parquet(*names[i * files:(i + 1) * files]).agg(F.min("offset"), F.max("offset"), F.count("*")).first() for i in range(4)]
    assert all(a[1] < b[0] for a, b in zip(waves, waves[1:])) and sum(w[2] for w in waves) == 2 * feed.count()


def test_sessions_merge_before_the_exchange(spark, tmp_root):
    """A task sends on its sessions, not its events: there are few tables, and one task gets all of a table. The setting is the query's alone."""
    from strata.streaming import cdc_stream
    rows = spark.range(4000).selectExpr("concat('t', id % 2) as source_table",
                                        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id % 1000 as int)) as event_ts")
    for i in range(2):
        rows.filter(F.lit(i == 0) == (F.col("event_ts") < F.lit("2024-01-01 08:00:00"))).repartition(4).write.mode("append").parquet(f"{tmp_root}/src")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{tmp_root}/src")
    before = spark.conf.get(cdc_stream.MERGE_FIRST, None)
    q = cdc_stream.run_to_table(cdc_stream.stream_sessions(stream), f"{tmp_root}/out", f"{tmp_root}/ckpt")
    q.awaitTermination()
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "MergingSessions" in plan[plan.rindex("Exchange"):], plan
    assert spark.conf.get(cdc_stream.MERGE_FIRST, None) == before
    got = sorted((r.source_table, str(r.session_start), str(r.session_end), r.events) for r in spark.read.parquet(f"{tmp_root}/out").collect())
    assert got == [(f"t{i}", f"2024-01-01 00:0{i}:00", f"2024-01-01 17:0{8 + i}:00", 2000) for i in (0, 1)]
