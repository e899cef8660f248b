"""Frames that are read more than once are stored once (``store.keep``): the change feed is parsed and a batch derived in one pass."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators import cdc, changes, images
from strata.sources import changefeed, store
from strata.sources.lake import FixtureLake

from paths import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["cdc_log_dedup", "cdc_state_incremental", "scd2_incremental", "cdc_replay"])
def test_envelopes_are_parsed_before_the_result_reads_them(spark, name):
    assert "__op" in _plan(entry.queries()["cdc_parse"](spark, SF_SMALL))  # the envelope's schema shows in a plan that parses
    assert "__op" not in _plan(entry.queries()[name](spark, SF_SMALL))


def test_kept_frame_has_the_same_rows_and_types(spark):
    df = spark.range(5).select("id", F.lit(None).cast("timestamp_ntz").alias("t"), F.lit("1.50").cast("decimal(18,2)").alias("d"))
    kept = store.keep(df, "test")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect())) and kept.dtypes == df.dtypes
    assert store.keep(df.filter("id < 0"), "test").count() == 0


def test_replay_that_keeps_gives_the_same(spark):
    parsed = images.with_faults(cdc.parse_envelope(changefeed.faulty_feed(FixtureLake(spark, SF_SMALL))))
    log, dead = cdc.split_valid(parsed)[0], images.dead_letters(parsed)
    fix = lambda m: m.withColumn("value", F.regexp_replace("value", '"much"', "1"))
    for plain, kept in zip(images.replay(dead, log, fix), images.replay(dead, log, fix, keep=True)):
        assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))


def test_insert_ignore_carries_a_key_once(spark):
    cols = "subsidiary_id string, customer_id string, customer_name string, seq int"
    batch = spark.createDataFrame([("ABC", "C1", "b", 1), ("ABC", "C1", "a", 2), ("ABC", "C1", None, 3), ("XYZ", "C1", "c", 1)], cols)
    got = changes.insert_ignore(None, batch, "customers", order="seq")
    assert sorted(map(tuple, got.collect())) == [("ABC", "C1", "b", 1), ("XYZ", "C1", "c", 1)] and got.columns == batch.columns
    assert "subsidiary_id, subsidiary_id" not in _plan(got)  # a field of the ranked row
    unordered = changes.insert_ignore(None, batch, "customers")
    assert sorted(map(tuple, unordered.collect())) == [("ABC", "C1", None, 3), ("XYZ", "C1", "c", 1)]
    only_keys = batch.select("subsidiary_id", "customer_id")
    assert changes.insert_ignore(None, only_keys, "customers").count() == 2
    assert changes.insert_ignore(None, batch, "customers", order="customer_id").count() == 2
