"""Plan-shape guarantees, read from the physical plans Catalyst produces.

(Every registered query's plan is also checked for Cartesian / nested-loop
joins and Python nodes in ``test_oracle.py``, on the DataFrame built there.)"""

import uuid

import pytest

from strata.operators import cdc, history
from strata.plans.catalog import REGISTRY, _load_all, doubles
from strata.sources.lake import FixtureLake, materialize

from paths import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans")) + "/" + uuid.uuid4().hex
    return materialize(FixtureLake(spark, SF_SMALL), root,
                       tables=["sales_transactions", "stockholders", "customers"])


def test_scan_is_pruned_and_filtered(spark, stored):
    _load_all()
    df = doubles(REGISTRY["group_pnl"].build(stored))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan, plan
    text = " ".join(scan)
    assert "invoice_number" not in text and "customer_name" not in text   # column pruning
    assert "is_deleted" in text and "IsNull(is_deleted)" in text          # live filter pushed


def test_tenant_totals_are_broadcast(spark, stored):
    df = history.close_to_100(stored.bronze("stockholders"))
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_log_append_broadcasts_only_offset_bounds(spark):
    msgs = FixtureLake(spark, SF_SMALL).cdc_messages()
    log = cdc.split_valid(cdc.parse_envelope(msgs))[0]
    plan = _plan(cdc.append_cdc_log(log, log))
    assert "BroadcastExchange" in plan


def test_stored_event_log_is_read_not_reparsed(spark, tmp_path_factory):
    """With the event log written at ingest, downstream queries scan it and
    never parse the JSON envelopes again; results equal a fresh parse."""
    from strata.plans.queries_cdc import parse_messages
    _load_all()
    fx = FixtureLake(spark, SF_SMALL)
    root = str(tmp_path_factory.mktemp("evlog")) + "/" + uuid.uuid4().hex
    lake = materialize(fx, root, tables=["customers"], event_log=parse_messages)
    assert lake.event_log() is not None
    for name in ["cdc_state", "scd2_history", "cdc_event_audit"]:
        df = doubles(REGISTRY[name].build(lake))
        if name != "scd2_history":  # its log is read through a persisted slice table
            files = " ".join(df.inputFiles())
            assert "/log/cdc_events/" in files and "cdc_messages" not in files, name
        got = sorted(tuple(map(str, r)) for r in df.collect())
        want = sorted(tuple(map(str, r)) for r in doubles(REGISTRY[name].build(fx)).collect())
        assert got == want, name
