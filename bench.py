"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Medallion flow, as it runs in production:
1. ``bronze_build`` — derive every bronze table and the change feed from the
   source tables, parse the feed once into the event log, and write them as
   Parquet (timed, included in the total);
2. each headline query — the same catalogue function the oracle checks,
   reading the stored bronze instead of re-deriving it.
Each query is fully evaluated with the ``noop`` sink (no collect).

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "group_pnl", "group_pnl_consolidated", "gold_financial_summary", "gold_inventory_summary",
    "fact_sales", "stg_finance__ap_invoices", "fact_finance_journal_entries", "trial_balance",
    "ar_aging", "stock_summary", "vendor_scorecard", "interco_elimination",
    "bir_compliance_scorecard", "cdc_parse", "cdc_state", "cdc_state_employees", "scd2_history",
    "dedupe_latest", "dq_fk", "arithmetic_checks", "insert_ignore", "patch_apply",
    "stream_30min_windows",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    from strata.plans.catalog import REGISTRY, _load_all, doubles
    from strata.operators.history import release_pinned
    from strata.plans.queries_cdc import parse_messages
    from strata.session import get_spark, scratch_path
    from strata.sources.lake import FixtureLake, materialize
    spark = get_spark(app="strata-bench")
    _load_all()
    fixtures = FixtureLake(spark, sf_dir)
    # warm-up: JVM, codegen cache, parquet footers (not timed)
    doubles(REGISTRY["group_pnl"].build(fixtures)).write.format("noop").mode("overwrite").save()
    times = {}
    root = scratch_path(spark, "bench", uuid.uuid4().hex)
    t0 = time.perf_counter()
    lake = materialize(fixtures, root, event_log=parse_messages)
    times["bronze_build"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        doubles(REGISTRY[name].build(lake)).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_pinned()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
