"""The one-scan quality report: small cases by hand, the separate checks as a second opinion, and one scan for each table."""

import uuid

from pyspark.sql import functions as F

from strata.operators import checks
from strata.plans import queries_quality as qq
from strata.sources.lake import FixtureLake, materialize

from paths import SF_SMALL


def _tables(spark):
    parent = spark.createDataFrame([("x", 1, "p"), ("x", 1, "p"), ("x", None, "q"), ("y", 2, None)], "s string, k int, state string")
    child = spark.createDataFrame([("x", 1, 10, 10), ("x", 9, 5, 4), ("x", 9, 5, 6), ("y", None, 1, 2), (None, None, 3, 3)],
                                  "s string, k int, d int, c int")
    child = child.withColumn("d", F.col("d").cast("decimal(18,2)")).withColumn("c", F.col("c").cast("decimal(18,2)"))
    return {"parent": parent, "child": child}


def _checks():
    return [
        checks.not_null("parent", "parent", "state", F.col("state")), checks.accepted("parent", "parent", "state", F.col("state"), ["p"]),
        checks.unique("parent", "parent", ["s", "k"]), checks.foreign_key("child", "parent", ["s", "k"]),
        checks.rule("child", "equal", F.col("d") == F.col("c")), checks.expression("child", "child", "small", F.col("k") < 5),
        checks.equal_sums("child", "balanced", ["s"], ("d", "c"))]


def _failures(df):
    return {(r.model, r.check_name, r.column_name): (r.failures, r.status) for r in df.collect()}


def test_small_cases(spark):
    t = _tables(spark)
    assert _failures(checks.report(spark, t.get, _checks())) == {
        ("parent", "not_null", "state"): (1, "fail"), ("parent", "accepted_values", "state"): (1, "fail"),
        ("parent", "unique", "s,k"): (1, "fail"), ("child", "fk:parent", "s,k"): (2, "fail"),
        ("child", "arithmetic", "equal"): (3, "fail"), ("child", "expression", "small"): (2, "fail"),
        ("child", "arithmetic", "balanced"): (1, "fail")}


def test_empty_tables_and_no_checks(spark):
    t = {n: df.limit(0).withColumn("check", F.lit("clash")).withColumn("t", F.lit(1)) for n, df in _tables(spark).items()}
    got = _failures(checks.report(spark, t.get, _checks()))
    assert len(got) == len(_checks()) and set(got.values()) == {(0, "pass")}
    assert checks.report(spark, t.get, []).count() == 0


def test_report_equals_separate_checks_with_one_scan_each(spark, tmp_path_factory):
    declared = qq.declared_checks()
    names = sorted({c.table for c in declared} | {c.parent for c in declared if c.parent})
    root = str(tmp_path_factory.mktemp("checks")) + "/" + uuid.uuid4().hex
    lake = materialize(FixtureLake(spark, SF_SMALL), root, tables=names)
    df = qq.quality_report(lake)
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("FileScan parquet") == len(names)
    parts = [qq.dq_not_null, qq.dq_unique, qq.dq_fk, qq.dq_no_future, qq.dq_accepted, qq.arithmetic_checks]
    want = {}
    for p in parts:
        want.update(_failures(p(lake)))
    got = _failures(df)
    assert got == want and len(got) == len(declared)


def test_generators_of_a_report_read_a_made_column(spark):
    """F8: predicates and keys stand in projections, which Spark compiles, not in a generator's argument, which it interprets."""
    t = {n: spark.createDataFrame([("ABC", "k", 1)], "subsidiary_id string, ref string, amount int") for n in ("child", "parent")}
    declared = [checks.foreign_key("child", "parent", ["subsidiary_id", "ref"]), checks.rule("child", "positive", F.col("amount") > 0)]
    plan = checks.report(spark, t.get, declared)._jdf.queryExecution().optimizedPlan().toString()
    generators = [line for line in plan.split("\n") if "Generate" in line]
    assert len(generators) == 2 and not any("array(" in g or "CASE WHEN" in g for g in generators), plan
