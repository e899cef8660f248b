"""Q6 in one pass: every check of a quality report as tagged rows, one scan for each table.

A check is declared on the stored table it reads (``Check``). ``report`` gives each row of a table one array of tags: the failed
row checks (null, accepted value, date, rule), and the row's key for each key check. Exploded, the tags of all tables
meet in one aggregate by (check, key):

* ``row``     fails once for each tagged row (only failing rows are tagged);
* ``unique``  fails once for each key that more than one row carries;
* ``sums``    fails once for each key whose two sums differ;
* ``fk``      fails once for each child row whose key no parent row carries; the parent tags its keys too.

So a table is read once however many checks it has, a key held by a third of all rows is combined before the shuffle, and the
parents of foreign keys need neither a second scan nor a join. Failures are then counted per check; a declared check
without any stays in the report with 0.

Defined cases: keys with a null part are no keys for ``unique`` and ``fk`` and form a group for ``sums``; a null predicate fails or passes as
the check's constructor says. An empty table fails nothing; without checks the report is empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import RESULT_COLS, arithmetic_rules

SUM = "decimal(28,2)"


@dataclass(frozen=True)
class Check:
    """``table``: the stored table read; ``kind``: row, unique, sums or fk; ``model``, ``name``, ``column``: how the report calls it."""

    table: str
    kind: str
    model: str
    name: str
    column: str
    failing: Column | None = None
    keys: tuple[str, ...] = ()
    sums: tuple[str, str] | None = None
    parent: str | None = None


def not_null(table: str, model: str, column: str, source: Column) -> Check:
    return Check(table, "row", model, "not_null", column, failing=source.isNull())


def accepted(table: str, model: str, column: str, source: Column, values: list[str]) -> Check:
    """A null passes."""
    return Check(table, "row", model, "accepted_values", column, failing=source.isNotNull() & ~source.isin(values))


def expression(table: str, model: str, name: str, holds: Column) -> Check:
    """A null counts as true."""
    return Check(table, "row", model, "expression", name, failing=~F.coalesce(holds, F.lit(True)))


def no_future(table: str, model: str, column: str, source: Column, as_of: str) -> Check:
    """A null passes."""
    return Check(table, "row", model, "no_future_dates", column, failing=F.coalesce(source > F.lit(as_of).cast("date"), F.lit(False)))


def rule(table: str, name: str, holds: Column) -> Check:
    """A null counts as false."""
    return Check(table, "row", table, "arithmetic", name, failing=~F.coalesce(holds, F.lit(False)))


def unique(table: str, model: str, keys: list[str]) -> Check:
    return Check(table, "unique", model, "unique", ",".join(keys), keys=tuple(keys))


def foreign_key(table: str, parent: str, keys: list[str]) -> Check:
    return Check(table, "fk", table, f"fk:{parent}", ",".join(keys), keys=tuple(keys), parent=parent)


def equal_sums(table: str, name: str, keys: list[str], sums: tuple[str, str]) -> Check:
    return Check(table, "sums", table, "arithmetic", name, keys=tuple(keys), sums=sums)


def all_rules() -> list[Check]:
    """The arithmetic rules of single rows."""
    return [rule(t, name, holds) for name, (t, holds) in arithmetic_rules().items()]


def _tag(number: int, key: Column | None, child: int, a: Column | None = None, b: Column | None = None) -> Column:
    nothing = F.lit(None).cast(SUM)
    return F.struct(F.lit(number).alias("check"), (F.array().cast("array<string>") if key is None else key).alias("key"), F.lit(child).alias("child"),
                    (nothing if a is None else a).alias("a"), (nothing if b is None else b).alias("b"))


def _tagged(rows: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """The tags of the rows of ``table``, made by projections, which Spark compiles: a generator and a higher-order function over them
    interpret their argument, here every predicate and key. Tags that do not apply are null and go after the explode."""
    needs: dict[str, Column] = {}
    keys: dict[tuple[str, ...], str] = {}
    tags = []

    def key_of(c: Check) -> str:
        if c.keys not in keys:
            keys[c.keys] = f"_k{len(keys)}"
            needs[keys[c.keys]] = F.array(*[F.col(k).cast("string") for k in c.keys])
            needs[f"{keys[c.keys]}_whole"] = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in c.keys], F.lit(True))
        return keys[c.keys]

    for i, c in enumerate(checks):
        if c.table == table:
            if c.kind == "row":
                needs[f"_f{i}"] = c.failing
                tags.append(F.when(F.col(f"_f{i}"), _tag(i, None, 1)))
            elif c.kind == "sums":
                needs[f"_a{i}"], needs[f"_b{i}"] = (F.col(x).cast(SUM) for x in c.sums)
                tags.append(_tag(i, F.col(key_of(c)), 1, F.col(f"_a{i}"), F.col(f"_b{i}")))
            else:
                tags.append(F.when(F.col(f"{key_of(c)}_whole"), _tag(i, F.col(key_of(c)), 1)))
        if c.parent == table:
            tags.append(F.when(F.col(f"{key_of(c)}_whole"), _tag(i, F.col(key_of(c)), 0)))
    needed = rows.select(*[v.alias(n) for n, v in needs.items()]).select(F.array(*tags).alias("t"))
    # Outer, though no array is empty: for the plain form Spark adds a filter on the array's size, which builds the array once more.
    return needed.select(F.explode_outer("t").alias("t")).filter(F.col("t").isNotNull()).select("t.*")


def report(spark: SparkSession, table: Callable[[str], DataFrame], checks: list[Check]) -> DataFrame:
    """The report of ``checks`` over the tables ``table(name)`` gives: model, check_name, column_name, failures, status."""
    declared = spark.createDataFrame([(i, c.kind, c.model, c.name, c.column) for i, c in enumerate(checks)],
                                     "check int, kind string, model string, check_name string, column_name string")
    names = sorted({c.table for c in checks} | {c.parent for c in checks if c.parent})
    if not names:
        return declared.select("model", "check_name", "column_name", F.lit(0).cast("long").alias("failures"), F.lit("pass").alias("status"))
    tagged = [_tagged(table(n), n, checks) for n in names]
    per_key = (reduce(DataFrame.unionByName, tagged).groupBy("check", "key")
               .agg(F.sum("child").alias("rows"), F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")))

    def of(kind):
        return [i for i, c in enumerate(checks) if c.kind == kind]
    failed = (F.when(F.col("check").isin(of("unique")), (F.col("n") > 1).cast("long"))
               .when(F.col("check").isin(of("sums")), F.coalesce((F.col("a") != F.col("b")).cast("long"), F.lit(0)))
               .when(F.col("check").isin(of("fk")), F.when(F.col("n") == F.col("rows"), F.col("rows")).otherwise(0))
               .otherwise(F.col("rows")))
    found = per_key.groupBy("check").agg(F.sum(failed).alias("failures"))
    out = declared.join(found, "check", "left").withColumn("failures", F.coalesce("failures", F.lit(0).cast("long")))
    return out.select(*RESULT_COLS[:4], F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))
