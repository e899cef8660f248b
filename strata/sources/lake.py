"""Where bronze tables come from.

``Lake`` is the one interface the operators read through:
``lake.bronze(name)`` returns live rows (soft-deleted rows excluded, D10),
``lake.raw(name)`` returns everything. Two implementations:

* ``FixtureLake`` — bronze tables derived by Spark from the driver's test
  tables (``strata.sources.testdata``).
* ``ParquetLake`` — bronze tables stored as Parquet under ``<root>/bronze``,
  versioned by ``strata.sources.store``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import testdata


def live_predicate():
    """Rows not soft-deleted (NULL counts as live); pushable to Parquet."""
    return F.col("is_deleted").isNull() | (F.col("is_deleted") == F.lit(False))


class Lake:
    spark: SparkSession

    def raw(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def bronze(self, name: str, include_deleted: bool = False) -> DataFrame:
        df = self.raw(name)
        if include_deleted or "is_deleted" not in df.columns:
            return df
        # NULL counts as live, as the NOT NULL DEFAULT FALSE column implies.
        # Written as IsNull OR = false so Parquet can push it into the scan.
        return df.filter(live_predicate())

    def cdc_messages(self) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def event_log(self) -> DataFrame | None:
        """The stored parsed change log, if the ingest step wrote one."""
        return None


class FixtureLake(Lake):
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.src = testdata.TestTables(spark, sf_dir)

    def raw(self, name: str) -> DataFrame:
        if name == "subsidiaries":
            return testdata.subsidiaries(self.spark)
        return testdata.FIXTURES[name](self.src)

    def cdc_messages(self) -> DataFrame:
        return testdata.cdc_raw(self.src)

    def source(self, name: str) -> DataFrame:
        return self.src(name)


class ParquetLake(Lake):
    """Bronze tables stored as versioned Parquet under ``<root>/bronze``.

    ``sources_dir`` optionally names the raw source tables (for operators
    that read them directly, e.g. de-duplication of source rows).
    """

    def __init__(self, spark: SparkSession, root: str, sources_dir: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sources_dir = sources_dir
        self._frames: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The live version of a bronze table, read with its declared schema
        (no footer pass) and resolved once per lake."""
        from strata.schemas import TABLES
        from strata.sources.store import read_table
        if name == "subsidiaries":
            return testdata.subsidiaries(self.spark)
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.root, "bronze", name,
                                            schema=TABLES[name].schema)
        return self._frames[name]

    def cdc_messages(self) -> DataFrame:
        from strata.sources.store import read_table
        return read_table(self.spark, self.root, "landing", "cdc_messages")

    def event_log(self) -> DataFrame | None:
        from strata.sources.store import exists, read_table, table_path
        if "_event_log" not in self._frames:
            path = table_path(self.root, "log", "cdc_events")
            self._frames["_event_log"] = (read_table(self.spark, self.root, "log", "cdc_events")
                                          if exists(self.spark, path) else None)
        return self._frames["_event_log"]

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sources_dir}/{name}.parquet")


# Fixtures derived from another fixture: table -> (parent table, argument name).
DERIVED = {"vat_returns": ("sales_transactions", "sales"), "journal_entries": ("ar_ledger", "ar"),
           "wht_filings": ("ap_invoices", "ap"), "wht_certificates": ("ap_invoices", "ap"),
           "statutory_contributions": ("payroll_runs", "payroll")}


def materialize(lake: FixtureLake, root: str, version: int = 1,
                tables: list[str] | None = None, workers: int = 4,
                event_log: Callable[[Lake], DataFrame] | None = None) -> ParquetLake:
    """Write every bronze table and the change feed of ``lake`` as versioned
    Parquet under ``root`` (the daily ingest step) and return a lake over it.

    Two waves: independent tables first (concurrently, from a small thread
    pool), then the tables derived from them, reading the stored parents
    instead of deriving them again. With ``event_log`` (lake -> parsed log)
    the change feed is parsed once, from the stored messages, and stored as
    the event log that downstream queries read.
    """
    from concurrent.futures import ThreadPoolExecutor

    from strata.sources.store import read_table, table_path, write_version

    names = list(testdata.FIXTURES) if tables is None else tables
    first = [n for n in names if n not in DERIVED or DERIVED[n][0] not in names]
    second = [n for n in names if n not in first]

    def write(n, df):
        return lambda: write_version(df(), table_path(root, "bronze", n), version)

    def run(jobs):
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for f in [pool.submit(j) for j in jobs]:
                f.result()

    wave1 = [write(n, lambda n=n: lake.raw(n)) for n in first]
    wave1.append(lambda: write_version(lake.cdc_messages(),
                                       table_path(root, "landing", "cdc_messages"), version))
    run(wave1)

    def derived(n):
        parent, arg = DERIVED[n]
        return testdata.FIXTURES[n](lake.src, **{arg: read_table(lake.spark, root, "bronze", parent)})
    stored = ParquetLake(lake.spark, root, lake.sf_dir)
    wave2 = [write(n, lambda n=n: derived(n)) for n in second]
    if event_log is not None:
        wave2.append(lambda: write_version(event_log(stored), table_path(root, "log", "cdc_events"),
                                           version))
    run(wave2)
    return ParquetLake(lake.spark, root, lake.sf_dir)
