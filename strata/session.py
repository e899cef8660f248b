"""SparkSession construction and shared-storage locations.

Cluster jobs read ``spark.checkpoint.dir`` from the session: that is the shared
folder for lineage cuts and versioned state. Only when it is unset (local
tests) do we create a scratch folder for it.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only sides whose size (file statistics at planning, measured
    # shuffle output under AQE) is below 10 MB; larger sides sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def _driver_memory() -> str:
    """60 % of physical memory (local mode runs everything in the driver),
    between 1 GB and 16 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    mb = int(total * 0.6 / (1024 * 1024))
    return f"{max(1024, min(16 * 1024, mb))}m"


def get_spark(master: str | None = None, app: str = "strata",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    given = SparkConf()  # what spark-submit and the cluster's defaults set
    builder = SparkSession.builder.appName(app)
    conf = {k: v for k, v in DEFAULT_CONF.items() if not given.contains(k)}
    if master or not given.contains("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
        shuffle_partitions = shuffle_partitions or int(cpus)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STRATA_DRIVER_MEMORY", _driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """The JVM compiles no method of more than 8000 bytes of code and interprets it instead, five times slower for the typed
    projection of a wide table. With this limit Spark evaluates such operators in several methods. A value that the session sets itself stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) in (None, "65535"):
        spark.conf.set(key, DEFAULT_CONF[key])


@contextlib.contextmanager
def released_shuffles(spark: SparkSession):
    """Within it the shuffle files of an action go when the action ends. Else they stay until the driver collects its garbage, and the files
    of all actions of a long query lie on the disk together. Streams take the setting when they start."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


_LOCAL_DIRS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Set by the cluster; when absent (local tests only) a scratch folder is
    created and registered so ``DataFrame.checkpoint()`` works.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = _LOCAL_DIRS.get(id(spark))
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        _LOCAL_DIRS[id(spark)] = d
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at run time
            pass
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # Spark Connect sessions take it from the conf only
        pass
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (never a machine-local temp dir)."""
    return "/".join([shared_dir(spark).rstrip("/"), *parts])
