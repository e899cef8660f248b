"""Versioned Parquet tables (S5, S9) on the shared file system.

A table is a folder of versions ``<base>/v=<n>``. A version is written once
with ``mode("overwrite")`` (so replaying a batch rewrites the same version)
and becomes visible only when Spark's commit protocol has written its
``_SUCCESS`` marker; readers take the highest committed version. No table
format jar is available here, so this is the copy-on-write convention that
stands in for Delta / Iceberg snapshots.

File-system access goes through Hadoop's ``FileSystem`` (so HDFS / object
stores work the same way as local paths); nothing is read on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files at ``path``."""
    fs, p, _ = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh folder under the shared one and read back: what reads it more than once does not derive it again, and
    reads the columns and rows it needs only. (``checkpoint`` runs its frame twice: to count it, and to write it.)"""
    path = scratch_path(df.sparkSession, "kept", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is stored at ``path``, if anything."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Versions under ``base`` whose write committed (``_SUCCESS`` present)."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            ok = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            if ok:
                out.append(int(name[2:]))
    return sorted(out)


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the folders ``<path>/<prefix>n``, ascending."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def write_parts(parts: Iterable[DataFrame], base: str, version: int, partition_by: list[str]) -> str:
    """Write one version in parts, each an action of its own that holds other partitions; it is committed after the last."""
    path, spark = f"{base.rstrip('/')}/v={version}", None
    for k, df in enumerate(parts):
        spark = df.sparkSession
        # Overwriting the first part drops what an attempt that failed left; no part marks the version as committed.
        w = df.write.mode("append" if k else "overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(*partition_by).parquet(path)
    fs, p, jvm = _fs(spark, path)
    fs.create(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"), True).close()
    return path


def write_version(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a whole version. Static overwrite, whatever the session says: a dynamic one leaves partitions of an attempt
    that failed, and no ``_SUCCESS`` at the version's root, so the version would never count as committed."""
    path = f"{base.rstrip('/')}/v={version}"
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_version(spark: SparkSession, base: str, version: int, schema=None) -> DataFrame:
    """One stored version; with ``schema`` no footer pass is needed to plan."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(f"{base.rstrip('/')}/v={version}")


def read_latest(spark: SparkSession, base: str, before: int | None = None,
                schema=None) -> DataFrame | None:
    """The newest committed version (optionally the newest below ``before``)."""
    vs = [v for v in committed_versions(spark, base) if before is None or v < before]
    return read_version(spark, base, vs[-1], schema) if vs else None


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_model(df: DataFrame, root: str, layer: str, name: str, version: int,
                partition_by: list[str] | None = None) -> str:
    """Materialise a model as a new version (full refresh)."""
    return write_version(df, table_path(root, layer, name), version, partition_by)


def read_table(spark: SparkSession, root: str, layer: str, name: str, schema=None) -> DataFrame:
    """The live version of a stored table."""
    df = read_latest(spark, table_path(root, layer, name), schema=schema)
    if df is None:
        raise FileNotFoundError(table_path(root, layer, name))
    return df


def drop_partitions(spark: SparkSession, base: str, cols: list[str], keys: list[tuple]) -> None:
    """Delete the folders of the given partition keys (those that exist)."""
    fs, _, jvm = _fs(spark, base)
    catalog = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for key in keys:
        folders = [f"{c}=" + ("__HIVE_DEFAULT_PARTITION__" if k is None else catalog.escapePathName(str(k)))
                   for c, k in zip(cols, key)]
        fs.delete(jvm.org.apache.hadoop.fs.Path("/".join([base.rstrip("/"), *folders])), True)
