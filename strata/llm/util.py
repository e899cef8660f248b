"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import shutil
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. What follows no longer
    depends on the executors that computed it, and reads one fixed set of rows."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
BATCH_BYTES = 16 << 20  # of an Arrow batch: the JVM and each Python worker hold a few at a time


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever they run: its source goes to the executors as a Python archive, once
    per application. Arrow batches of the session are bounded by ``BATCH_BYTES`` from then on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="strata-src-"), "strata-src")
        sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root)))
        _SHIPPED.add(sc.applicationId)


def trim() -> None:
    """Gives memory that a Python worker no longer uses back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` whose workers can import this package."""
    ship(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            trim()

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or longer where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def runs(texts: pa.Array, max_bytes: int = 1 << 20):
    """A column of texts as lists of about ``max_bytes``; a longer text is a list of its own."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size >= max_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def dump(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one binary value."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def load(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames nobody refers to any more
    (it acts on JVM garbage collection, which a small driver heap rarely triggers)."""
    for _ in range(2):  # the first round lets go of what Python holds in the JVM
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def slices(batches, max_bytes: int = 1 << 20, text: int = 1):
    """Arrow batches cut into runs of rows whose string column number ``text`` holds about
    ``max_bytes``; a longer text is a run of its own. Yields lists of columns."""
    for b in batches:
        col = b.column(text)
        size = np.diff(np.frombuffer(col.buffers()[1], np.int64 if str(col.type).startswith("large") else np.int32,
                                     len(col) + 1 + col.offset)[col.offset:].astype(np.int64)) if len(col) else []
        run = np.cumsum(size) // max_bytes if len(col) else []
        at = 0
        while at < len(col):
            end = int(np.searchsorted(run, run[at], side="right"))
            yield [c.to_pylist() for c in b.slice(at, end - at).columns]
            at = end
