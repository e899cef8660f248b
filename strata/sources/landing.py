"""Landing files and seeds.

* ``read_landing`` — polled JSON batches: a list of records or
  ``{"data": [...]}``; anything else yields no rows. Read with an explicit
  schema (no inference pass over the data).
* ``load_form_codes`` / ``form_codes`` — the BIR form-code seed.
* ``seed_subsidiaries`` — idempotent insert of the subsidiaries seed.
* ``export_audit_csv`` — the weekly CSV export of the recent event log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import FORM_CODES, SUBSIDIARY_SEED, TABLES

FORM_CODE_SCHEMA = "form_code string, description string"


def read_landing(spark: SparkSession, path: str, table: str,
                 renames: dict[str, str] | None = None,
                 extra_fields: list[str] | None = None) -> DataFrame:
    """Polled records for ``table`` from JSON landing files.

    Each file holds one JSON document: ``[{...}, ...]`` or ``{"data": [...]}``.
    Fields are read as text and typed per the bronze schema at ingest (so a
    bad value becomes a quarantined row, not a failed job). ``renames`` maps
    polled field names to bronze column names; ``extra_fields`` are read
    as they are (for ``ingest`` to rename or fall back on).
    """
    renames = renames or {}
    t = TABLES[table]
    fields = sorted(set(t.names) | set(renames) | set(extra_fields or []))
    rec = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("doc"))
    as_list = F.from_json(F.col("doc"), T.ArrayType(rec))
    as_obj = F.from_json(F.col("doc"), T.StructType([T.StructField("data", T.ArrayType(rec))]))
    recs = F.when(F.col("doc").startswith("["), as_list) \
            .when(F.col("doc").startswith("{"), as_obj["data"])
    out = raw.select(F.explode(F.coalesce(recs, F.array().cast(T.ArrayType(rec)))).alias("r")).select("r.*")
    for src, dst in renames.items():
        if src in out.columns:
            out = out.withColumn(dst, F.coalesce(F.col(dst), F.col(src)) if dst in out.columns
                                 else F.col(src)).drop(src)
    return out


def form_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FORM_CODES, FORM_CODE_SCHEMA)


def load_form_codes(spark: SparkSession, path: str) -> DataFrame:
    """The form-code seed CSV (header row, explicit schema)."""
    return spark.read.schema(FORM_CODE_SCHEMA).option("header", True).csv(path)


def seed_subsidiaries(spark: SparkSession, existing: DataFrame | None = None,
                      now: str = "2024-02-01 00:00:00") -> DataFrame:
    """The subsidiaries seed, inserted only where the key is absent.

    Returns the rows to insert when ``existing`` is given, otherwise the seed.
    """
    t = TABLES["subsidiaries"]
    rows = [(i + 1, *r) for i, r in enumerate(SUBSIDIARY_SEED)]
    seed = spark.createDataFrame(rows, "id int, subsidiary_id string, name string, tin string, "
                                       "sec_reg string, bir_rdo string, industry string, "
                                       "scale_factor string, fiscal_year_start int")
    ts = F.lit(now).cast("timestamp_ntz")
    seed = seed.select(
        *[F.col(c.name).cast(c.dtype).alias(c.name) if c.name in seed.columns else
          (ts.alias(c.name) if c.default == "now" else
           F.lit("PHP").alias(c.name) if c.name == "currency" else
           F.lit(True).alias(c.name) if c.name == "is_active" else
           F.lit(False).alias(c.name) if c.name == "is_deleted" else
           F.lit(None).cast(c.dtype).alias(c.name)) for c in t.columns])
    if existing is None:
        return seed
    return seed.join(existing.select("subsidiary_id"), "subsidiary_id", "left_anti").select(*t.names)


def export_audit_csv(log: DataFrame, as_of: str, path: str, days: int = 7) -> DataFrame:
    """Write the last ``days`` days of the event log as CSV with a header.

    Executors write the part files; nothing passes through the driver.
    Returns the exported rows (lazy) for counting / inspection.
    """
    end = F.lit(as_of).cast("timestamp_ntz")
    recent = log.filter((F.col("event_ts") >= end - F.expr(f"INTERVAL {days} DAYS")) & (F.col("event_ts") <= end))
    recent.write.mode("overwrite").option("header", True).csv(path)
    return recent
