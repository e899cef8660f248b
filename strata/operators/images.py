"""Row images of change messages: metadata of flattened records, faults, and replay of dead letters.

* A flattened record carries its metadata as fields that begin with ``__``; ``strip_metadata`` takes them out of the JSON
  text, so the image holds the row's columns only.
* ``with_faults`` gives a message that parsed a reason to be rejected when its image has no numeric id, names a column that is no safe
  identifier, or holds a value that does not parse as its column's type. The image is parsed once per row, inside a
  one-element ``transform``, and judged once, as a generator's output, so neither filters nor projections repeat it.
* ``replay`` reads dead letters again, through a repair if one is given: what is valid now and not in the log yet is appended,
  the rest stays dead with one attempt more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import once, safe_identifier
from strata.operators import cdc
from strata.schemas import CDC_TABLES
from strata.sources import store

_META = r'"__\w+"\s*:\s*(?:"(?:[^"\\]|\\.)*"|[^,}\s]+)'


def strip_metadata(json: Column) -> Column:
    """The JSON object without its fields that begin with ``__``. Quotes inside strings are escaped, so what a quoted
    name and a colon match is a field."""
    x = F.regexp_replace(json, rf"(?<!\\){_META}\s*,\s*", "")
    x = F.regexp_replace(x, rf"\s*,\s*{_META}", "")
    return F.regexp_replace(x, rf"^\s*\{{\s*{_META}\s*\}}\s*$", "{}")


def _bad_values(image: Column, source_table: Column) -> Column:
    """Comma-joined names of the fields whose value does not parse as their column's type; null where all do."""
    tables = {t: {f.name: f.dataType for f in cdc.data_columns(t) if f.dataType.simpleString() != "string"}
              for t in sorted({t for ts in CDC_TABLES.values() for t in ts})}
    types = {d.simpleString(): d for cols in tables.values() for d in cols.values()}

    def literal_map(pairs: dict) -> Column:
        return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])

    no_kinds = F.create_map().cast("map<string,string>")
    by_table = literal_map({t: literal_map({c: F.lit(d.simpleString()) for c, d in cols.items()}) if cols else no_kinds for t, cols in tables.items()})

    def bad(e: Column) -> Column:
        out = F.lit(False)
        for name, t in types.items():
            out = F.when(e["kind"] == name, cdc._typed(e["value"], t).isNull()).otherwise(out)
        return e["value"].isNotNull() & e["kind"].isNotNull() & out

    def names(kinds: Column) -> Column:
        """A field's kind is looked up once, among its table's columns."""
        typed = F.transform(F.map_entries(image), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"),
                                                                     F.try_element_at(kinds, e["key"]).alias("kind")))
        return F.array_join(F.transform(F.filter(typed, bad), lambda e: e["key"]), ",")

    found = F.transform(F.array(F.try_element_at(by_table, source_table)), names)[0]
    return F.when(found != "", found)


def image_fault(image: Column, source_table: Column) -> Column:
    """Why the image (JSON text) is rejected; null where it is sound."""
    def fault(m: Column) -> Column:
        unsafe = F.concat_ws(",", F.filter(F.map_keys(m), lambda k: ~safe_identifier(k)))
        bad = _bad_values(m, source_table)
        return (F.when(m.isNull(), "no row image")
                 .when(m["id"].try_cast("bigint").isNull(), "no numeric id")
                 .when(unsafe != "", F.concat(F.lit("unsafe column name: "), unsafe))
                 .when(bad.isNotNull(), F.concat(F.lit("value does not parse: "), bad)))
    return F.transform(F.array(F.from_json(image, "map<string,string>")), fault)[0]


def with_faults(parsed: DataFrame) -> DataFrame:
    """``parse_envelope`` rows whose ``reject_reason`` also tells faults of the image."""
    image = F.coalesce(F.when(F.col("operation") != "DELETE", F.col("after_state")), F.col("before_state"), F.col("after_state"))
    fault = F.when(F.col("reject_reason").isNull(), image_fault(image, F.col("source_table")))
    judged = parsed.select("*", once(fault).alias("_fault"))
    return judged.withColumn("reject_reason", F.coalesce("reject_reason", "_fault")).drop("_fault")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The rejected messages: position, raw value, reason and the number of attempts to read them."""
    bad = parsed.filter(F.col("reject_reason").isNotNull())
    attempts = F.col("attempts") + 1 if "attempts" in parsed.columns else F.lit(1)
    return bad.select(*cdc.LOG_KEYS, "raw_value", "reject_reason", attempts.cast("int").alias("attempts"))


def replay(dead: DataFrame, log: DataFrame | None, repair: Callable[[DataFrame], DataFrame] | None = None,
           consumed_at: str | None = None, keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """T5: (log rows to append, letters that stay dead). ``repair`` maps (topic, partition, offset, value, attempts) to the same
    columns; positions stay, so what the log holds already is not appended again. A position that was quarantined more than once counts once, with its
    highest number of attempts. With ``keep`` the letters as read are stored once for both results; otherwise each result reads them."""
    letters = dead.groupBy(*cdc.LOG_KEYS).agg(F.max_by("raw_value", "attempts").alias("value"), F.max("attempts").alias("attempts"))
    messages = letters.select(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
                              F.col("kafka_offset").alias("offset"), "value", "attempts")
    if repair is not None:
        messages = repair(messages).select("topic", "partition", "offset", "value", "attempts")
    parsed = with_faults(cdc.parse_envelope(messages, consumed_at=consumed_at, keep=["attempts"]))
    if keep:
        parsed = store.keep(parsed, "replayed")
    ok = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_value", "attempts")
    return cdc.append_cdc_log(log, ok), dead_letters(parsed)
