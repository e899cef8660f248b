"""Change feeds derived by Spark from the driver's tables, beside the one of customers and employees in ``testdata``.

* ``order_feed``: purchase orders captured under two departments, so one record's changes arrive on two topics with offsets of their
  own; operations sends full envelopes, procurement flattened records with metadata fields.
* ``ledger_feed``: payables and receivables that are entered wrong, corrected (amounts and dates move), partly deleted and partly entered
  again, in four waves.
* ``faulty_feed``: messages of which eight in ten have a fault.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.lake import Lake
from strata.sources.testdata import MONEY

DAY, HOUR = 86_400_000, 3_600_000


def _topic(k: Column, rest: str) -> Column:
    return F.concat(F.element_at(F.array(F.lit("abc"), F.lit("xyz"), F.lit("rtl")), (k % 3).cast("int") + 1), F.lit(f".{rest}"))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _envelope(op: str, after: Column, ms: Column) -> Column:
    return _text(f'{{"op":"{op}","before":null,"after":', after, ',"ts_ms":', ms, "}")


def order_feed(lake: Lake) -> DataFrame:
    """(topic, partition, offset, timestamp, value) of every order's life; see the module's docstring."""
    o = lake.source("orders")
    k, d = F.col("o_orderkey").cast("long"), F.col("o_orderdate").cast("date")
    base = F.unix_date(d).cast("long") * DAY
    far = F.lit(1_000_000_000_000)  # offsets of the two topics have nothing to do with each other
    total = F.col("o_totalprice").cast(MONEY)

    def ops(step, hours, op, image, when):
        ms = base + hours * HOUR
        return F.when(when, F.struct(_topic(k, "ops.purchase_orders").alias("topic"), (far + k * 8 + step).alias("offset"), ms.alias("ms"),
                                     _envelope(op, image, ms).alias("value")))

    def procurement(step, hours, op, fields, when, deleted):
        ms = base + hours * HOUR
        value = _text('{"__op":"', F.lit(op), '","id":', k, fields, ',"__ts_ms":', ms, ',"__db":"procurement","__deleted":"', F.lit(deleted), '"}')
        return F.when(when, F.struct(_topic(k, "procurement.purchase_orders").alias("topic"), (k * 8 + step).alias("offset"), ms.alias("ms"),
                                     value.alias("value")))

    always = F.lit(True)
    entered = _text('{"id":', k, ',"po_number":"PO-', k, '","vendor_id":"VND-', k % 100, '","order_date":"', d, '","status":"open","total_amount":', total, "}")
    closed = F.when(F.col("o_orderstatus") == "F", "received").otherwise("partial")
    life = F.array_compact(F.array(
        ops(1, 8, "c", entered, always),
        ops(2, 10, "u", _text('{"id":', k, ',"status":"checked"}'), k % 5 == 0),
        procurement(3, 12, "u", _text(',"status":"approved","expected_date":"', F.date_add(d, 14), '"'), always, "false"),
        ops(4, 32, "u", _text('{"id":', k, ',"status":"', closed, '"}'), k % 3 == 0),
        procurement(5, 48, "d", _text(',"status":"cancelled"'), k % 7 == 0, "true"),
        ops(6, 72, "c", _text('{"id":', k, ',"status":"reopened"}'), k % 21 == 0)))
    rows = o.select((k % 4).cast("int").alias("partition"), F.explode(life).alias("m"))
    return rows.select("m.topic", "partition", "m.offset", F.timestamp_millis("m.ms").cast("timestamp_ntz").alias("timestamp"), "m.value")


#: column of the feed -> (table, amount columns, date column, key columns carried)
_LEDGERS = {
    "ap_invoices": (["gross_amount", "vat_amount", "net_amount", "payment_amount"], ["invoice_number", "vendor_id"]),
    "ar_ledger": (["gross_amount", "vat_amount", "net_amount", "collected_amount"], ["invoice_number", "customer_id"]),
}


def ledger_rows(lake: Lake) -> dict[str, DataFrame]:
    """What ``ledger_feed`` reads of the payables and receivables, by table."""
    return {t: lake.bronze(t).select("id", "subsidiary_id", *texts, "invoice_date", *amounts) for t, (amounts, texts) in _LEDGERS.items()}


def ledger_feed(lake: Lake, waves: tuple[int, ...] = (1, 2, 3, 4), rows: dict[str, DataFrame] | None = None) -> DataFrame:
    """The messages and ``wave`` (1 to 4): entered with doubled amounts 45 days late, corrected, every seventh id deleted, every
    twenty-first entered again. ``rows`` brings the ``ledger_rows`` where they are stored; a wave is a filter and a projection of them."""
    parts = []
    for table, frame in (rows or ledger_rows(lake)).items():
        amounts, texts = _LEDGERS[table]
        k = F.col("id").cast("long")

        def image(factor, days, names):
            fields = []
            for c in names:
                if c in amounts:
                    v = F.coalesce((F.col(c) * factor).cast(MONEY).cast("string"), F.lit("null"))
                elif c == "invoice_date":
                    v = _text('"', F.date_add(c, days), '"')
                else:
                    v = _text('"', F.col(c), '"')
                fields += [f',"{c}":', v]
            return _text('{"id":', k, *fields, "}")

        every = [*texts, "invoice_date", *amounts]
        none = F.lit("null")
        life = {1: ("c", none, image(2, 45, every), F.lit(True)),
                2: ("u", none, image(1, 0, ["invoice_date", *amounts]), F.lit(True)),
                3: ("d", _text('{"id":', k, "}"), none, k % 7 == 0),
                4: ("c", none, image(1, 0, every), k % 21 == 0)}
        topic = F.concat(F.lower("subsidiary_id"), F.lit(f".finance.{table}"))
        for wave in waves:
            op, before, after, when = life[wave]
            ms = F.lit(1_700_000_000_000 + wave * DAY)
            value = _text(f'{{"op":"{op}","before":', before, ',"after":', after, ',"ts_ms":', ms, "}")
            parts.append(frame.filter(when).select(
                topic.alias("topic"), (k % 4).cast("int").alias("partition"), (k * 8 + wave).alias("offset"),
                F.timestamp_millis(ms).cast("timestamp_ntz").alias("timestamp"), value.alias("value"), F.lit(wave).alias("wave")))
    return reduce(DataFrame.unionByName, parts)


def faulty_feed(lake: Lake) -> DataFrame:
    """A message per event; the remainder of the event's id by ten says what is wrong with it (8 and 9: nothing)."""
    e = lake.source("events")
    i = F.col("event_id").cast("long")
    r = i % 10
    topic = (F.when(r == 0, F.lit("abc.hr")).when(r == 1, F.lit("abc.hr.emp-loyees")).when(r == 2, F.lit("abc.hr.customers"))
             .otherwise(_topic(i, "hr.employees")))
    rid = F.when(r == 4, F.lit("")).when(r == 5, _text('"id":"x', i, '",')).otherwise(_text('"id":', i, ","))
    extra = F.when(r == 6, F.lit(',"na me;":1')).otherwise(F.lit(""))
    salary = F.when(r == 7, F.lit('"much"')).otherwise(F.col("value").cast(MONEY).cast("string"))
    image = _text("{", rid, '"position":"clerk","basic_salary":', salary, extra, "}")
    value = _envelope("c", image, F.unix_millis(F.col("ts").cast("timestamp")))
    value = F.when(r == 3, F.substring(value, F.lit(1), F.length(value) - 2)).otherwise(value)
    return e.select(topic.alias("topic"), (i % 4).cast("int").alias("partition"), i.alias("offset"), F.col("ts").alias("timestamp"), value.alias("value"))
