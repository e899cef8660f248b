"""Catalogue entries over the feeds of ``sources.changefeed``: two topics of one table, flattened records, faults and their replay,
marts from change deltas; incremental history and reconciliation by content."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import cdc, history, images, recon
from strata.plans.catalog import REGISTRY, query
from strata.plans.oracle import EXTRA_CTES
from strata.plans.queries_cdc import CONSUMED_AT, LOG_CUTOFF, _typed_state_sql, kept_log
from strata.schemas import CDC_TABLES
from strata.session import released_shuffles, scratch_path
from strata.sources import changefeed, store
from strata.streaming import cdc_stream, marts

_SUB = "case {k} % 3 when 0 then 'abc' when 1 then 'xyz' else 'rtl' end"


# ---------------------------------------------------------------------------
# One table on two topics, one of them flattened
# ---------------------------------------------------------------------------
def _orders_sql() -> str:
    def step(topic, base, n, hours, op, before, after, when):
        return f"""
  select '{topic}' as dept, {base} + k * 8 + {n} as kafka_offset, '{op}' as operation, ms0 + {hours} * 3600000 as ms,
    {before} as before_state, {after} as after_state, k, sub from b where {when}"""

    k = "cast(k as varchar)"
    far = 1_000_000_000_000
    entered = (f"""'{{"id":' || {k} || ',"po_number":"PO-' || {k} || '","vendor_id":"VND-' || cast(k % 100 as varchar) || '","order_date":"' """
               """|| cast(d as varchar) || '","status":"open","total_amount":' || cast(total as varchar) || '}'""")
    approved = f"""'{{"id":' || {k} || ',"status":"approved","expected_date":"' || cast(d + 14 as varchar) || '"}}'"""
    status = lambda s: f"""'{{"id":' || {k} || ',"status":"' || {s} || '"}}'"""
    steps = [
        step("ops", far, 1, 8, "INSERT", "null", f"cast(json_extract({entered}, '$') as varchar)", "true"),
        step("ops", far, 2, 10, "UPDATE", "null", status("'checked'"), "k % 5 = 0"),
        step("procurement", 0, 3, 12, "UPDATE", "null", approved, "true"),
        step("ops", far, 4, 32, "UPDATE", "null", status("case when s = 'F' then 'received' else 'partial' end"), "k % 3 = 0"),
        step("procurement", 0, 5, 48, "DELETE", status("'cancelled'"), "null", "k % 7 = 0"),
        step("ops", far, 6, 72, "INSERT", "null", status("'reopened'"), "k % 21 = 0")]
    return f"""
with b as (select *, {_SUB.format(k='k')} as sub from (
    select cast(o_orderkey as bigint) as k, cast(o_orderdate as date) as d, o_orderstatus as s, cast(o_totalprice as decimal(18,2)) as total,
      cast(datediff('day', date '1970-01-01', cast(o_orderdate as date)) as bigint) * 86400000 as ms0 from orders) o),
m as ({" union all ".join(steps)})
select sub || '.' || dept || '.purchase_orders' as kafka_topic, cast(k % 4 as integer) as kafka_partition, cast(kafka_offset as bigint) as kafka_offset,
  upper(sub) as subsidiary_id, dept as source_dept, 'purchase_orders' as source_table, operation, cast(k as varchar) as record_id,
  before_state, after_state, epoch_ms(ms) as event_ts, timestamp '{CONSUMED_AT}' as consumed_at, false as is_processed
from m"""


EXTRA_CTES["ox_orders_log"] = _orders_sql()


def _orders_log(lake):
    return cdc.split_valid(images.with_faults(cdc.parse_envelope(changefeed.order_feed(lake), consumed_at=CONSUMED_AT)))[0]


@query("cdc_parse_flattened", "select * from ox_orders_log")
def cdc_parse_flattened(lake):
    """Full envelopes and flattened records of one table; metadata fields do not reach the image."""
    return _orders_log(lake)


@query("cdc_state_purchase_orders", _typed_state_sql("purchase_orders", "ox_orders_log"))
def cdc_state_purchase_orders(lake):
    """The state of a table captured on two topics, in the order of commit times."""
    return cdc.merge_changes(None, _orders_log(lake), "purchase_orders")


# ---------------------------------------------------------------------------
# T5: faults, dead letters, replay
# ---------------------------------------------------------------------------
EXTRA_CTES["ox_faulty"] = f"""
with e as (select *, cast(event_id as bigint) as i, cast(event_id as bigint) % 10 as r from events),
v as (select *, '{{"op":"c","before":null,"after":{{' || case r when 4 then '' when 5 then '"id":"x' || cast(i as varchar) || '",'
      else '"id":' || cast(i as varchar) || ',' end || '"position":"clerk","basic_salary":'
    || case r when 7 then '"much"' else cast(cast(value as decimal(18,2)) as varchar) end || case r when 6 then ',"na me;":1' else '' end
    || '}},"ts_ms":' || cast(epoch_us(ts) // 1000 as varchar) || '}}' as message from e)
select case r when 0 then 'abc.hr' when 1 then 'abc.hr.emp-loyees' when 2 then 'abc.hr.customers' else {_SUB.format(k='i')} || '.hr.employees' end as kafka_topic,
  cast(i % 4 as integer) as kafka_partition, i as kafka_offset, r,
  case r when 3 then substr(message, 1, length(message) - 2) else message end as raw_value,
  case r when 0 then 'topic has fewer than 3 parts' when 1 then 'unsafe table identifier' when 2 then 'table not captured for department'
    when 3 then 'invalid json' when 4 then 'no numeric id' when 5 then 'no numeric id' when 6 then 'unsafe column name: na me;'
    when 7 then 'value does not parse: basic_salary' end as reject_reason
from v"""


def _faulty(lake):
    return images.with_faults(cdc.parse_envelope(changefeed.faulty_feed(lake), consumed_at=CONSUMED_AT))


@query("cdc_quarantine", """
select kafka_topic, kafka_partition, kafka_offset, raw_value, reject_reason, cast(1 as integer) as attempts
from ox_faulty where reject_reason is not null""")
def cdc_quarantine(lake):
    """Rejected messages with their reason: topics, JSON, ids, column names and values at fault."""
    return images.dead_letters(_faulty(lake))


def _repair(messages):
    value = F.regexp_replace(F.regexp_replace("value", ',"na me;":1', ""), '"much"', "null")
    return messages.withColumn("value", value)


@query("cdc_replay", """
select kafka_topic, kafka_partition, kafka_offset, case when r in (6, 7) then 'appended' else reject_reason end as outcome,
  cast(case when r in (6, 7) then null else 3 end as integer) as attempts
from ox_faulty where reject_reason is not null""")
def cdc_replay(lake):
    """T5: dead letters read again twice through a repair; what became valid is appended once, the rest counts its attempts."""
    parsed = store.keep(_faulty(lake), "faulty")  # log and dead letters are stored tables in production
    log, dead = cdc.split_valid(parsed)[0], images.dead_letters(parsed)
    new, still = images.replay(dead, log, _repair, CONSUMED_AT, keep=True)
    new = store.keep(new, "appended")
    again, left = images.replay(dead.unionByName(still), log.unionByName(new), _repair, CONSUMED_AT, keep=True)
    appended = new.unionByName(again).select(*cdc.LOG_KEYS, F.lit("appended").alias("outcome"), F.lit(None).cast("int").alias("attempts"))
    return appended.unionByName(left.select(*cdc.LOG_KEYS, F.col("reject_reason").alias("outcome"), "attempts"))


# ---------------------------------------------------------------------------
# Marts from change deltas
# ---------------------------------------------------------------------------
_FINAL = "not (id % 7 = 0 and id % 21 <> 0)"


def _mart_sql(mart: str, table: str, paid: str) -> str:
    return f"""
select '{mart}' as mart, subsidiary_id, cast(extract(year from invoice_date) as integer) as fiscal_year,
  cast(extract(month from invoice_date) as integer) as fiscal_month, cast(sum(gross_amount) as double) as gross, cast(sum(vat_amount) as double) as vat,
  cast(sum(net_amount) as double) as net, cast(sum({paid}) as double) as paid
from br_{table} where {_FINAL} group by 1, 2, 3, 4"""


@query("stream_gold_marts", _mart_sql("ap_monthly", "ap_invoices", "payment_amount") + " union all "
       + _mart_sql("ar_monthly", "ar_ledger", "collected_amount"))
def stream_gold_marts(lake):
    """Monthly marts kept by signed deltas of a change stream that corrects amounts, moves dates, deletes and re-enters
    records; equal to the marts over what is left."""
    spark = lake.spark
    root = scratch_path(spark, "stream-runs", uuid.uuid4().hex)
    sink = marts.DeltaMarts(f"{root}/out", ["ap_monthly", "ar_monthly"], buckets=8)

    def on_batch(batch, number):
        sink(cdc.split_valid(cdc.parse_envelope(batch))[0], number)
        if number % 2:
            for name in sink.marts:
                sink.compact(spark, name, number)

    with released_shuffles(spark):
        rows = {}
        for table, frame in changefeed.ledger_rows(lake).items():  # derived once; each wave is made from what is stored
            frame.write.option("compression", "zstd").parquet(f"{root}/ledger/{table}")
            rows[table] = spark.read.schema(frame.schema).parquet(f"{root}/ledger/{table}")
        for wave in (1, 2, 3, 4):  # a wave lands, the stream goes on from its checkpoint and drains it as a micro-batch, and its files go
            feed = changefeed.ledger_feed(lake, (wave,), rows).drop("wave")
            (feed.write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", cdc_stream.MESSAGES_PER_FILE)
             .parquet(f"{root}/source/wave{wave}"))
            stream = cdc_stream.read_cdc_stream(spark, "files", f"{root}/source/*")
            (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
             .awaitTermination())
            store.remove(spark, f"{root}/source/wave{wave}")
        store.remove(spark, f"{root}/ledger")
    parts = []
    for name in sink.marts:
        m = sink.read(spark, name)
        parts.append(m.select(F.lit(name).alias("mart"), *m.columns[:3], *[F.col(c).alias(o) for c, o in zip(m.columns[3:], ("gross", "vat", "net", "paid"))]))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# History by merging
# ---------------------------------------------------------------------------
@query("scd2_incremental", REGISTRY["scd2_history"].sql)
def scd2_incremental(lake):
    """The history of the first part of the log, then only the changes since merged into it."""
    log = kept_log(lake)
    cut = F.lit(LOG_CUTOFF).cast("timestamp_ntz")
    stored = store.keep(history.scd2(log.filter(F.col("event_ts") < cut)), "history")  # a stored table in production
    history.release_pinned()
    return history.scd2_merge(stored, log.filter(F.col("event_ts") >= cut))


# ---------------------------------------------------------------------------
# Reconciliation by content, all departments
# ---------------------------------------------------------------------------
@query("row_diff_values", """
with a as (select subsidiary_id, id from br_ap_invoices)
select subsidiary_id, id, case when id % 97 = 0 then 'missing_in_right' else 'changed' end as side,
  case when id % 97 <> 0 then concat_ws(',', case when id % 83 = 0 then 'gross_amount' end, case when id % 89 = 0 then 'status' end) end as columns
from a where id % 97 = 0 or id % 89 = 0 or id % 83 = 0
union all select subsidiary_id, -id, 'missing_in_left', null from a where id % 101 = 0""")
def row_diff_values(lake):
    """Changed values, missing and extra rows between payables and an altered copy, found by digests of key buckets."""
    path = scratch_path(lake.spark, "row-diff", uuid.uuid4().hex)
    with released_shuffles(lake.spark):
        lake.bronze("ap_invoices").write.option("compression", "zstd").parquet(path)  # a stored table in production; the comparison reads each side thrice
    left = lake.spark.read.parquet(path)
    i = F.col("id")
    right = left.filter(i % 97 != 0).withColumns({
        "status": F.when(i % 89 == 0, F.lit("void")).otherwise(F.col("status")),
        "gross_amount": F.when(i % 83 == 0, F.col("gross_amount") + 1).otherwise(F.col("gross_amount")).cast("decimal(18,2)")})
    right = right.unionByName(left.filter(i % 101 == 0).withColumn("id", -i))
    return recon.row_diff_values(left, right, ["subsidiary_id", "id"])


def _departments_sql() -> str:
    parts = []
    for dept, tables in CDC_TABLES.items():
        rows = " union all ".join(f"select '{t}' as table_name, count(*) as row_count from br_{t}" for t in tables)
        parts.append(f"select '{dept}' as dept, table_name, row_count from ({rows})")
    return (f"with c as ({' union all '.join(parts)}) select * from c "
            "union all select dept, '*total*', cast(sum(row_count) as bigint) from c group by dept")


@query("dept_row_counts", _departments_sql())
def dept_row_counts(lake):
    """Rows per captured table of every department, and each department's total."""
    return recon.all_row_counts({d: {t: lake.bronze(t) for t in ts} for d, ts in CDC_TABLES.items()})
