"""Catalogue entries for change capture, the event log, state and history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from strata.operators import cdc, history, monitor
from strata.plans.catalog import query
from strata.plans.oracle import EXTRA_CTES
from strata.schemas import TABLES
from strata.sources import store

# The consumption time and the monitoring clock used by the
# catalogue (every "now" is an argument, never the wall clock).
CONSUMED_AT = "2024-02-01 00:00:00"
LOG_CUTOFF = "2024-01-15 00:00:00"     # messages before this were consumed already
AS_OF = "2024-01-30 12:00:00"
AUDIT_DAY = "2024-01-31"


def parse_messages(lake):
    """The valid rows of the change feed, parsed from the raw messages."""
    ok, _bad = cdc.split_valid(cdc.parse_envelope(lake.cdc_messages(), consumed_at=CONSUMED_AT))
    return ok


def parsed_log(lake):
    """The parsed change log: the stored one when the ingest step wrote it
    (parsed once, read by every downstream query), else parsed here."""
    stored = lake.event_log()
    return stored if stored is not None else parse_messages(lake)


def kept_log(lake):
    """``parsed_log`` for queries that read it more than once: parsed here, it is stored first."""
    stored = lake.event_log()
    return stored if stored is not None else store.keep(parse_messages(lake), "log")


EXTRA_CTES["ox_cdc_log"] = f"""
with m as (select *, json_extract_string(value, '$.op') as op,
    nullif(json_extract(value, '$.before')::varchar, 'null') as b,
    nullif(json_extract(value, '$.after')::varchar, 'null') as a,
    cast(json_extract(value, '$.ts_ms') as bigint) as ms from fx_cdc_raw)
select topic as kafka_topic, "partition" as kafka_partition, "offset" as kafka_offset,
  upper(split_part(topic, '.', 1)) as subsidiary_id, split_part(topic, '.', 2) as source_dept,
  split_part(topic, '.', 3) as source_table,
  case coalesce(op, 'c') when 'c' then 'INSERT' when 'u' then 'UPDATE' when 'd' then 'DELETE'
    when 'r' then 'SNAPSHOT' else 'INSERT' end as operation,
  coalesce(json_extract_string(coalesce(a, b), '$.id'), '') as record_id,
  b as before_state, a as after_state, epoch_ms(ms) as event_ts,
  timestamp '{CONSUMED_AT}' as consumed_at, false as is_processed
from m"""


@query("cdc_parse", "select * from ox_cdc_log")
def cdc_parse(lake):
    """Change messages -> event-log rows (valid rows only)."""
    return parse_messages(lake)


@query("cdc_log_dedup", "select * from ox_cdc_log")
def cdc_log_dedup(lake):
    """M1: re-delivered and doubled messages append once.

    The log already holds everything before LOG_CUTOFF; the next batch
    re-delivers the whole feed twice. The appended log equals the feed.
    """
    log = kept_log(lake)
    log0 = log.filter(F.col("event_ts") < F.lit(LOG_CUTOFF).cast("timestamp_ntz"))
    batch = log.unionByName(log)
    return log0.unionByName(cdc.append_cdc_log(log0, batch))


@query("cdc_state", """
with r as (select *, operation = 'DELETE' as is_del,
    operation <> 'DELETE' and after_state is not null as up from ox_cdc_log)
select source_table, subsidiary_id, record_id,
  arg_max(after_state, kafka_offset) filter (where up) as after_state,
  arg_max(operation, kafka_offset) filter (where up) as cdc_operation,
  arg_max(is_del, kafka_offset) as is_deleted,
  case when arg_max(is_del, kafka_offset) then max(event_ts) filter (where is_del) end as deleted_at,
  min(event_ts) as first_event_ts, max(event_ts) as last_event_ts, count(*) as n_events,
  max(kafka_offset) as last_offset
from r group by source_table, subsidiary_id, record_id
having count(*) filter (where up) > 0""")
def cdc_state(lake):
    """M2-M4 over the whole log: latest image, op and soft-delete flag per record."""
    return cdc.record_state(parsed_log(lake))


def _typed_sql(col: str, kind_sql: str) -> str:
    t = {"string": "varchar", "timestamp_ntz": "timestamp", "int": "integer"}.get(kind_sql, kind_sql)
    return f"cast(json_extract_string(after_state, '$.{col}') as {t})"


# A change's place among all changes of its record.
POS = "(event_ts, kafka_topic, kafka_partition, kafka_offset)"


def _typed_state_sql(table: str, log: str = "ox_cdc_log") -> str:
    from strata.schemas import SQL_TYPES
    t = TABLES[table]
    fields = [c for c in t.columns if c.name not in ("id", "subsidiary_id", "ingested_at",
                                                     "is_deleted", "deleted_at")]
    cols = []
    for c in t.columns:
        if c.name == "id":
            cols.append("id")
        elif c.name == "subsidiary_id":
            cols.append("subsidiary_id")
        elif c.name == "ingested_at":
            cols.append("min(event_ts) as ingested_at")
        elif c.name == "is_deleted":
            cols.append(f"arg_max(is_del, {POS}) as is_deleted")
        elif c.name == "deleted_at":
            cols.append(f"case when arg_max(is_del, {POS}) then max(event_ts) filter (where is_del) "
                        "end as deleted_at")
        else:
            val = (f"arg_max({_typed_sql(c.name, SQL_TYPES[c.kind])}, {POS}) filter "
                   f"(where up and list_contains(json_keys(after_state), '{c.name}'))")
            if c.not_null and c.default is not None and c.default != "now":
                val = f"coalesce({val}, {c.default})"
            cols.append(f"{val} as {c.name}")
    assert fields
    return f"""
with r as (select *, operation = 'DELETE' as is_del,
    operation <> 'DELETE' and after_state is not null as up,
    cast(json_extract_string(case when operation = 'DELETE' then before_state else after_state end, '$.id')
      as integer) as id
  from {log} where source_table = '{table}')
select {', '.join(cols)},
  arg_max(operation, {POS}) filter (where up) as cdc_operation,
  max(event_ts) as cdc_event_ts, arg_max(kafka_topic, {POS}) as cdc_topic, arg_max(kafka_partition, {POS}) as cdc_partition,
  arg_max(kafka_offset, {POS}) as cdc_offset
from r where id is not null group by subsidiary_id, id
having count(*) filter (where up) > 0"""


def _typed_state(table):
    def build(lake):
        return cdc.merge_changes(None, parsed_log(lake), table)
    build.__doc__ = f"M2-M5: typed bronze state of {table} merged from the change log."
    return build


for _t in ("employees", "customers"):
    query(f"cdc_state_{_t}", _typed_state_sql(_t))(_typed_state(_t))


FED = ("customers", "employees")  # the tables the change feed carries
STATE_COLS = ["subsidiary_id", "id", "source_dept", "is_deleted", "deleted_at", "cdc_operation", "cdc_event_ts", "cdc_topic", "cdc_partition", "cdc_offset"]


def fed_state_sql() -> str:
    """The states of all fed tables: a row's data columns as text, one after another."""
    parts = []
    for t in FED:
        data = [c.name for c in TABLES[t].columns if c.name not in STATE_COLS + ["ingested_at"]]
        text = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in data)
        parts.append(f"select '{t}' as table_name, {', '.join(STATE_COLS)}, {text} as content from ({_typed_state_sql(t)}) s_{t}")
    return " union all ".join(parts)


def fed_state(states: dict):
    """One frame of the states of all fed tables; see ``fed_state_sql``."""
    parts = []
    for t, df in states.items():
        data = [c.name for c in TABLES[t].columns if c.name not in STATE_COLS + ["ingested_at"]]
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in data]
        parts.append(df.select(F.lit(t).alias("table_name"), *STATE_COLS, F.concat_ws("|", *text).alias("content")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("cdc_state_incremental", fed_state_sql())
def cdc_state_incremental(lake):
    """M2-M5 applied in two batches (state after the first, then the rest) to every fed table —
    must equal the one-shot merge: merge is associative over batches."""
    log = kept_log(lake)
    cut = F.lit(LOG_CUTOFF).cast("timestamp_ntz")

    def merged(table):
        s1 = store.keep(cdc.merge_changes(None, log.filter(F.col("event_ts") < cut), table), table)  # a stored table in production
        return cdc.merge_changes(s1, log.filter(F.col("event_ts") >= cut), table)

    return fed_state({t: merged(t) for t in FED})


@query("scd2_history", """
with e as (select source_table, subsidiary_id, record_id, kafka_offset, event_ts, after_state,
    operation = 'DELETE' as is_del from ox_cdc_log where operation = 'DELETE' or after_state is not null),
p as (select *, lag(after_state) over w as prev_a, lag(is_del) over w as prev_del from e
  window w as (partition by source_table, subsidiary_id, record_id order by kafka_offset, event_ts)),
b as (select * from p where (not is_del and (prev_del is null or prev_del or prev_a is distinct from after_state))
    or (is_del and prev_del is not null and not prev_del)),
n as (select *, lead(event_ts) over (partition by source_table, subsidiary_id, record_id
    order by kafka_offset, event_ts) as nxt from b)
select source_table, subsidiary_id, record_id, after_state, event_ts as valid_from, nxt as valid_to,
  nxt is null as is_current, kafka_offset as version_offset
from n where not is_del""")
def scd2_history(lake):
    """Type-2 validity intervals per record from the change log."""
    return history.scd2(parsed_log(lake))


@query("cdc_event_audit", f"""
select cast(event_ts as date) as event_date, source_dept, operation, count(*) as event_count
from ox_cdc_log where event_ts >= date '{AUDIT_DAY}' - interval 7 day and event_ts < date '{AUDIT_DAY}' + interval 1 day
group by cast(event_ts as date), source_dept, operation""")
def cdc_event_audit(lake):
    """Events per day, department and operation over the last 7 days."""
    return monitor.cdc_event_audit(parsed_log(lake), AUDIT_DAY)


@query("cdc_status", f"""
select count(*) as total_events, max(event_ts) as last_event_ts
from ox_cdc_log where event_ts between timestamp '{AS_OF}' - interval 30 minute and timestamp '{AS_OF}'""")
def cdc_status(lake):
    """Events and newest event time in the last 30 minutes."""
    return monitor.cdc_status(parsed_log(lake), AS_OF)


@query("cdc_freshness", f"""
select case when max(event_ts) is not null then 'ok' else 'warning' end as status,
  max(event_ts) as last_event_ts
from ox_cdc_log where event_ts > timestamp '{AS_OF}' - interval 5 minute and event_ts <= timestamp '{AS_OF}'""")
def cdc_freshness(lake):
    """A10: ok when an event arrived within the last 5 minutes (strict)."""
    return monitor.cdc_freshness(parsed_log(lake), AS_OF)


@query("offset_lag", f"""
with latest as (select topic as kafka_topic, "partition" as kafka_partition, max("offset") as latest_offset
    from fx_cdc_raw group by 1, 2),
consumed as (select kafka_topic, kafka_partition, max(kafka_offset) as consumed_offset
    from ox_cdc_log where event_ts < timestamp '{LOG_CUTOFF}' group by 1, 2)
select l.kafka_topic, l.kafka_partition, l.latest_offset, c.consumed_offset,
  l.latest_offset - coalesce(c.consumed_offset, -1) as lag
from latest l left join consumed c on l.kafka_topic = c.kafka_topic and l.kafka_partition = c.kafka_partition""")
def offset_lag(lake):
    """Consumer lag per topic-partition: newest offset on the feed minus newest consumed."""
    msgs = lake.cdc_messages()
    latest = (msgs.groupBy(F.col("topic").alias("kafka_topic"),
                           F.col("partition").cast("int").alias("kafka_partition"))
                  .agg(F.max("offset").alias("latest_offset")))
    log = parsed_log(lake).filter(F.col("event_ts") < F.lit(LOG_CUTOFF).cast("timestamp_ntz"))
    return monitor.offset_lag(log, latest)


@query("dedupe_latest", """
select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_orderkey desc, l_partkey desc, l_suppkey desc, l_linenumber desc,
    l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
    l_linestatus desc) as rn from lineitem) t where rn = 1""")
def dedupe_latest(lake):
    """Latest row per (l_orderkey, l_linenumber) by ship date (ties: all columns)."""
    li = lake.source("lineitem")
    return history.dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(
        *li.columns, F.lit(1).cast("bigint").alias("rn"))


@query("ownership_closed", "select * from ox_ownership")
def ownership_closed(lake):
    """Stockholder percentages per subsidiary closed to exactly 100."""
    sh = lake.bronze("stockholders").select("subsidiary_id", "stockholder_id", "name",
                                            "is_foreign", "ownership_pct")
    return history.close_to_100(sh)


@query("cdc_state_with_deletes", """
with r as (select *, operation = 'DELETE' as is_del,
    operation <> 'DELETE' and after_state is not null as up from ox_cdc_log),
s as (select source_table, subsidiary_id, record_id,
    arg_max(after_state, kafka_offset) filter (where up) as after_state,
    arg_max(is_del, kafka_offset) as is_deleted,
    max(event_ts) filter (where is_del) as deleted_at,
    count(*) filter (where is_del) as deletes
  from r group by source_table, subsidiary_id, record_id
  having count(*) filter (where up) > 0)
select source_table, subsidiary_id, record_id, after_state, deleted_at, deletes
from s where is_deleted""")
def cdc_state_with_deletes(lake):
    """M3: records whose last change is a soft delete — content kept, flag and
    time of the delete set, with the number of deletes they have seen."""
    log = parsed_log(lake)
    st = cdc.record_state(log).filter(F.col("is_deleted"))
    deletes = (log.filter(F.col("operation") == "DELETE")
                  .groupBy("source_table", "subsidiary_id", "record_id")
                  .agg(F.count(F.lit(1)).alias("deletes")))
    return st.join(deletes, ["source_table", "subsidiary_id", "record_id"], "left").select(
        "source_table", "subsidiary_id", "record_id", "after_state", "deleted_at",
        F.coalesce("deletes", F.lit(0)).alias("deletes"))
