"""Multi-party perspective rotation of dialogues (DataFrame functions only).

Every participant of a conversation (every role but the ``system`` one) gets the dialogue
from their own seat: their turns are the assistant's, every other participant is a named
user, and only their own turns are trained on. One row per conversation, speaker and part:
conv_id, speaker, part, n_turns, text, spans (trained stretches ``start-end`` of the text in
code points, end exclusive, joined by ``;``), n_trained.

Parts bound what meets in one row: part ``p`` holds the turns numbered p * TURNS_PER_PART up to the
next multiple, so an endless conversation becomes many rows of bounded size, in order. Rows
beyond that bound (shared or missing turn numbers) go to further slices in the order of turn, role and text:
``slice`` is floor(rank / TURNS_PER_PART). All turns are rendered. Turns of a part are put together once, before speakers multiply
the rows, and the roster of a conversation is a partial aggregate.

Defined cases: null text is empty; a null role is the participant ``unknown``; rows without a
conv_id form the conversation null; turns without a number come in part -1, and within
equal numbers the order is role, then text. Exactly repeated rows are rendered as often as they
occur. A speaker of other parts still gets a row for a part they are silent in (no spans). A
conversation of system turns only has no participant and gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.util import cut

TURNS_PER_PART = 256
SYSTEM = "system"
OPEN, SEP, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def _slices(rows: DataFrame, key: list[str], turn: list[str]) -> DataFrame:
    """Oversized parts in ordered slices. Equal rows are counted first; what is left is numbered in sub-ranges, each with
    the count of those before it, so neither a long part nor a repeated row meets in one task."""
    rows = rows.groupBy(*key, *turn).agg(F.count("*").alias("n"))
    rows = cut(rows.repartitionByRange(*key, *turn).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*key, "range").agg(F.sum("n").alias("m")).withColumn("offset", F.coalesce(F.sum("m").over(before), F.lit(0)))
    ranges = ranges.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("range").alias("_g"), "offset")
    rows = rows.join(ranges, rows["conv_id"].eqNullSafe(ranges["_c"]) & (rows["part"] == ranges["_p"]) & (rows["range"] == ranges["_g"]))
    within = Window.partitionBy(*key, "range").orderBy(*turn).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("a", F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0))).withColumn("b", F.col("a") + F.col("n"))
    size = F.lit(TURNS_PER_PART)
    rows = rows.withColumn("slice", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size))))
    here = F.least("b", (F.col("slice") + 1) * size) - F.greatest("a", F.col("slice") * size)
    lists = rows.groupBy(*key, F.col("slice").cast("int").alias("slice")).agg(
        F.sort_array(F.collect_list(F.struct(*turn, here.cast("int").alias("n")))).alias("turns"))
    return lists.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(F.struct(*[t[c].alias(c) for c in turn]), t["n"]))))


def rotate(turns: DataFrame) -> DataFrame:
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / TURNS_PER_PART), F.lit(-1)).cast("long").alias("part"))
    key = ["conv_id", "part"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > TURNS_PER_PART)
    sizes = sizes.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"))
    over = rows["conv_id"].eqNullSafe(sizes["_c"]) & (rows["part"] == sizes["_p"])
    roster = rows.where(F.col("role") != SYSTEM).groupBy("conv_id").agg(F.collect_set("role").alias("roster"))
    roster = roster.select(F.col("conv_id").alias("_r"), "roster")
    turn = ["turn", "role", "text"]
    parts = rows.join(sizes, over, "left_anti").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*turn))).alias("turns"))
    parts = parts.select(*key, F.lit(0).alias("slice"), "turns").unionByName(_slices(rows.join(sizes, over, "left_semi"), key, turn))
    seats = parts.join(roster, parts["conv_id"].eqNullSafe(roster["_r"])).select(
        *key, "slice", "turns", F.explode("roster").alias("speaker"))

    def named(t):
        return (F.when(t["role"] == SYSTEM, F.lit("system")).when(t["role"] == F.col("speaker"), F.lit("assistant"))
                .otherwise(F.concat(F.lit("user name="), t["role"])))

    def piece(t):
        head = F.concat(F.lit(OPEN), named(t), F.lit(SEP))
        return F.struct(F.concat(head, t["text"], F.lit(CLOSE)).alias("s"), F.length(head).alias("head"),
                        F.length(t["text"]).alias("body"), ((t["role"] == F.col("speaker")) & (t["role"] != SYSTEM)).alias("own"))

    seats = seats.withColumn("pieces", F.transform("turns", piece))
    start = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, p):
        a = acc["at"] + p["head"]
        b = a + p["body"]
        span = F.concat(a.cast("string"), F.lit("-"), b.cast("string"))
        return F.struct((b + len(CLOSE)).alias("at"),
                        F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("pieces", start, step)["spans"]
    return seats.select(
        "conv_id", "speaker", "part", "slice", F.size("turns").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("text"),
        F.array_join(spans, ";").alias("spans"),
        F.size(F.filter("pieces", lambda p: p["own"])).alias("n_trained"))


ORACLE = r"""
with r as (
  select conv_id, cast(turn as bigint) as turn, coalesce(role, 'unknown') as role, coalesce(text, '') as txt,
         coalesce(cast(floor(turn / 256) as bigint), -1) as part from conversations),
seat as (select distinct conv_id, role as speaker from r where role <> 'system'),
p as (
  select r.*, speaker, row_number() over (partition by r.conv_id, speaker, part order by turn nulls first, r.role, txt) - 1 as k,
         '<|' || case when r.role = 'system' then 'system' when r.role = speaker then 'assistant'
                      else 'user name=' || r.role end || '|>' || chr(10) as head,
         r.role = speaker as own
  from r join seat on r.conv_id is not distinct from seat.conv_id),
o as (
  select *, k // 256 as slice, coalesce(sum(length(head) + length(txt) + 9) over (partition by conv_id, speaker, part, k // 256 order by k
              rows between unbounded preceding and 1 preceding), 0) + length(head) as a from p)
select conv_id, speaker, part, cast(slice as integer) as slice, cast(count(*) as integer) as n_turns,
       string_agg(head || txt || chr(10) || '<|end|>' || chr(10), '' order by k) as text,
       coalesce(string_agg(cast(a as bigint) || '-' || cast(a + length(txt) as bigint), ';' order by k) filter (where own), '') as spans,
       cast(count(*) filter (where own) as integer) as n_trained
from o group by conv_id, speaker, part, slice
"""
