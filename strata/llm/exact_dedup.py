"""Exact de-duplication by content-defined chunk recipes (DataFrame functions only).

A text, with the six ASCII white-space characters removed, is cut where its own content
says so: a chunk ends at the first punctuation mark after ``MIN_CHUNK`` characters, or
after ``MAX_CHUNK`` where there is none. Every chunk gets a 128-bit identifier. The
identifiers are verified: chunks are de-duplicated by their whole text, once, and an
identifier that stands for two different chunks is found. A document's recipe is the
ordered list of its chunks' identifiers, and documents are equal when their recipes are;
long texts never move again. A document holding an identifier that failed verification
is also told apart by the SHA-256 of its whole text.

Skew: chunks are de-duplicated with map-side partial aggregation, groups are one
partial aggregate per task, and the join that brings a group's facts back to its rows
is an ordinary equi-join, which adaptive execution splits where a group is huge.

Defined cases: null text counts as empty, and all empty texts are one group. Of equal
texts the row with the most code points in its original text stays, then the smallest
``doc_id`` (null after every number). Rows that repeat the staying ``doc_id`` with an
equal text are all marked as kept and all count. Other columns take no part; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import cut, text_or_empty

WHITE = " \t\n\x0b\x0c\r"
MIN_CHUNK, MAX_CHUNK = 512, 2048
_CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[.,;:!?]|.{{1,{MAX_CHUNK}}}"


def _chunks(norm):
    return F.regexp_extract_all(norm, F.lit(_CHUNK), F.lit(0))


def recipes(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_cp (code points of the original), text_sha256 and recipe (two longs per chunk)."""
    norm = F.translate(text_or_empty(), WHITE, "")
    rows = docs.select("doc_id", *keep, F.length(text_or_empty()).alias("n_cp"), norm.alias("_norm"))
    return rows.select(
        "doc_id", *keep, "n_cp", F.sha2("_norm", 256).alias("text_sha256"),
        F.flatten(F.transform(_chunks(F.col("_norm")),
                              lambda c: F.array(F.xxhash64(c), F.xxhash64(F.lit(1), c)))).alias("recipe"))


def failed_identifiers(docs: DataFrame) -> DataFrame:
    """Identifiers (a, b) that stand for more than one chunk text; normally none."""
    chunk = docs.select(F.explode(_chunks(F.translate(text_or_empty(), WHITE, ""))).alias("chunk"))
    distinct = chunk.select(F.xxhash64("chunk").alias("a"), F.xxhash64(F.lit(1), "chunk").alias("b"), "chunk").distinct()
    return distinct.groupBy("a", "b").count().where("count > 1").select("a", "b")


def split_failed(rows: DataFrame, failed: DataFrame) -> DataFrame:
    """Adds ``extra``: null, or the text's SHA-256 where the recipe holds a failed identifier."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("recipe") - 2, F.lit(2)),
                        lambda i: F.struct(F.get("recipe", i).alias("a"), F.get("recipe", i + 1).alias("b")))
    used = rows.where(F.size("recipe") > 0).select("text_sha256", F.explode(pairs).alias("p"))
    bad = used.select("text_sha256", "p.a", "p.b").join(failed, ["a", "b"], "left_semi").select("text_sha256").distinct()
    bad = bad.withColumn("extra", F.col("text_sha256"))
    return rows.join(bad, "text_sha256", "left")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    rows = recipes(docs)
    failed = cut(failed_identifiers(docs), "failed-identifiers")
    rows = rows.withColumn("extra", F.lit(None).cast("string")) if failed.isEmpty() else split_failed(rows, failed)
    rows = rows.withColumn("extra", F.coalesce("extra", F.lit("")))
    best = F.min(F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("o"), F.col("doc_id").alias("id")))
    groups = rows.groupBy("recipe", "extra").agg(best.alias("best"), F.count("*").alias("group_size"))
    groups = groups.select("recipe", "extra", F.col("best.id").alias("keep_id"), "group_size")
    return rows.join(groups, ["recipe", "extra"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", (F.size("recipe") / 2).cast("int").alias("n_chunks"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows equal in doc_id and text one stays (of those that differ in
    other columns, any one)."""
    kept = exact_groups(docs).where("kept").groupBy("doc_id").agg(F.count("*").alias("c"), F.countDistinct("text_sha256").alias("d"))
    kept = cut(kept.select(F.col("doc_id").alias("_kept_id"), (F.col("c") > F.col("d")).alias("repeated")), "kept-ids")
    # The ids grow with the input: never broadcast, whatever the size.
    stay = lambda ids: docs.join(ids.hint("merge"), docs["doc_id"].eqNullSafe(ids["_kept_id"]), "left_semi")
    repeated = kept.where("repeated")
    if repeated.isEmpty():
        return stay(kept)
    # Repeats of one row are combined before they are shuffled.
    return stay(kept.where("not repeated")).unionByName(stay(repeated).dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
with t as (
  select doc_id, coalesce(text, '') as txt, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
g as (
  select norm, count(*) as group_size, arg_min(doc_id, (-length(txt), doc_id)) as keep_id from t group by norm)
select t.doc_id, g.keep_id, cast(g.group_size as bigint) as group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g using (norm)
"""
