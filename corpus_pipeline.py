"""From raw documents to packed training sequences, in five stages.

Each stage is one operator of ``strata.llm``. It takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last one returns packed pieces. Stages are written to the shared folder and read again, so
each works on all that its predecessor kept.

1. language_id: documents without a letter, or unlike every learned language, go.
2. exact_dedup: of equal texts one stays.
3. near_dedup: of each group of near-duplicates (five-word shingles, similarity 0.8) one stays.
4. mixing: documents are repeated or dropped at the fitted rates. Documents that do not look most like toxic ones keep a
   rate of one or more, whatever share they have; toxic ones fall towards none.
5. packing: what is left is packed into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, language_id, mixing, near_dedup, packing
from strata.llm.util import cut, table

WEIGHTS, BUDGET_SHARE, MAX_RATE = {"high": 0.87, "low": 0.11, "toxic": 0.02}, 1.3, 8.0


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    refs = language_id.fit(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    return language_id.known_language(docs, refs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, words=5, threshold=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.quality_domains(table(spark, sf_dir, "labels"))
    return mixing.remix(docs, labels, WEIGHTS, BUDGET_SHARE, MAX_RATE, falling=("toxic",))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Stages 1 and 4 learn models and stage 5 solves a packing problem: not expressible in SQL. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
