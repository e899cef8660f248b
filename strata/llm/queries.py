"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import (attention_quality, exact_dedup, hard_negatives, language_id, mixing, near_dedup, packing, perspectives,
                        prefix_trie, pseudonyms, substring_dedup, topk, warc)
from strata.llm.util import table


TARGETS = {"high": 0.7, "low": 0.28, "toxic": 0.02}


def op1_mixing(spark, sf_dir):
    labels = mixing.quality_domains(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), labels, TARGETS)


PII_KEY = "strata-demo-key"  # a deployment passes its own secret


def op2_pii_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "n_pii", "text")


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


def op4_suffix_array_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_topk_search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), 5, 256.0, F.col("vec_id") % 50 == 0)


def op6_perspective_rotation(spark, sf_dir):
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op7_warc(spark, sf_dir):
    rows = warc.captures(spark, table(spark, sf_dir, "pages"))
    return rows.select("metadata.page_id", "response.payload_bytes", "response.payload_digest",
                       F.col("response.type").alias("record_type"), "refers_to")


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_components(table(spark, sf_dir, "documents"), words=2, threshold=0.8)


def op11_attention_quality(spark, sf_dir):
    return attention_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), is_anchor=F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_pii_pseudonyms, op3_exact_dedup, op4_suffix_array_dedup, op5_topk_search, op6_perspective_rotation, op7_warc,
    op8_best_fit_packing, op9_language_id, op10_minhash_near_dedup, op11_attention_quality, op12_prefix_trie, op13_hard_negatives)}

ORACLES = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op5_topk_search": topk.ORACLE,
    "op6_perspective_rotation": perspectives.ORACLE,
    "op7_warc": warc.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
