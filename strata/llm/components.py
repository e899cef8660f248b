"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import cut


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links`` (a, b: longs) and in ``labels``,
    which may hold (id, component) of an earlier call over other links.

    In a round every root moves to the smallest root it is linked with, and once more to where that one moved;
    links are rewritten to the new roots and those within one root go. At least one end of each link moves, so the
    links shrink geometrically. Moves are aggregates with a map-side part, rewriting is equi-joins; rounds are cut."""
    edges = links.where("a <> b").select("a", "b").distinct()
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    if labels is None:
        labels = ids.withColumn("component", F.col("id"))
    else:
        labels = cut(labels.union(ids.join(labels, "id", "left_anti").withColumn("component", F.col("id"))), "labels")
        edges = _moved(edges, labels.withColumnRenamed("component", "to"))
    edges = cut(edges, "edges")
    while not edges.isEmpty():
        least = edges.union(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
        least = cut(least.select(F.col("a").alias("id"), F.least("a", "m").alias("to")), "least")
        next_ = least.select(F.col("id").alias("to"), F.col("to").alias("further"))
        jump = cut(least.join(next_, "to", "left").select("id", F.coalesce("further", "to").alias("to")), "jump")
        labels = labels.join(jump.select(F.col("id").alias("component"), "to"), "component", "left").select(
            "id", F.coalesce("to", "component").alias("component"))
        edges = cut(_moved(edges, jump), "edges")
    return cut(labels, "labels")


def _moved(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Links between the new places (id -> to) of their ends, each once."""
    a, b = moves.select(F.col("id").alias("a"), F.col("to").alias("x")), moves.select(F.col("id").alias("b"), F.col("to").alias("y"))
    return edges.join(a, "a").join(b, "b").where("x <> y").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
