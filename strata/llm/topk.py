"""Exact top-k inner-product search with a KD-tree per shard.

Vectors become integers, floor(scale * x). A shard is a run of ``SHARD`` rows of one input
partition, packed into one binary row; no vector is shuffled to form it. Queries are packed
the same way into blocks, and every block meets every shard through an equi-join on the block
number (a stated query set against all rows, in blocks). Shard and block rows are bounded in size.

A task builds the shard's KD-tree by median splits on the widest side, each node with its tight
bounding box. The bound of a box for query q is sum(max(q_i * lo_i, q_i * hi_i)); from the root
down, a query keeps the nodes whose bound reaches its kth score so far, then visits the
leaves best bound first and stops at the first that falls short. The kth score propagates: a first
round searches each block in one shard only, which gives a valid lower bound for the search
of all shards, and within a task it rises from shard to shard.

Scores are whole numbers. They are computed in double precision while dimension * max|v|^2 stays
below 2^53, and as Python integers beyond that, so they are always exact; a score outside the
64-bit range is an error.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part, nor do rows
without an id. Queries are compared with vectors of their own dimension only. Candidates that share the query's
id are not its candidates. Rows that repeat an id are candidates (and queries) of their own; ties go to the smaller
id. With fewer than k candidates all are returned; empty input gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.util import cut, map_arrow

SHARD, BLOCK, LEAF = 4096, 1024, 128
PACKED = "dim int, n int, ids binary, data binary"


def _integers(vectors: list, scale: float):
    """Row numbers and integer matrices by dimension of the usable vectors."""
    by: dict[int, tuple[list[int], list]] = {}
    for i, v in enumerate(vectors):
        if v and None not in v:
            x = np.floor(np.array(v, np.float64) * scale)
            if np.isfinite(x).all():
                rows, data = by.setdefault(len(v), ([], []))
                rows.append(i)
                data.append(x)
    return by


def pack(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows (id, vector) as bounded binary rows: dim, n, ids, data."""
    def run(batches):
        held: dict[int, tuple[list, list]] = {}

        def out(dim):
            ids, data = held.pop(dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()),
                 pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(data, np.float64).tobytes()], pa.binary())], ["dim", "n", "ids", "data"])

        for b in batches:
            ids, vectors = b.column(0).to_pylist(), b.column(1).to_pylist()
            for dim, (which, data) in _integers([None if i is None else v for i, v in zip(ids, vectors)], scale).items():
                for i, x in zip(which, data):
                    mine = held.setdefault(dim, ([], []))
                    mine[0].append(ids[i])
                    mine[1].append(x)
                    if len(mine[0]) == size:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return map_arrow(rows, run, PACKED)


class Tree:
    """KD-tree over integer rows: median splits on the widest side, tight boxes."""

    def __init__(self, data: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.lo, self.hi, self.kids, self.span = [], [], [], []
        stack = [(0, len(ids), None)]
        while stack:
            s, e, parent = stack.pop()
            box = data[order[s:e]]
            lo, hi = box.min(0), box.max(0)
            me = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.kids.append([])
            self.span.append((s, e))
            if parent is not None:
                self.kids[parent].append(me)
            side = int(np.argmax(hi - lo))
            if e - s > leaf and hi[side] > lo[side]:
                mid = (e - s) // 2
                order[s:e] = order[s:e][np.argpartition(box[:, side], mid)]
                stack += [(s, s + mid, me), (s + mid, e, me)]
        self.data, self.ids = data[order], ids[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.leaves = np.array([i for i, k in enumerate(self.kids) if not k])


def search(tree: Tree, queries: np.ndarray, qids: np.ndarray, k: int, kth: np.ndarray):
    """Per query the (score, id) pairs that may be among its k best, best first. ``kth`` holds a
    lower bound of each query's kth score and is raised in place."""
    best: list[list] = [[] for _ in qids]
    exact = tree.data.shape[1] * float(max(np.abs(tree.data).max(initial=0), np.abs(queries).max(initial=0))) ** 2 < 2.0 ** 53
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ tree.hi.T + down @ tree.lo.T
    if not exact:  # doubles round here: never prune
        bounds[:] = np.inf
    alive = np.zeros(bounds.shape, bool)
    alive[:, 0] = True
    for node, kids in enumerate(tree.kids):  # parents come before their children
        alive[:, node] &= bounds[:, node] >= kth
        for c in kids:
            alive[:, c] = alive[:, node]
    leaf_bounds = np.where(alive[:, tree.leaves], bounds[:, tree.leaves], -np.inf)
    order = np.argsort(-leaf_bounds, axis=1, kind="stable")
    active = np.arange(len(qids))
    for step in range(len(tree.leaves)):
        b = leaf_bounds[active, order[active, step]]
        active = active[(b >= kth[active]) & (b > -np.inf)]
        if not len(active):
            break
        at = order[active, step]
        for leaf in np.unique(at):
            who = active[at == leaf]
            s, e = tree.span[tree.leaves[leaf]]
            ids = tree.ids[s:e]
            if exact:
                scores = queries[who] @ tree.data[s:e].T
            else:
                big = [[int(x) for x in r] for r in tree.data[s:e]]
                scores = np.array([[sum(a * c for a, c in zip(map(int, q), r)) for r in big] for q in queries[who]], object)
            ok = (ids[None, :] != qids[who][:, None]) & (scores >= kth[who][:, None])
            for j, q in enumerate(who):
                hit = np.flatnonzero(ok[j])
                if len(hit):
                    if len(hit) > k:
                        hit = hit[np.lexsort((ids[hit], -scores[j, hit]))[:k]]
                    merged = sorted(best[q] + [(-int(scores[j, h]), int(ids[h])) for h in hit])[:k]
                    best[q] = merged
                    if len(merged) == k and exact:  # beyond 2^53 a double is no safe bound
                        kth[q] = max(kth[q], -merged[-1][0])
    return best


FOUND = "query_block long, query_row int, query_id long, vec_id long, score long"


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Rows (block, bounds, q_dim, q_ids, q_data, dim, n, ids, data) to FOUND rows."""
    def run(batches):
        state: dict[int, np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                qids = np.frombuffer(r["q_ids"], np.int64)
                queries = np.frombuffer(r["q_data"], np.float64).reshape(-1, r["dim"])
                given = np.frombuffer(r["bounds"], np.float64) if r["bounds"] else np.full(len(qids), -np.inf)
                kth = np.maximum(given, state.get(r["block"], given))
                if len(state) > 64:
                    state.clear()
                tree = Tree(np.frombuffer(r["data"], np.float64).reshape(-1, r["dim"]), np.frombuffer(r["ids"], np.int64))
                found = search(tree, queries, qids, k, kth)
                state[r["block"]] = kth
                rows = [(r["block"], i, int(qids[i]), v, -s) for i, hits in enumerate(found) for s, v in hits]
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(cols, [pa.int64(), pa.int32(), *[pa.int64()] * 3])],
                    ["query_block", "query_row", "query_id", "vec_id", "score"])

    return map_arrow(pairs.select("block", "bounds", "q_ids", "q_data", "dim", "ids", "data"), run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_block", "query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _bounds(found: DataFrame) -> DataFrame:
    """query_block and, as binary doubles by row, each query's kth score (-inf where there were fewer)."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                out = np.full(r["n"], -np.inf)
                for x in r["kth"]:
                    out[x["query_row"]] = x["score"]
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]], pa.int64()), pa.array([out.tobytes()], pa.binary())],
                                                 ["block", "bounds"])
    return map_arrow(found, run, "block long, bounds binary")


def top_k(vectors: DataFrame, k: int = 5, scale: float = 256.0, is_query=None, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row for which ``is_query`` holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    chosen = rows.where(is_query if is_query is not None else F.lit(True)) if is_query is None else \
        vectors.where(is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    shards = cut(pack(rows, SHARD, scale).withColumn("shard", F.monotonically_increasing_id()), "shards")
    blocks = pack(chosen.repartition(max(1, -(-chosen.count() // BLOCK))), BLOCK, scale)
    blocks = cut(blocks.select(F.monotonically_increasing_id().alias("block"), F.col("dim").alias("q_dim"),
                               F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "blocks")
    numbers = blocks.select("block", "q_dim", "q_n")
    dims = numbers.groupBy(F.col("q_dim").alias("dim")).agg(F.collect_list("block").alias("block"))
    dealt = shards.join(dims, "dim").withColumn("block", F.explode("block"))

    first = shards.groupBy("dim").agg(F.min("shard").alias("shard"))
    seeds = dealt.join(first, ["dim", "shard"], "left_semi").join(blocks, "block").withColumn("bounds", F.lit(None).cast("binary"))
    seeds = _best(_searched(seeds, k), k).where(F.col("rank") == k)
    kth = seeds.groupBy(F.col("query_block").alias("block")).agg(F.collect_list(F.struct("query_row", "score")).alias("kth"))
    kth = _bounds(numbers.join(kth, "block", "left").select(
        "block", F.col("q_n").alias("n"), F.coalesce("kth", F.array().cast("array<struct<query_row:int,score:bigint>>")).alias("kth")))
    pairs = dealt.join(blocks, "block").join(kth, "block")
    n = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    found = _searched(pairs.repartition(n, "block", "shard"), k)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)]) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""
