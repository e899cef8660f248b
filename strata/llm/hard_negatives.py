"""Hard negatives by exact window search in multiway hyperplane trees with range tables.

Vectors become integers, floor(scale * x); a score is the integer inner product. A further coordinate sqrt(M^2 - |x|^2) puts
all rows on one sphere of radius M (the largest norm) while queries get 0 there, so d^2 = |q|^2 + M^2 - 2 * score: a score window is
an annulus of distances around the query.

1. ``PIVOTS`` hash-drawn rows split the space into regions (nearest pivot); a region is dealt at random into shards of about ``SHARD``
   rows, so neither a crowded region nor a common vector meets in one task. This is the only shuffle of the vectors.
2. A shard is one binary row with its tree, built once. A node has up to ``FAN`` split points; each row goes to the
   nearest, and the node stores for every split point i and subtree j the least and largest distance from i to the rows of j.
3. A search keeps, in a node, the subtrees whose ranges meet the window: with D = d(q, i), rows of j lie at least
   max(D - hi_ij, lo_ij - D) and at most D + hi_ij from q, for every i. Leaves (``LEAF`` rows) are compared exactly.
   The same test on whole regions comes before any vectors move.
4. Anchors are packed in blocks by region. A first round searches each block in the region nearest to it only; the kth
   scores found there bound the round over all regions that the windows meet. Positives (same label, no window) come
   first; each positive then gives one window of negatives (other labels, ``low`` to ``high`` percent of its score).

What the driver sees: pivots, and the ranges of at most ``PIVOTS`` regions to ``PIVOTS`` pivots.

Scores are exact: doubles below 2^53, 64-bit or Python integers beyond; a score outside 64 bits is an error.

Defined cases: rows with a null id or label, or a vector that is null, empty or holds a null or non-finite component, take no part.
Vectors meet those of their own dimension only. Rows that share the anchor's id are neither its positives nor its negatives;
rows that repeat an id are candidates, and anchors, of their own. Ties go to the smaller id. A positive of negative score has an
empty window. With fewer candidates all are returned; empty input gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.util import cut, dump, load, map_arrow

PIVOTS, SHARD, BLOCK, LEAF, FAN, SLOT = 32, 2048, 512, 96, 8, 8
LEAST = np.iinfo(np.int64).min  # no score
LAST = np.iinfo(np.int64).max  # no id


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


# --- geometry ---

def _lift(x: np.ndarray, radius: float) -> np.ndarray:
    """Rows with the coordinate that puts them on the sphere."""
    return np.column_stack((x, np.sqrt(np.maximum(radius * radius - (x * x).sum(1), 0.0))))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0.0))


def _annulus(base: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance at which a score is in [least, most]; ``base`` is |q|^2 + M^2."""
    inner = np.sqrt(np.maximum(base - 2 * most.astype(np.float64), 0))
    return inner, np.where(least == LEAST, np.inf, np.sqrt(np.maximum(base - 2 * least.astype(np.float64), 0)))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued doubles."""
    most = x.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if most < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    if most < 2.0 ** 62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    a, b = ([[int(v) for v in row] for row in m] for m in (q, x))
    out = [[sum(u * v for u, v in zip(r, s)) for s in b] for r in a]
    if any(abs(v) >= 2 ** 63 for r in out for v in r):
        raise OverflowError("an inner product is outside the 64-bit range")
    return np.array(out, np.int64).reshape(len(q), len(x))


# --- the tree of a shard ---

def _split_points(x: np.ndarray) -> np.ndarray:
    """Row numbers of up to ``FAN`` rows far from each other, out of evenly spaced candidates."""
    some = np.unique(np.linspace(0, len(x) - 1, min(len(x), 8 * FAN)).astype(np.int64))
    picked = [0]
    near = _distances(x[some], x[some[:1]])[:, 0]
    while len(picked) < FAN and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, _distances(x[some], x[some[picked[-1:]]])[:, 0])
        near[picked] = 0
    return some[picked]


def build(ids: np.ndarray, labels: np.ndarray, data: np.ndarray, radius: float, least: int = LEAF) -> dict[str, np.ndarray]:
    """The arrays of a tree: rows in leaf order, and per node its span, first child, fan, split points and ranges."""
    order = np.argsort(ids, kind="stable")
    lifted = _lift(data, radius)
    plain = not np.isfinite(4 * radius * radius)
    span, child, fan, points, low, high = [(0, len(ids))], [0], [0], [np.zeros((FAN, lifted.shape[1]))], [np.zeros((FAN, FAN))], [np.zeros((FAN, FAN))]
    todo = [0]
    while todo:
        me = todo.pop()
        s, e = span[me]
        if e - s <= least or plain:
            continue
        rows = order[s:e]
        x = lifted[rows]
        at = _split_points(x)
        if len(at) < 2:
            continue  # equal rows
        d = _distances(x, x[at])
        own = d.argmin(1)
        sizes = np.bincount(own, minlength=len(at))
        if sizes.max() == len(rows):
            continue
        order[s:e] = rows[np.argsort(own, kind="stable")]
        points[me][:len(at)] = x[at]
        child[me], fan[me] = len(span), len(at)
        for j in range(len(at)):
            mine = d[own == j]
            low[me][:len(at), j] = mine.min(0) if len(mine) else np.inf
            high[me][:len(at), j] = mine.max(0) if len(mine) else -np.inf
            todo.append(len(span))
            span.append((s, s + int(sizes[j])))
            s += int(sizes[j])
            child.append(0)
            fan.append(0)
            points.append(np.zeros_like(points[0]))
            low.append(np.zeros((FAN, FAN)))
            high.append(np.zeros((FAN, FAN)))
    inner = np.flatnonzero(fan)  # only inner nodes have tables
    table = np.full(len(fan), -1)
    table[inner] = np.arange(len(inner))
    return {"ids": ids[order], "labels": labels[order], "data": data[order], "radius": np.array([radius]), "span": np.array(span),
            "child": np.array(child), "fan": np.array(fan), "table": table, "points": np.array(points)[inner],
            "low": np.array(low)[inner], "high": np.array(high)[inner]}


class Items:
    """Searches over queries: per item the row of its query, and the window [least, most] of scores still of use.
    ``score`` and ``id`` hold the k best so far, best first; a full list raises ``least``."""

    def __init__(self, row: np.ndarray, least: np.ndarray, most: np.ndarray, k: int):
        self.row, self.k = row, k
        self.least, self.most = least.astype(np.int64), most.astype(np.int64)
        self.score = np.full((len(row), k), LEAST)
        self.id = np.full((len(row), k), LAST)


def search(tree: dict, queries: np.ndarray, qids: np.ndarray, qlabels: np.ndarray, items: Items, same: bool) -> dict[str, int]:
    """Raises ``items`` by the rows of the tree whose label is the query's (``same``) or another. Returns counts of work."""
    radius = float(tree["radius"][0])
    lifted = np.column_stack((queries, np.zeros(len(queries))))
    norms = (queries * queries).sum(1)
    slack = 1e-6 * (radius + np.sqrt(norms)) + 1e-9
    work = {"rows": 0, "subtrees": 0, "pruned": 0}

    def visit(node: int, live: np.ndarray):
        fan = int(tree["fan"][node])
        if not fan:
            return leaf(node, live)
        t = tree["table"][node]
        rows, at = np.unique(items.row[live], return_inverse=True)
        d = _distances(lifted[rows], tree["points"][t][:fan])
        lo, hi = tree["low"][t][:fan, :fan], tree["high"][t][:fan, :fan]
        nearest = np.maximum(d[:, :, None] - hi[None], lo[None] - d[:, :, None]).max(1)[at]
        farthest = (d[:, :, None] + hi[None]).min(1)[at]
        for j in np.argsort(d.mean(0), kind="stable"):
            inner, outer = annulus(live)
            keep = (nearest[:, j] <= outer + slack[items.row[live]]) & (farthest[:, j] >= inner - slack[items.row[live]])
            work["subtrees"] += len(live)
            work["pruned"] += int(len(live) - keep.sum())
            if keep.any():
                visit(int(tree["child"][node]) + int(j), live[keep])

    def annulus(live):
        return _annulus(norms[items.row[live]] + radius * radius, items.least[live], items.most[live])

    def leaf(node: int, live: np.ndarray):
        s, e = tree["span"][node]
        ids, labels = tree["ids"][s:e], tree["labels"][s:e]
        work["rows"] += len(live) * int(e - s)
        rows, at = np.unique(items.row[live], return_inverse=True)
        found = exact_scores(queries[rows], tree["data"][s:e])
        fits = (labels[None, :] == qlabels[rows][:, None]) == same
        fits &= ids[None, :] != qids[rows][:, None]
        found, fits = found[at], fits[at]
        fits &= (found >= items.least[live][:, None]) & (found <= items.most[live][:, None])
        hit = np.flatnonzero(fits.any(1))
        if not len(hit):
            return
        who = live[hit]
        found = np.where(fits[hit], found[hit], LEAST)
        best = np.argsort(~found, axis=1, kind="stable")[:, :items.k]
        if found.shape[1] > items.k:
            kth = np.take_along_axis(found, best[:, -1:], 1)
            tied = (found == kth).sum(1) > 1
            for i in np.flatnonzero(tied):  # ties at the kth place: by id
                best[i] = np.lexsort((ids, ~found[i]))[:items.k]
        score = np.concatenate((items.score[who], np.take_along_axis(found, best, 1)), 1)
        vec = np.concatenate((items.id[who], np.where(np.take_along_axis(found, best, 1) == LEAST, LAST, ids[best])), 1)
        order = np.lexsort((vec, ~score), axis=1)[:, :items.k]
        items.score[who], items.id[who] = np.take_along_axis(score, order, 1), np.take_along_axis(vec, order, 1)
        items.least[who] = np.maximum(items.least[who], items.score[who, -1])

    if len(items.row):
        visit(0, np.flatnonzero(items.least <= items.most))
    return work


# --- tables ---

def _usable(rows: DataFrame, scale: float) -> DataFrame:
    """id, label, anchor, dim, norm2 and data (integers as doubles) of the usable rows."""
    schema = "id long, label long, anchor int, dim int, norm2 double, data binary"

    def run(batches):
        for b in batches:
            out = []
            for i, label, anchor, v in zip(*(c.to_pylist() for c in b.columns)):
                if i is None or label is None or not v or None in v:
                    continue
                x = np.floor(np.array(v, np.float64) * scale)
                if np.isfinite(x).all():
                    out.append((i, label, int(bool(anchor)), len(v), float((x * x).sum()), x.tobytes()))
            yield _batch(out, schema)

    return map_arrow(rows, run, schema)


def _regions(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the region, the nearest pivot of the row's dimension (0 where that has none)."""
    schema = "id long, label long, anchor int, dim int, norm2 double, data binary, region int"

    def run(batches):
        for b in batches:
            dims = b.column(3).to_numpy()
            data = b.column(5).to_pylist()
            region = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                if int(dim) in pivots:
                    at = np.flatnonzero(dims == dim)
                    x = np.frombuffer(b"".join(data[i] for i in at), np.float64).reshape(len(at), dim)
                    region[at] = _distances(x, pivots[int(dim)]).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region)], [*b.schema.names, "region"])

    return map_arrow(rows, run, schema)


def _packed(rows: DataFrame, size: int, make, schema: str) -> DataFrame:
    """Rows of one (dim, region, sub) in runs of at most 2 * ``size``, each turned into one row by ``make``."""
    key = ["dim", "region", "sub"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*key, "id", "label", "data").repartition(n, *key).sortWithinPartitions(*key)

    def run(batches):
        now, held = None, []

        def flush():
            if held:
                ids, labels = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
                data = np.frombuffer(b"".join(h[2] for h in held), np.float64).reshape(len(held), now[0])
                yield _batch([make(now, ids, labels, data)], schema)
                held.clear()

        for b in batches:
            for dim, region, sub, i, label, data in zip(*(c.to_pylist() for c in b.columns)):
                if (dim, region, sub) != now or len(held) == 2 * size:
                    yield from flush()
                    now = (dim, region, sub)
                held.append((i, label, data))
        yield from flush()

    return map_arrow(rows, run, schema)


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """Adds sub: a region's rows dealt at random to as many parts as it takes for ``size`` rows each."""
    counts = rows.groupBy("dim", "region").agg(F.ceil(F.count("*") / size).alias("parts"))
    rows = rows.withColumn("_at", F.xxhash64(F.monotonically_increasing_id()))
    return rows.join(F.broadcast(counts), ["dim", "region"]).withColumn("sub", F.pmod("_at", "parts").cast("int"))


class Space:
    """Pivots, radius and region ranges, by dimension: at most ``PIVOTS`` regions with ``PIVOTS`` ranges each."""

    def __init__(self, pivots, radius, ranges, slots):
        self.pivots, self.radius, self.ranges, self.slots = pivots, radius, ranges, slots

    def lifted(self, dim: int) -> np.ndarray:
        return _lift(self.pivots[dim], self.radius[dim])


def index(rows: DataFrame, size: int = SHARD, block_size: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, Space]:
    """Shards (dim, region, slot, tree) and anchor blocks (block, dim, payload) of prepared rows."""
    drawn = rows.select("dim", "data").orderBy(F.xxhash64("id", "data"), "id", "data").limit(PIVOTS).collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in drawn}:
        pivots[dim] = np.unique(np.array([np.frombuffer(r["data"], np.float64) for r in drawn if r["dim"] == dim]), axis=0)
    rows = cut(_regions(rows, pivots), "hn-regions")
    # One row per dimension and region; the dimensions of a table are few, as vectors of others never meet.
    facts = rows.groupBy("dim", "region").agg(F.count("*").alias("n"), F.max("norm2").alias("norm2")).collect()
    radius: dict[int, float] = {}
    for r in facts:
        radius[r["dim"]] = max(radius.get(r["dim"], 0.0), float(np.sqrt(r["norm2"])))
        pivots.setdefault(r["dim"], np.zeros((1, r["dim"])))
    slots = {(r["dim"], r["region"]): (-(-r["n"] // size) - 1) // SLOT + 1 for r in facts}

    def shard(key, ids, labels, data):
        dim = key[0]
        d = _distances(_lift(data, radius[dim]), _lift(pivots[dim], radius[dim]))
        return (dim, key[1], key[2] // SLOT, d.min(0).tolist(), d.max(0).tolist(), dump(build(ids, labels, data, radius[dim], leaf)))

    shards = cut(_packed(_dealt(rows, size), size, shard, "dim int, region int, slot int, lo array<double>, hi array<double>, tree binary"),
                 "hn-shards")
    got = shards.select("dim", "region", F.posexplode(F.arrays_zip("lo", "hi")).alias("p", "x")).groupBy("dim", "region", "p").agg(
        F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi")).collect()  # at most PIVOTS * PIVOTS rows a dimension
    ranges: dict[tuple[int, int], np.ndarray] = {}
    for r in got:
        ranges.setdefault((r["dim"], r["region"]), np.zeros((2, len(pivots[r["dim"]]))))[:, r["p"]] = r["lo"], r["hi"]

    def block(key, ids, labels, data):
        return (key[0], key[1], dump({"ids": ids, "labels": labels, "data": data}))

    anchors = rows.where("anchor = 1")
    blocks = _packed(_dealt(anchors, block_size), block_size, block, "dim int, region int, queries binary")
    blocks = cut(blocks.select(F.monotonically_increasing_id().alias("block"), "dim", F.col("region").alias("home"), "queries"), "hn-blocks")
    return shards, blocks, Space(pivots, radius, ranges, slots)


FOUND = "block long, item long, score long, vec_id long"


def _items(r: dict, queries: dict, k: int) -> Items:
    """The items of a payload row: those of ``windows`` (row, least, most), or one per query without a window."""
    if r["windows"] is None:
        n = len(queries["ids"])
        return Items(np.arange(n), np.full(n, LEAST), np.full(n, LAST), k)
    w = np.frombuffer(r["windows"], np.int64).reshape(-1, 3)
    return Items(w[:, 0].copy(), w[:, 1], w[:, 2], k)


def _targets(blocks: DataFrame, space: Space, seed: bool) -> DataFrame:
    """(block, dim, region, slot, queries, windows): the regions that the windows of a block's items meet; as a seed, only the first slot of the
    block's own region."""
    schema = "block long, dim int, region int, slot int, queries binary, windows binary"

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                dim, out = r["dim"], []
                if seed:
                    out = [(r["block"], dim, r["home"], 0, r["queries"], r["windows"])]
                else:
                    q = load(r["queries"])
                    items = _items(r, q, 1)
                    radius, norms = space.radius[dim], (q["data"] ** 2).sum(1)
                    d = _distances(np.column_stack((q["data"], np.zeros(len(norms)))), space.lifted(dim))[items.row]
                    base, slack = norms[items.row] + radius ** 2, 1e-6 * (radius + np.sqrt(norms[items.row])) + 1e-9
                    with np.errstate(invalid="ignore", over="ignore"):
                        inner, outer = _annulus(base, items.least, items.most)
                        inner, outer = inner - slack, outer + slack
                        for (of, region), (lo, hi) in sorted(space.ranges.items()):
                            if of == dim:
                                far = (np.maximum(d - hi, lo - d).max(1) > outer) | ((d + hi).min(1) < inner)
                                if not (far | (items.least > items.most)).all():
                                    out += [(r["block"], dim, region, s, r["queries"], r["windows"]) for s in range(space.slots[dim, region])]
                yield _batch(out, schema)

    return map_arrow(blocks.select("block", "dim", "home", "queries", "windows"), run, schema)


def _searched(blocks: DataFrame, shards: DataFrame, space: Space, k: int, same: bool, seed: bool = False) -> DataFrame:
    """FOUND rows, k or fewer per item, slot and block, of blocks (block, dim, home, queries, windows)."""
    targets = _targets(blocks, space, seed)
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["dim", "region", "slot"]
    # A slot holds SLOT shards or so; every block that needs it meets each of them, the shards themselves move once.
    pairs = targets.repartition(n, *key).join(shards.select(*key, "tree").repartition(n, *key), key)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                q = load(r["queries"])
                items = _items(r, q, k)
                search(load(r["tree"]), q["data"], q["ids"], q["labels"], items, same)
                i, j = np.nonzero(items.score != LEAST)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), r["block"], np.int64)), pa.array(i.astype(np.int64)),
                                                  pa.array(items.score[i, j]), pa.array(items.id[i, j])], ["block", "item", "score", "vec_id"])

    return map_arrow(pairs.select("block", "queries", "windows", "tree"), run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """Per (block, item) its k best FOUND rows as an array x of (s, vec_id), s the negated score."""
    first = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return best.groupBy("block", "item").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("x"))


def _windows(blocks: DataFrame, found: DataFrame, k: int, same: bool) -> DataFrame:
    """Blocks whose items' windows begin at the kth score found."""
    kth = _best(found, k).where(F.size("x") == k).groupBy("block").agg(
        F.collect_list(F.struct("item", (-F.element_at("x", k)["s"]).alias("score"))).alias("kth"))
    rows = blocks.join(kth, "block", "left").select("block", "dim", "home", "queries", "windows", "kth")
    schema = "block long, dim int, home int, queries binary, windows binary"

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                items = _items(r, load(r["queries"]), k)
                for x in r["kth"] or []:
                    items.least[x["item"]] = max(items.least[x["item"]], x["score"])
                out.append((r["block"], r["dim"], r["home"], r["queries"], np.column_stack((items.row, items.least, items.most)).astype(np.int64).tobytes()))
            yield _batch(out, schema)

    return map_arrow(rows, run, schema)


def _two_rounds(blocks: DataFrame, shards: DataFrame, space: Space, k: int, same: bool) -> DataFrame:
    """Per (block, item) the k best, as ``_best``."""
    bounded = cut(_windows(blocks, _searched(blocks, shards, space, k, same, seed=True), k, same), "hn-bounded")
    return _best(_searched(bounded, shards, space, k, same), k)


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, is_anchor=None,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``is_anchor`` holds (all by default)."""
    anchor = F.lit(True) if is_anchor is None else is_anchor
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.coalesce(anchor, F.lit(False)).cast("int").alias("anchor"), F.col(vector_col).alias("v"))
    shards, blocks, space = index(cut(_usable(rows, scale), "hn-rows"), **sizes)
    blocks = blocks.withColumn("windows", F.lit(None).cast("binary"))
    best = _two_rounds(blocks, shards, space, positives, True)
    lists = best.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("item", "x"))).alias("found"))
    schema = "block long, dim int, home int, queries binary, windows binary, anchors binary"

    def windows(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                q = load(r["queries"])
                w, names = [], []
                for f in r["found"]:
                    for x in f["x"]:
                        score = -x["s"]
                        w.append((f["item"], -(-low * score // 100), high * score // 100))
                        names.append((int(q["ids"][f["item"]]), x["vec_id"], score))
                out.append((r["block"], r["dim"], r["home"], r["queries"], np.array(w, np.int64).tobytes(), np.array(names, np.int64).tobytes()))
            yield _batch(out, schema)

    wanted = cut(map_arrow(blocks.join(lists, "block").select("block", "dim", "home", "queries", "found"), windows, schema), "hn-windows")
    found = _two_rounds(wanted.drop("anchors"), shards, space, negatives, False)
    names = "block long, item long, anchor_id long, positive_id long, positive_score long"

    def named(batches):
        for b in batches:
            for block, data in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(data, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), block, np.int64)), pa.array(np.arange(len(x))),
                                                  *(pa.array(x[:, k].copy()) for k in range(3))], names.replace(" long", "").split(", "))

    out = found.join(map_arrow(wanted.select("block", "anchors"), named, names), ["block", "item"])
    out = out.select("anchor_id", "positive_id", "positive_score", F.posexplode("x").alias("at", "x"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("negative_id"),
                      "positive_score", (-F.col("x.s")).alias("negative_score"))


ORACLE = """
with v as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.r, a.vec_id as anchor_id, c.vec_id, c.r as cr, a.label = c.label as same,
         cast(list_sum([a.e[i] * c.e[i] for i in range(1, len(a.e) + 1)]) as bigint) as score
  from v a join v c on c.vec_id <> a.vec_id and len(c.e) = len(a.e) where a.vec_id % 50 = 0),
p as (
  select r, anchor_id, vec_id as positive_id, score as positive_score, k from (
    select *, row_number() over (partition by r order by score desc, vec_id, cr) as k from s where same) where k <= 5)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from (
  select p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.r, k order by s.score desc, s.vec_id, s.cr) as rank
  from p join s on p.r = s.r and not s.same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
where rank <= 3
"""
