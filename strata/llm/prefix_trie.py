"""Trie of conversation prefixes from sorted conversations, their LCPs and sparse-table range minima.

Distinct conversations are sorted as sequences of turns; B[i] is the number of turns that neighbours i - 1 and i share. The members of
a prefix (i, d), the first d turns of conversation i, are the run around i in which no B falls below d. Each
candidate prefix finds the left and the right end of its run by binary search on a sparse table of range minima of B,
independently of all others and without any stack. The candidates (i, B[i]) and (i, length of i) are all the nodes where the trie
branches or a conversation ends; between two of them runs do not change, so the depths between get theirs by a join.

1. Turns are numbered by a range sort on (conv_id, turn, role, text): a range numbers its own rows, and only a conversation
   that goes on in a further range gets an offset. A turn becomes a 128-bit digest and its number of words; texts move once.
2. Conversations are cut into segments of ``SEG`` turns, each with the digest of all before it. Equal conversations become one
   class with a count, by map-side combined aggregation. The sort key of a class holds the turns of those segments only in which
   conversations that agree up to there part or end, so a long conversation has a short key, and neighbours still part
   where the whole sequences do.
3. Classes are range-sorted by key and packed in shards of at most ``group`` classes. A shard sees the neighbouring classes of the
   next shards, and finds the runs within it. For runs that leave it, it returns sums up to its ends as step functions of the depth;
   the same search over one pair of minima per shard (56 bytes for each ``group`` classes are sent out) finds the shards where such a run
   starts and ends.
4. Members, leaves and saved tokens of a run are differences of prefix sums: with X_i = n_i T_i - (T_i - C_i(B[i])), T the words of a
   conversation, C(d) those of its first d turns and n_i its copies, the subtree of a depth-d node over l..r saves
   sum X - C_l(B[l]) - (n - 1) C(d - 1).
5. ``ends_sha256`` is hashed from ascending chunks of ids, put together in parallel; a class streams through one hash state, so
   its ids never meet in memory.

Defined cases: rows without a conv_id are left out. A null role or text is empty; turns without a number come first; equal numbers are in the
order of role and text; repeated rows are turns of their own. Other columns take no part; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.util import cut, dump, load, map_arrow

SEG, GROUP, KEY_BYTES, CHUNK = 64, 32_768, 32 << 20, 4096
INF = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()


# --- turns ---

def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, id, words) of every turn, pos from 1, and (conv_id, n)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("at"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumns({"id": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")), "words": words})
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    # ``at`` only lets a row that is repeated very often fall into several ranges.
    rows = rows.repartitionByRange(*order, "at").sortWithinPartitions(*order)
    rows = rows.select("conv_id", F.spark_partition_id().alias("range"), "id", "words")

    def run(batches):
        last, count = None, 0
        for b in batches:
            conv = b.column(0).to_numpy()
            if not len(conv):
                continue
            head = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            k = np.arange(1, len(conv) + 1) - np.repeat(head, np.diff(np.append(head, len(conv))))
            if conv[0] == last:
                k[:head[1] if len(head) > 1 else len(conv)] += count
            last, count = conv[-1], int(k[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k)], ["conv_id", "range", "id", "words", "k"])

    rows = cut(map_arrow(rows, run, "conv_id long, range int, id string, words int, k long"), "trie-turns")
    parts = rows.groupBy("conv_id", "range").agg(F.max("k").alias("m"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.sum("m").over(before)).where("offset > 0").select("conv_id", "range", "offset")
    # A conversation that goes on is the first of its range: at most one row per range.
    rows = rows.join(F.broadcast(offsets), ["conv_id", "range"], "left")
    rows = rows.select("conv_id", (F.col("k") + F.coalesce("offset", F.lit(0))).alias("pos"), "id", "words")
    return rows, parts.groupBy("conv_id").agg(F.sum("m").alias("n"))


def rebuilt(turns: DataFrame, convs: DataFrame, modulus: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Each conversation c begins with the first h turns of c - c % ``modulus`` in place of its own; h = crc32(c) % (``most`` + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("long")
    heads = turns.where((F.col("conv_id") % modulus == 0) & (F.col("pos") <= most)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("head"))
    convs = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % modulus).join(heads, "base", "left")
    none = F.array().cast("array<struct<pos:bigint,id:string,words:int>>")
    convs = convs.withColumn("head", F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.greatest(F.col("h"), F.lit(1)).cast("int"))).otherwise(none))
    convs = cut(convs.select("conv_id", "n", "h", "head", F.size("head").cast("long").alias("m")), "trie-heads")
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "id", "words")
    taken = convs.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.pos", "x.id", "x.words")
    lengths = convs.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return own.unionByName(taken), lengths


# --- classes and their keys ---

def _segments(turns: DataFrame, lengths: DataFrame, size: int) -> DataFrame:
    """(conv_id, seg, t, h1, h2, w): every ``size`` turns; the last segment has fewer, or none."""
    turns = turns.withColumns({"seg": F.floor((F.col("pos") - 1) / size), "h1": F.xxhash64("pos", "id", F.lit(1)),
                               "h2": F.xxhash64("pos", "id", F.lit(2))})
    full = turns.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("t"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"),
        F.sum("words").alias("w"))
    full = full.withColumn("t", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))))
    zero = F.lit(0).cast("long")
    bare = lengths.where(F.col("n") % size == 0).select(
        "conv_id", F.floor(F.col("n") / size).alias("seg"), F.array().cast("array<struct<id:string,words:int>>").alias("t"),
        zero.alias("h1"), zero.alias("h2"), zero.alias("w"))
    return full.unionByName(bare)


def _ends(whole: DataFrame) -> DataFrame:
    """(rep, sha): the hash of the ascending ids of each class, rep the first of them."""
    key = ["L", "k1", "k2"]
    rows = whole.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")

    def chunks(batches):
        for b in batches:
            cols = [b.column(k).to_numpy() for k in range(4)]
            if not len(cols[0]):
                continue
            new = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0) if len(cols[0]) > 1 else np.zeros(0, bool)
            head = np.flatnonzero(np.concatenate(([True], new)))
            out = []
            for s, e in zip(head, np.append(head[1:], len(cols[0]))):
                for a in range(s, e, CHUNK):
                    out.append((*(int(c[s]) for c in cols[:3]), int(cols[3][a]), ",".join(map(str, cols[3][a:min(e, a + CHUNK)].tolist()))))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.string()])],
                                             [*key, "first", "ids"])

    rows = map_arrow(rows, chunks, "L long, k1 long, k2 long, first long, ids string")
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "first")

    def hashed(batches):
        now, state, rep = None, None, None
        for b in batches:
            out = []
            for *k, first, ids in zip(*(c.to_pylist() for c in b.columns)):
                if k != now:
                    if now is not None:
                        out.append((rep, state.hexdigest()))
                    now, state, rep = k, hashlib.sha256(ids.encode()), first
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], ["rep", "sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["rep", "sha"])

    return map_arrow(rows, hashed, "rep long, sha string")


def _shards(segments: DataFrame, group: int) -> DataFrame:
    """(shard, first, last, data): classes in the order of their keys, at most ``group`` to a shard; first and last
    are its outer classes alone. Shard numbers ascend with the keys."""
    state = F.struct("h1", "h2", F.size("t"))
    parting = segments.where("seg > 0").groupBy("seg", "s1", "s2").agg(F.min(state).alias("a"), F.max(state).alias("b")).where("a <> b")
    some = segments.where("seg = 0").unionByName(segments.where("seg > 0").join(parting, ["seg", "s1", "s2"], "left_semi").select(segments.columns))
    keys = some.groupBy("rep", "L", "tokens", "n").agg(F.sort_array(F.collect_list(F.struct("seg", "c0", "t"))).alias("g"))
    ids = F.flatten(F.transform("g", lambda g: F.transform(g["t"], lambda x: x["id"])))
    keys = keys.select("rep", "L", "tokens", "n", F.unhex(F.array_join(ids, "")).alias("key"), F.transform("g", lambda g: g["seg"]).alias("segs"),
                       F.transform("g", lambda g: g["c0"]).alias("c0"),
                       F.flatten(F.transform("g", lambda g: F.transform(g["t"], lambda x: x["words"].cast("long")))).alias("words"))
    keys = keys.repartitionByRange("key").sortWithinPartitions("key")

    def one(rows):
        cols = list(zip(*rows))
        flat = lambda lists: np.array([v for x in lists for v in x], np.int64)
        out = {k: np.array(cols[i], np.int64) for i, k in enumerate(("rep", "L", "tokens", "n"))}
        return dump(out | {"key": np.frombuffer(b"".join(cols[4]), np.uint64).reshape(-1, 2), "size": np.array([len(k) // 16 for k in cols[4]]),
                           "segs": flat(cols[5]), "segs_n": np.array([len(x) for x in cols[5]]), "c0": flat(cols[6]), "words": flat(cols[7])})

    def run(batches):
        held, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([one(r)], pa.binary()) for r in (held[:1], held[-1:], held)], ["first", "last", "data"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if len(held) == group or (held and size + len(r[4]) > KEY_BYTES):
                    yield flush()
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield flush()

    rows = map_arrow(keys, run, "first binary, last binary, data binary")
    return cut(rows.select(F.monotonically_increasing_id().alias("shard"), "*"), "trie-shards")


# --- range minima ---

class Minima:
    """Sparse table: row k holds the minima of 2^k consecutive values."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values, np.int64)]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            half, last = 1 << (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo..hi]; the largest number where hi < lo."""
        n = hi - lo + 1
        out = np.full(len(lo), INF)
        level = np.zeros(len(lo), np.int64)
        level[n > 0] = np.log2(n[n > 0]).astype(np.int64)
        for k in np.unique(level[n > 0]):
            at = np.flatnonzero((level == k) & (n > 0))
            out[at] = np.minimum(self.rows[k][lo[at]], self.rows[k][hi[at] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The first index >= at whose value is below d (the number of values if there is none), by binary search."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            ok = at < len(row)
            ok[ok] = row[at[ok]] >= d[ok]
            at[ok] += 1 << k
        return at

    def left(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The last index <= at whose value is below d (-1 if there is none), by binary search."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, start = self.rows[k], at - (1 << k) + 1
            ok = start >= 0
            ok[ok] = row[start[ok]] >= d[ok]
            at[ok] -= 1 << k
        return at


def _shared(s: dict, size: int, other: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each class of ``s`` but the first, by its neighbour before it: the turns they share and their words. With ``other`` (one class):
    for the first class of ``s``, by ``other`` before it."""
    begin = np.concatenate(([0], np.cumsum(s["size"])))
    first = np.concatenate(([0], np.cumsum(s["segs_n"])))
    if other is None:
        who = np.arange(1, len(s["size"]))
        a, b, keys = begin[:-2], begin[1:-1], s["key"]
        common = np.minimum(s["size"][:-1], s["size"][1:])
        left = keys
    else:
        who = np.array([0])
        a, b, keys, left = np.array([0]), np.array([0]), s["key"], other["key"]
        common = np.minimum(other["size"][-1:], s["size"][:1])
    k = common.astype(np.int64).copy()
    n = int(common.sum())
    if n:
        pair = np.repeat(np.arange(len(common)), common)
        offset = np.arange(n) - np.repeat(np.cumsum(common) - common, common)
        differ = np.flatnonzero((left[a[pair] + offset] != keys[b[pair] + offset]).any(1))
        np.minimum.at(k, pair[differ], offset[differ])
    g = k // size
    words = np.concatenate(([0], np.cumsum(s["words"])))
    start = begin[who]
    return (s["segs"][first[who] + g] * size + k % size, s["c0"][first[who] + g] + words[start + k] - words[start + g * size])


SUMS = ["n", "x", "leaves", "conv"]
INSIDE, LEFT, RIGHT = 1, 0, 2  # a run within the shard, one that begins before it, one that only ends after it
NODE = "kind string, shard long, top long, depth long, n long, x long, leaves long, conv long, lcp long, low long, high long, c long"


def _shard_rows(shard: int, s: dict, before: dict | None, after: dict | None, size: int) -> list[tuple]:
    """NODE rows: ``node`` (a run within the shard), ``open`` (a depth whose run leaves it), ``class`` (a class, the depth it shares with
    the one before, and the node there, unless that is open), ``start`` and ``end`` (sums up to the shard's end for low < depth <= high), ``total``."""
    n = len(s["rep"])
    B, c = np.full(n + 1, -1), np.zeros(n, np.int64)
    B[1:n], c[1:] = _shared(s, size)
    if before is not None:
        B[:1], c[:1] = _shared(s, size, before)
    if after is not None:
        B[n:], _ = _shared(after, size, {"key": s["key"][len(s["key"]) - int(s["size"][-1]):], "size": s["size"][-1:]})
    low = Minima(B)
    smallest = Minima(s["rep"])
    leaf = B[1:] < s["L"]
    sums = [np.concatenate(([0], np.cumsum(v))) for v in (s["n"], s["n"] * s["tokens"] - (s["tokens"] - c), leaf.astype(np.int64))]

    def over(lo, hi):
        return [v[hi + 1] - v[lo] for v in sums] + [smallest.of(lo, hi)]

    # Candidate prefixes: where neighbours part, and whole conversations.
    at = np.concatenate((np.arange(n), [n - 1], np.arange(n)))
    d = np.concatenate((B[:n], B[n:], s["L"]))
    l, r = low.left(at, d), low.right(at + 1, d) - 1
    root = d < 0
    crossing = (l < 0) | (r >= n)
    inside = ~crossing & ~root
    rows: list[tuple] = []

    def add(kind, top, depth, total, lcp, lo, hi, cs):
        m = len(depth)
        cols = [np.broadcast_to(np.asarray(v), m).tolist() for v in (top, depth, *total, lcp, lo, hi, cs)]
        rows.extend(zip([kind] * m, [shard] * m, *cols))

    which = np.flatnonzero(inside)
    which = which[np.unique(np.stack((l[which], d[which])), axis=1, return_index=True)[1]]
    add("node", s["rep"][l[which]], d[which], over(l[which], r[which]), -1, -1, -1, c[l[which]])
    side = np.where(l < 0, LEFT, RIGHT)
    for k in (LEFT, RIGHT):
        add("open", -1, np.unique(d[crossing & ~root & (side == k)]), [0] * 4, -1, k, -1, 0)
    own = np.arange(n)
    known = inside[:n]
    parent = np.where(known, s["rep"][np.maximum(l[:n], 0)], -1)
    conv = np.full(n, -1)
    conv[known] = smallest.of(l[:n][known], r[:n][known])
    # top: the class; lcp: depth of its parent; low: where that lies; c and conv: its first class and smallest member, if inside.
    add("class", s["rep"], s["L"], [np.zeros(n, np.int64)] * 3 + [conv], B[:n], np.where(known, INSIDE, side[:n]), -1, parent)
    # Runs that reach the end of the shard start at suffix minima of B[0..n-1]; those from its beginning end at prefix minima of B[1..n].
    back = B[:n][::-1]
    new = np.flatnonzero(np.concatenate(([True], back[1:] < np.minimum.accumulate(back)[:-1])))
    begin = n - 1 - new
    add("start", s["rep"][begin], np.zeros(len(begin)).astype(np.int64), over(begin, np.full(len(begin), n - 1)), -1, B[begin],
        np.concatenate(([INF], B[begin][:-1])), c[begin])
    ahead = B[1:]
    new = np.flatnonzero(np.concatenate(([True], ahead[1:] < np.minimum.accumulate(ahead)[:-1])))
    add("end", -1, np.zeros(len(new)).astype(np.int64), over(np.zeros(len(new), np.int64), new), -1, ahead[new], np.concatenate(([INF], ahead[new][:-1])), 0)
    add("total", -1, np.zeros(1, np.int64), over(np.array([0]), np.array([n - 1])), -1, int(B[:n].min()), int(B[1:].min()), 0)
    return rows


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in NODE.split(",")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if k == "string" else pa.int64()) for c, (_, k) in zip(cols, fields)],
                                      [f for f, _ in fields])


def _across(found: DataFrame) -> DataFrame:
    """(shard, depth, side, top, n, x, leaves, conv, c) of every open depth of every shard: the run it belongs to, whichever shards that covers."""
    # Per shard: its number, the least B up to its last class and from its second on, and four sums.
    t = found.where("kind = 'total'").select("shard", "low", "high", *SUMS).orderBy("shard").toArrow()
    shard, lo, hi, n, x, leaves, conv = (t.column(k).to_numpy() for k in range(7))
    sums = [np.concatenate(([0], np.cumsum(v))) for v in (n, x, leaves)]

    def run(batches):
        starts, ends, smallest = Minima(lo), Minima(hi), Minima(conv)
        for b in batches:
            at = np.searchsorted(shard, b.column(0).to_numpy())
            d, side = (b.column(k).to_numpy() for k in (1, 2))
            s = np.where(side == LEFT, starts.left(at - 1, d), at)
            e = np.where(side == LEFT, ends.right(at, d), ends.right(at + 1, d))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(shard[s]), pa.array(shard[e]), *(pa.array(v[e] - v[s + 1]) for v in sums), pa.array(smallest.of(s + 1, e - 1))],
                ["shard", "depth", "side", "from", "to", *SUMS])

    opened = map_arrow(found.where("kind = 'open'").select("shard", "depth", F.col("low").alias("side")), run,
                       "shard long, depth long, side long, from long, to long, n long, x long, leaves long, conv long")
    a = found.where("kind = 'start'").select(F.col("shard").alias("from"), "top", "c", "low", "high", *[F.col(k).alias(f"{k}_a") for k in SUMS])
    b = found.where("kind = 'end'").select(F.col("shard").alias("to"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                                           *[F.col(k).alias(f"{k}_b") for k in SUMS])
    out = opened.join(a, "from").where("low < depth and depth <= high").join(b, "to").where("low_b < depth and depth <= high_b")
    return out.select("shard", "depth", "side", "top", *[(F.col(k) + F.col(f"{k}_a") + F.col(f"{k}_b")).alias(k) for k in SUMS[:3]],
                      F.least("conv", "conv_a", "conv_b").alias("conv"), "c")


# --- the trie ---

def trie(turns: DataFrame, lengths: DataFrame, group: int = GROUP, size: int = SEG) -> DataFrame:
    """The nodes of conversations given as (conv_id, pos, id, words) and (conv_id, n); ``size``: turns of a segment."""
    segs = cut(_segments(turns, lengths, size), "trie-segments")
    whole = cut(segs.groupBy("conv_id").agg(F.sum(F.size("t")).alias("L"), F.bit_xor("h1").alias("k1"), F.bit_xor("h2").alias("k2"),
                                            F.sum("w").alias("tokens")), "trie-whole")
    classes = whole.groupBy("L", "k1", "k2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n"), F.max("tokens").alias("tokens"))
    before = Window.partitionBy("rep").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    segs = segs.withColumnRenamed("conv_id", "rep").join(classes.select("rep", "L", "tokens", "n"), "rep")
    segs = cut(segs.withColumns({"s1": F.coalesce(F.bit_xor("h1").over(before), zero), "s2": F.coalesce(F.bit_xor("h2").over(before), zero),
                                 "c0": F.coalesce(F.sum("w").over(before), zero)}), "trie-classes")
    shards = _shards(segs, group)
    ordered = Window.orderBy("shard")  # one row of two single classes per shard
    edges = shards.select("shard", F.lag("last").over(ordered).alias("before"), F.lead("first").over(ordered).alias("after"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                yield _node_batch(_shard_rows(r["shard"], load(r["data"]), *(None if r[k] is None else load(r[k]) for k in ("before", "after")), size))

    found = cut(map_arrow(shards.select("shard", "data").join(edges, "shard"), run, NODE), "trie-runs")
    across = cut(_across(found), "trie-across")
    node = ["top", "depth", *SUMS, "c"]
    nodes = found.where("kind = 'node'").select(*node).unionByName(across.select(*node).dropDuplicates(["top", "depth"]))
    first = found.where("kind = 'class'").select("shard", F.col("top").alias("rep"), F.col("depth").alias("L"), "lcp", F.col("low").alias("side"),
                                                 F.col("c").alias("p_top"), F.col("conv").alias("p_conv"))
    open_parents = across.select("shard", "side", F.col("depth").alias("lcp"), F.col("top").alias("a_top"), F.col("conv").alias("a_conv"))
    # A shard's first class and those that share a depth with it: at most a row per shard and open depth on the right.
    first = first.join(open_parents, ["shard", "side", "lcp"], "left").select(
        "rep", "L", "lcp", F.when(F.col("side") == INSIDE, F.col("p_top")).otherwise(F.col("a_top")).alias("p_top"),
        F.when(F.col("side") == INSIDE, F.col("p_conv")).otherwise(F.col("a_conv")).alias("p_conv"))
    first = cut(first, "trie-parents")
    born = first.where("lcp >= 0").groupBy(F.col("p_top").alias("top"), F.col("lcp").alias("depth")).agg(F.count("*").alias("born"))
    chain = Window.partitionBy("top").orderBy("depth")
    runs = nodes.withColumns({"before": F.lag("depth").over(chain), "before_conv": F.lag("conv").over(chain), "next": F.lead("depth").over(chain)})
    runs = runs.join(first.withColumnRenamed("rep", "top"), "top").join(born, ["top", "depth"], "left").select(
        "top", "L", "depth", "n", (F.col("x") - F.col("c")).alias("a"), "leaves", "conv",
        F.coalesce("before", "lcp").alias("above"), F.coalesce("before_conv", "p_conv").alias("p_conv"),
        (F.coalesce("born", F.lit(0)) + F.when(F.col("next").isNotNull(), 1).otherwise(0)).alias("children"))
    runs = runs.join(_ends(whole).withColumnRenamed("rep", "top"), "top")
    runs = cut(runs, "trie-nodes")

    # Every depth between two of these nodes, by the segments of the first class.
    pieces = runs.where("depth > 0").withColumn("seg", F.explode(F.sequence(
        F.floor(F.greatest("above", F.lit(0)) / size), F.floor((F.col("depth") - 1) / size))))
    words = segs.select(F.col("rep").alias("top"), "seg", "c0", F.transform("t", lambda x: x["words"].cast("long")).alias("w"))
    rows = pieces.join(words, ["top", "seg"]).withColumn("d", F.explode(F.sequence(
        F.greatest(F.col("above") + 1, F.col("seg") * size + 1), F.least("depth", (F.col("seg") + 1) * size))))
    done = F.col("d") - F.col("seg") * size - 1
    rows = rows.withColumn("prior", F.col("c0") + F.aggregate(F.slice("w", 1, done.cast("int")), zero, lambda a, x: a + x))
    top = runs.where("above < 0").withColumns({"d": zero, "prior": zero})
    cols = ["L", "depth", "n", "a", "leaves", "conv", "above", "p_conv", "children", "sha", "d", "prior"]
    rows = rows.select(*cols).unionByName(top.select(*cols))
    last = F.col("d") == F.col("depth")
    return rows.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == 0, F.lit(None)).when(F.col("d") == F.col("above") + 1, F.col("p_conv")).otherwise(F.col("conv")).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("a") - (F.col("n") - 1) * F.col("prior")).alias("saved_tokens"),
        F.when(last & (F.col("L") == F.col("depth")), F.col("sha")).otherwise(F.lit(EMPTY)).alias("ends_sha256"))


def prefix_nodes(conversations: DataFrame, group: int = GROUP, size: int = SEG) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of the trie of the rebuilt conversations."""
    return trie(*rebuilt(*numbered(conversations)), group=group, size=size)


ORACLE = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as txt,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
own as (
  select conv_id, list(md5(length(role) || ':' || role || txt) order by pos) as ids,
         list(len([w for w in regexp_split_to_array(txt, '[\x20\x09-\x0D]+') if w <> '']) order by pos) as words from t group by conv_id),
c as (
  select *, list_reduce(list_prepend(cast(4294967295 as bigint), [cast(ord(x) as bigint) for x in string_split(cast(conv_id as varchar), '')]),
    lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as crc from own),
r as (
  select c.conv_id, coalesce(b.ids[1:h], []) || c.ids[h + 1:] as ids, coalesce(b.words[1:h], []) || c.words[h + 1:] as words
  from (select *, xor(crc, 4294967295) % 4 as h from c) c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
m as (select conv_id, ids, words, unnest(range(0, len(ids) + 1)) as depth from r),
p as (select *, array_to_string(ids[1:depth], '') as prefix from m),
node as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where len(ids) = depth), '')) as ends_sha256,
         max(case when depth > 0 then words[depth] else 0 end) as w, arg_min(ids, conv_id) as ids
  from p group by depth, prefix),
child as (
  select depth - 1 as depth, array_to_string(ids[1:depth - 1], '') as prefix, count(*) as n_children from node where depth > 0 group by 1, 2),
full_node as (select node.*, coalesce(n_children, 0) as n_children from node left join child using (depth, prefix)),
up as (select (n_convs - 1) * w as own_saved, n_children = 0 as leaf, ids, unnest(range(0, depth + 1)) as depth from full_node),
total as (
  select depth, array_to_string(ids[1:depth], '') as prefix, cast(sum(own_saved) as bigint) as saved_tokens,
         cast(sum(cast(leaf as bigint)) as bigint) as n_leaves from up group by 1, 2)
select f.conv_id, f.depth, q.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
from full_node f join total using (depth, prefix)
left join node q on q.depth = f.depth - 1 and q.prefix = array_to_string(f.ids[1:f.depth - 1], '')
"""
