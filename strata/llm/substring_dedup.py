"""Removal of repeated byte strings with sharded suffix arrays.

A byte is removed when it lies in a string of ``LENGTH`` bytes that also starts earlier (in a document with a smaller
doc_id, or earlier in the same one). All strings are judged on the input; overlaps count; matches never cross documents.

1. Sharding by content. Every window of LENGTH bytes has an anchor: of its ``K``-byte strings the one with the
   smallest hash, the leftmost if tied. The anchor depends on the window's content alone, so equal windows have
   equal anchors and meet in one shard. Consecutive windows with the same anchor form a segment.
2. Anchors that occur once, which most do, have no equal window anywhere; only their hashes were shuffled. Segments of
   the others are aggregated by content (hash of anchor and of bytes) to their first occurrence. A later copy of
   a whole segment is covered: all its windows started earlier.
3. Where an anchor has segments of different content, their first occurrences are split once more, by how far in the
   anchor lies; the parts have longer keys, and only those whose key repeats with different content go on. A key with
   more than ``HOT`` contents would make a shard of unbounded size; its windows are told apart one by one, by
   aggregation. All others go to shards by key. A shard's segments are laid out
   in the order of occurrence, its suffix array is built by induced sorting, and permuted common prefixes
   give the runs of suffixes that share LENGTH bytes. In each run the first position in the text is the first occurrence;
   the windows at all others started earlier.
4. Marked windows are gathered per document, and the union of their bytes is removed.

Segments are aggregated map-side before they are grouped, so a text copied a million times costs one segment; shards are many
and small, and their number grows with the text that reaches them. Long documents are cut into blocks of windows for step 1.

Defined cases: null text is empty: n_bytes 0, nothing removed. Documents shorter than LENGTH are kept. A null
doc_id comes before all others. Rows equal in doc_id and text are one document, each answered as that document.
Different texts under one doc_id come in the order of their hashes. Other columns take no part; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.suffix_sort import permuted_prefixes, suffix_array
from strata.llm.util import cut, map_arrow, release, slices, text_or_empty
from strata.llm.words import _P, _PINV, mix

LENGTH, K = 100, 40
BLOCK = 1 << 18
SHARD = 1 << 18
NULL_ID = -(1 << 63)
_SEGMENT = "ah long, sh long, doc long, th long, place long"  # place: first window start, windows - 1, anchor's distance
STEP, HOT = 15, 4096
_power: dict[int, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    for p in (_P, _PINV):
        if p not in _power or len(_power[p]) < n:
            a = np.full(max(n, BLOCK + 2 * LENGTH), p, np.uint64)
            a[0] = 1
            _power[p] = np.multiply.accumulate(a)
    return _power[_P], _power[_PINV]


def segments(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash and place of every segment of a text's bytes."""
    out = []
    width = LENGTH - K + 1  # K-byte strings in a window
    for base in range(0, len(raw) - LENGTH + 1, BLOCK):
        part = raw[base:base + BLOCK + LENGTH - 1]
        up, down = _powers(len(part) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)])))
        m = len(part) - K + 1
        h = mix((total[K:] - total[:-K]) * down[:m])
        key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(m, dtype=np.uint64)
        padded = np.full(-(-m // width) * width, ~np.uint64(0), np.uint64)
        padded[:m] = key
        grid = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(grid, 1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        n = len(part) - LENGTH + 1
        anchor = (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        s = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        e = np.append(s[1:], n) - 1
        a = anchor[s]
        body = (total[e + LENGTH] - total[s]) * down[s]
        shape = ((a - s) * 4096 + (e - s)).astype(np.uint64)
        out.append((h[a], mix(body + mix(shape + np.uint64(1))), (s + base << 16) + (e - s << 8) + (a - s)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), text.alias("text"), F.xxhash64(text).alias("th"))


def _found(ids, texts, hashes):
    """(doc, th, segments) of each text that may hold a window."""
    return [(i, t, segments(np.frombuffer(x.encode("utf-8", "surrogatepass"), np.uint8))) for i, x, t in zip(ids, texts, hashes)
            if len(x) >= LENGTH // 4]


def all_anchors(docs: DataFrame) -> DataFrame:
    """ah of every segment."""
    def run(batches):
        for columns in slices(batches, 1 << 20):
            found = [r[2][0] for r in _found(*columns)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["ah"])

    return map_arrow(_keyed(docs), run, "ah long")


def all_segments(docs: DataFrame) -> DataFrame:
    """ah, sh, doc, th, place of every segment."""
    def run(batches):
        for columns in slices(batches, 1 << 20):
            rows = _found(*columns)
            n = [len(r[2][0]) for r in rows]
            if sum(n):
                ah, sh, place = (np.concatenate([r[2][c] for r in rows]) for c in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah.view(np.int64)), pa.array(sh.view(np.int64)), pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), n)),
                     pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), n)), pa.array(place)],
                    ["ah", "sh", "doc", "th", "place"])

    return map_arrow(_keyed(docs), run, _SEGMENT)


def marks(order: list[tuple[int, int, int]], bodies: list[bytes]) -> list[tuple[int, int, int, int]]:
    """(doc, th, first, last window start) of runs of windows that occur earlier in a shard, whose segments are given
    by (doc, th, start) and bytes."""
    at = sorted(range(len(order)), key=order.__getitem__)
    sizes = np.array([len(bodies[i]) for i in at])
    t = np.frombuffer(b"\x00".join(bodies[i] for i in at) + b"\x00", np.uint8).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    text = np.zeros(len(t) + 1, np.int64)
    text[:-1] = t + 2
    text[begin + sizes] = 1  # between segments; a zero byte of the text is 2
    used, dense = np.unique(text, return_inverse=True)
    sa = suffix_array(dense, len(used))
    left = np.zeros(len(text), np.int64)  # bytes left in the segment
    left[:-1] = np.repeat(begin + sizes, sizes + 1) - np.arange(len(t))
    starts = np.flatnonzero(left >= LENGTH)
    shared = np.zeros(len(text), bool)
    shared[starts] = permuted_prefixes(dense, sa, LENGTH, starts) >= LENGTH
    window = left[sa] >= LENGTH
    linked = shared[sa]
    linked[0] = False
    run = np.cumsum(~linked) - 1
    first = np.minimum.reduceat(sa, np.flatnonzero(~linked))
    late = np.sort(sa[window & (first[run] < sa)])
    if not len(late):
        return []
    cuts = np.flatnonzero(np.diff(late) > 1) + 1
    out = []
    for x, y in zip(late[np.concatenate(([0], cuts))], late[np.concatenate((cuts - 1, [len(late) - 1]))]):
        j = int(np.searchsorted(begin, x, side="right")) - 1
        doc, th, s = order[at[j]]
        out.append((doc, th, s + int(x - begin[j]), s + int(y - begin[j])))
    return out


def _shard_marks(parts: DataFrame, shards: int) -> DataFrame:
    """Marks of segments (ah, doc, th, s, body): all of an anchor's in one shard, a shard at a time."""
    rows = parts.withColumn("shard", F.pmod(F.xxhash64("ah"), F.lit(shards)))
    rows = rows.repartition(F.col("shard")).sortWithinPartitions("shard").select("shard", "doc", "th", "s", "body")

    def run(batches):
        now, order, bodies = None, [], []

        def flush():
            got = marks(order, bodies)
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*got) if got else [[]] * 4)], ["doc", "th", "s", "e"])

        for b in batches:
            for shard, doc, th, s, body in zip(*(c.to_pylist() for c in b.columns)):
                if shard != now and bodies:
                    yield flush()
                    order, bodies = [], []
                now = shard
                order.append((doc, th, s))
                bodies.append(body)
        if bodies:
            yield flush()

    return map_arrow(rows, run, "doc long, th long, s long, e long")


def _parts(suspects: DataFrame) -> DataFrame:
    """Parts (ah, sh, sh2, doc, th, s, e, body) of the segments in array ``parts`` of each suspect document: windows whose
    anchor lies equally far in, by steps of STEP bytes. Their new, longer key is what all windows of a full step share."""
    def run(batches):
        for docs, texts, hashes, lists in slices(batches, 1 << 20):
            out = []
            for doc, text, th, parts in zip(docs, texts, hashes, lists):
                raw = text.encode("utf-8", "surrogatepass") if parts else b""
                for place in parts or ():
                    s = place >> 16
                    e, a = s + (place >> 8 & 255), s + (place & 255)
                    for lo in range(max(0, a - e) // STEP * STEP, a - s + 1, STEP):
                        hi = lo + STEP - 1
                        first, last = max(s, a - hi), min(e, a - lo)
                        if first <= last:
                            out.append((doc, th, first, last, lo.to_bytes(1, "big") + raw[a - lo:a - hi + LENGTH], raw[first:last + LENGTH]))
            cols = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [*[pa.int64()] * 4, pa.binary(), pa.binary()])],
                                             ["doc", "th", "s", "e", "key", "body"])

    rows = map_arrow(suspects.select("doc", "text", "th", "parts"), run, "doc long, th long, s long, e long, key binary, body binary")
    return rows.select(F.xxhash64("key").alias("ah"), F.xxhash64("body").alias("sh"), F.xxhash64(F.lit(1), "body").alias("sh2"),
                       "doc", "th", "s", "e", "body")


def _firsts(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """``keys`` and the first occurrence (struct ``first``) of every content."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*place)).alias("first"))


def _later(rows: DataFrame, firsts: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """The rows that are later copies of their content's first occurrence."""
    return rows.join(firsts, keys).where(F.struct(*place) != F.col("first")).drop("first")


def _late(suspects: DataFrame) -> DataFrame:
    """Runs (doc, th, s, e) of windows in the segments under ``parts`` that occur earlier."""
    place = ["doc", "th", "s", "e"]
    parts = _parts(suspects)
    often = parts.groupBy("ah").agg(F.count("*").alias("c")).where("c > 1").select("ah")
    parts = cut(parts.join(often, "ah", "left_semi"), "parts")
    firsts = cut(_firsts(parts, ["ah", "sh", "sh2"], place), "part-firsts")
    later = _later(parts.drop("body"), firsts, ["ah", "sh", "sh2"], place)
    sizes = firsts.groupBy("ah").agg(F.count("*").alias("c")).where("c > 1")
    firsts = firsts.join(sizes, "ah").select("ah", "c", *[F.col(f"first.{x}").alias(x) for x in place])
    firsts = cut(parts.select("ah", *place, "body").join(firsts, ["ah", *place]), "to-sort")
    total = firsts.where(f"c <= {HOT}").agg(F.sum(F.octet_length("body"))).first()[0] or 0
    sorted_ = _shard_marks(firsts.where(f"c <= {HOT}"), max(1, total // SHARD))
    # Beyond HOT contents of one key a shard would not stay small: single windows, which equal content decides.
    window = firsts.where(f"c > {HOT}").select("doc", "th", F.explode(F.sequence("s", "e")).alias("w"), "s", "body")
    window = window.select("doc", "th", "w", F.expr(f"substring(body, cast(w - s + 1 as int), {LENGTH})").alias("body"))
    window = window.select("doc", "th", "w", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), "body").alias("h2"))
    hot = _later(window.drop("body"), _firsts(window, ["h1", "h2"], ["doc", "th", "w"]), ["h1", "h2"], ["doc", "th", "w"])
    return (later.select(*place).union(sorted_).union(hot.select("doc", "th", "w", F.col("w").alias("e"))))


def _removed(suspects: DataFrame) -> DataFrame:
    """n_removed, n_spans, kept_sha256 and the kept bytes' text of documents with ``copies`` and ``late`` window runs."""
    def run(batches):
        for docs, texts, hashes, one, two in slices(batches, 1 << 20):
            out = []
            for doc, text, th, a, b in zip(docs, texts, hashes, one, two):
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                edge = np.zeros(len(raw) + 1, np.int64)
                runs = [(p >> 16, (p >> 16) + (p >> 8 & 255)) for p in a or ()] + [(r["s"], r["e"]) for r in b or ()]
                if runs:
                    s, e = np.array(runs, np.int64).T
                    np.add.at(edge, s, 1)
                    np.add.at(edge, e + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((doc, th, int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            cols = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [*[pa.int64()] * 4, pa.string()])],
                                             ["doc", "th", "n_removed", "n_spans", "kept_sha256"])

    return map_arrow(suspects.select("doc", "text", "th", "copies", "late"), run,
                     "doc long, th long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    often = all_anchors(docs).groupBy("ah").agg(F.count("*").alias("c")).where("c > 1").select("ah")
    often = cut(often, "often")
    release(spark)
    repeated = cut(all_segments(docs).join(often, "ah", "left_semi"), "repeated")
    release(spark)
    place = ["doc", "th", "place"]
    firsts = cut(_firsts(repeated, ["ah", "sh"], place), "firsts")
    release(spark)
    copies = _later(repeated, firsts, ["ah", "sh"], place)
    several = firsts.groupBy("ah").agg(F.count("*").alias("c")).where("c > 1").select("ah")
    several = firsts.join(several, "ah", "left_semi").select("first.doc", "first.th", F.lit(None).cast("long"), "first.place")
    lists = (copies.select("doc", "th", F.col("place").alias("copy"), F.lit(None).cast("long").alias("part")).union(several)
             .groupBy("doc", "th").agg(F.collect_set("copy").alias("copies"), F.collect_set("part").alias("parts")))
    lists = cut(lists, "lists")
    del copies, several
    release(spark)
    suspects = cut(_keyed(docs).join(lists, ["doc", "th"]).dropDuplicates(["doc", "th"]), "suspects")
    release(spark)
    late = cut(_late(suspects), "late")
    release(spark)
    late = late.groupBy("doc", "th").agg(F.collect_list(F.struct("s", "e")).alias("late"))
    done = _removed(suspects.join(late, ["doc", "th"], "left").select("doc", "text", "th", "copies", "late"))
    rows = docs.select(F.col("doc_id"), text_or_empty().alias("text")).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64("text").alias("th"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return rows.join(done, ["doc", "th"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
