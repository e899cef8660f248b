"""Near-duplicate components by MinHash banding with sequential Bayesian verification.

A document is the set of its distinct n-word shingles (words: runs of non-white-space bytes, A-Z lower-cased; a
text of fewer words is one shingle; a text without words is empty and linked with nothing). Documents are linked when
the Jaccard similarity of their whole sets reaches the threshold.

1. One pass over the whole texts gives each document its set's size, a 128-bit digest of the set, ``ROWS * BANDS`` minimum
   hashes, one 64-bit key per band, and one byte of every hash for verification. Equal sets are one class, numbered
   before anything is paired; copies never meet each other.
2. Band keys that several classes share are buckets. Each class is compared with the hub (smallest member) of its
   buckets, never with all members: first with its smallest hub, then, where that did not connect them, with the others.
   Members of buckets that still hold several components then meet in their families (what such buckets connect): those
   outside a family's largest component are compared with all of it, in blocks, and a block pair yields
   at most one link per member and component. No link between components is lost; pairs inside a component need
   no comparison, and pairs never become rows.
3. Sequential Bayesian verification: the signature bytes of a pair are compared in batches of ``BATCH``. After
   each, with a uniform prior, the posterior probability that the similarity reaches the threshold decides: below ``MISS`` the
   pair is dropped.
4. Survivors are verified exactly on their whole shingle sets.

A pair at the threshold t shares no band with probability (1 - t^ROWS)^BANDS: 5e-6 at 0.8, less above. Shingles
are 64-bit hashes; within a pair of sets of 10^4 the chance of one wrong match is below 10^-11.

Skew: classes and hubs are partial aggregates; joins that meet a large group are equi-joins that adaptive execution
can split. Nothing is capped or sampled. Intermediate tables are written to the shared folder, so a lost executor costs the
running stage only.

Defined cases: null text is empty. Rows that share a doc_id count as one document, so their classes are linked whatever their texts;
a row without words is a component of its own. A row without doc_id is linked with nothing: component_id null, kept. Ties cannot occur: the component's smallest doc_id names and represents it.
Other columns take no part; an empty table gives no row.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.util import cut, map_arrow, release, slices, text_or_empty
from strata.llm.words import mix, shingles, word_hashes

ROWS, BANDS, BATCH, MISS, BLOCK = 6, 40, 24, 1e-7, 24_000
HASHES = ROWS * BANDS
_random = np.random.default_rng(20240229)
_MULTIPLY = _random.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)[:, None] | np.uint32(1)
_ADD = _random.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)[:, None]
_FEATURES = "doc_id long, n long, k1 long, k2 long, bands array<long>, bytes binary"


def signature(s: np.ndarray) -> np.ndarray:
    """``HASHES`` minimum hashes (uint32) of a non-empty set of 64-bit hashes."""
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, (x[None, i:i + 1024] * _MULTIPLY + _ADD).min(1), out=out)
    return out


def _scramble(sig: np.ndarray) -> np.ndarray:
    """Band keys (uint64) of rows of signatures."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def features(docs: DataFrame, words: int) -> DataFrame:
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(batches):
        for ids, texts in slices(batches, 1 << 20):
            sets = [shingles(h, words) for h in word_hashes(texts)]
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            sig = np.array([signature(sets[i]) for i in full], np.uint32).reshape(-1, HASHES)
            k1, k2 = (np.array(k, np.int64) for k in zip(*map(_digests, sets)))
            has = n > 0
            keys = _scramble(sig).view(np.int64).ravel()
            offsets = np.concatenate(([0], np.cumsum(has) * BANDS)).astype(np.int32)
            low = (sig ^ (sig >> np.uint32(16)) ^ (sig >> np.uint32(8))).astype(np.uint8)
            it = iter(low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n), pa.array(k1), pa.array(k2),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                 pa.array([next(it).tobytes() if x else None for x in has], pa.binary())],
                ["doc_id", "n", "k1", "k2", "bands", "bytes"])

    return map_arrow(cols, run, _FEATURES)


@functools.lru_cache(maxsize=8)
def least_matches(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(bytes compared, fewest matches that keep a pair) per batch: below it, P(similarity >= threshold) < miss.

    A byte matches with probability s = J + (1 - J) / 256; J has a uniform prior, so the posterior of s given m of
    k is proportional to s^m (1 - s)^(k - m) on [1/256, 1]."""
    s = np.linspace(1 / 256, 1, 20001)[1:-1]
    high = s >= percent / 100 + (1 - percent / 100) / 256 - 1e-9
    out = []
    for k in range(BATCH, HASHES + 1, BATCH):
        for m in range(k + 1):
            log = m * np.log(s) + (k - m) * np.log1p(-s)
            w = np.exp(log - log.max())
            if w[high].sum() / w.sum() >= miss:
                out.append((k, m))
                break
    return out


def _pruned(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that survive sequential comparison of their signature bytes and sizes."""
    need = least_matches(percent)
    left = sketches.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bytes").alias("sa"))
    right = sketches.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bytes").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where(
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                b = batch.slice(i, 4096)
                a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, HASHES) for k in (2, 3))
                live = np.arange(len(a))
                hits = np.zeros(len(a), np.int32)
                for k, m in need:
                    hits[live] += (a[live, k - BATCH:k] == c[live, k - BATCH:k]).sum(1, dtype=np.int32)
                    live = live[hits[live] >= m]
                kept = b.take(pa.array(live))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return map_arrow(both.select("a", "b", "sa", "sb"), run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(len(a)):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array([v for v, k in zip(a, keep) if k], pa.int64()),
                                              pa.array([v for v, k in zip(b, keep) if k], pa.int64())], ["a", "b"])

    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def _cross_links(left: list[dict], right: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links between members (rep, component, n, bytes, shingles) of different components: one for
    each member of ``left`` and component of ``right`` that have any."""
    need = least_matches(percent)
    a, b = (np.frombuffer(b"".join(m["bytes"] for m in side), np.uint8).reshape(-1, HASHES) for side in (left, right))
    n, comp, rep = (np.array([m[c] for m in right]) for c in ("n", "component", "rep"))
    sets = [np.frombuffer(m["shingles"], np.uint64) for m in right]
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    out = []
    for i, u in enumerate(left):
        live = np.flatnonzero((comp != u["component"]) & (np.minimum(n, u["n"]) * 100 >= np.maximum(n, u["n"]) * percent))
        hits = np.zeros(len(right), np.int32)
        for k, m in need:
            hits[live] += (b[live, k - BATCH:k] == a[i, k - BATCH:k]).sum(1, dtype=np.int32)
            live = live[hits[live] >= m]
        if not len(live):
            continue
        mine = np.frombuffer(u["shingles"], np.uint64)
        at = np.searchsorted(mine, every)
        both = np.bincount(owner[mine[np.minimum(at, len(mine) - 1)] == every], minlength=len(right))[live]
        live = live[100 * both >= percent * (len(mine) + n[live] - both)]
        out += [(u["rep"], int(rep[j])) for j in live[np.unique(comp[live], return_index=True)[1]]]
    return out


def _may_link(left: list[dict], right: list[dict], percent: int) -> bool:
    """Whether sizes and signature bytes allow a link between members (component, n, bytes) of different components."""
    need = least_matches(percent)
    a, b = (np.frombuffer(b"".join(m["bytes"] for m in side), np.uint8).reshape(-1, HASHES) for side in (left, right))
    n, comp = (np.array([m[c] for m in right]) for c in ("n", "component"))
    for i, u in enumerate(left):
        live = np.flatnonzero((comp != u["component"]) & (np.minimum(n, u["n"]) * 100 >= np.maximum(n, u["n"]) * percent))
        hits = np.zeros(len(right), np.int32)
        for k, m in need:
            hits[live] += (b[live, k - BATCH:k] == a[i, k - BATCH:k]).sum(1, dtype=np.int32)
            live = live[hits[live] >= m]
        if len(live):
            return True
    return False


def _family_links(buckets: DataFrame, labels: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that still meet in a bucket. A family is what such buckets connect; its members
    outside its largest component meet all of its members, in blocks of about ``BLOCK`` shingles."""
    own = buckets.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = own.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("rep").alias("hub")).where("x <> y")
    own = own.join(mixed.select("bucket", "hub"), "bucket")
    stars = cut(own.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "family-stars")
    families = components(stars).select(F.col("id").alias("rep"), F.col("component").alias("family"))
    members = families.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "rep", "family", F.coalesce("component", "rep").alias("component")).join(sketches, "rep")
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    facts = sizes.groupBy("family").agg(F.max(F.struct("c", "component"))["component"].alias("main"), F.sum("w").alias("w"))
    members = members.join(facts, "family").select(
        "family", "component", "rep", "n", "bytes", (F.col("component") == F.col("main")).alias("in_main"),
        F.pmod(F.xxhash64("rep"), F.ceil(F.col("w") / BLOCK)).alias("block"))
    members = cut(members, "family-members")
    sketch = F.collect_list(F.struct("component", "n", "bytes"))
    left = members.where("not in_main").groupBy("family", F.col("block").alias("lb")).agg(sketch.alias("l"))
    right = members.groupBy("family", F.col("block").alias("rb")).agg(sketch.alias("r"))

    def may_link(batches):
        for batch in batches:
            keep = [_may_link(batch.column(3)[i].as_py(), batch.column(4)[i].as_py(), percent) for i in range(batch.num_rows)]
            yield batch.select(["family", "lb", "rb"]).filter(pa.array(keep, pa.bool_()))

    # Which blocks meet is settled on sketches alone; sets move for those that may hold a link.
    meet = cut(map_arrow(left.join(right, "family").select("family", "lb", "rb", "l", "r"), may_link, "family long, lb long, rb long"), "family-blocks")
    full = members.join(sets, "rep")
    item = F.collect_list(F.struct("rep", "component", "n", "bytes", "shingles"))
    ends = lambda c: meet.select("family", F.col(c).alias("block")).distinct()
    left = full.where("not in_main").join(ends("lb"), ["family", "block"], "left_semi").groupBy("family", F.col("block").alias("lb")).agg(item.alias("l"))
    right = full.join(ends("rb"), ["family", "block"], "left_semi").groupBy("family", F.col("block").alias("rb")).agg(item.alias("r"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = _cross_links(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), percent)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                                      pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return map_arrow(meet.join(left, ["family", "lb"]).join(right, ["family", "rb"]).select("l", "r"), run, "a long, b long")


def _digests(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set of hashes, as signed numbers."""
    if not len(s):
        return 0, 0
    k = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1))), np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))], np.uint64)
    return tuple(k.view(np.int64).tolist())


def _sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of ``classes`` (rep, doc_id, k1, k2): the set of the text of that document that has these digests."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.join(classes, "doc_id").select("rep", "text", "k1", "k2")

    def run(batches):
        for reps, rows, k1, k2 in slices(batches, 1 << 20):
            sets = [shingles(h, words) for h in word_hashes(rows)]
            keep = [i for i, s in enumerate(sets) if _digests(s) == (k1[i], k2[i])]
            yield pa.RecordBatch.from_arrays([pa.array([reps[i] for i in keep], pa.int64()), pa.array([sets[i].tobytes() for i in keep], pa.binary())],
                                             ["rep", "shingles"])

    return map_arrow(texts, run, "rep long, shingles binary")


def near_components(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    spark, percent = docs.sparkSession, math.ceil(threshold * 100 - 1e-9)
    rows = cut(features(docs, words), "signatures")
    named = rows.where("n > 0 and doc_id is not null")
    key = ["k1", "k2", "n"]
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("first"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")  # numbered once, as it is written
    reps = named.join(classes, key).where("doc_id = first").select("rep", "doc_id", "k1", "k2", "n", "bands", "bytes").dropDuplicates(["rep"])
    reps = cut(reps, "representatives")

    members = reps.select("rep", F.explode("bands").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("c")).where("c > 1").select("bucket", "hub")
    buckets = cut(members.join(hubs, "bucket"), "buckets")
    release(spark)
    candidates = buckets.select("rep").distinct()
    chosen = reps.join(candidates, "rep", "left_semi")
    sketches = cut(chosen.select("rep", "n", "bytes"), "sketches")
    sets = cut(_sets(docs, chosen.select("rep", "doc_id", "k1", "k2"), words).dropDuplicates(["rep"]), "sets")
    release(spark)

    def verified(pairs, name):
        survivors = cut(_pruned(pairs, sketches, percent), f"survivors-{name}")
        return cut(_verified(survivors, sets, percent), f"links-{name}")

    # Classes that share a document are one: rows of one doc_id may hold different texts.
    owners = named.select("doc_id", *key).join(classes, key).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    owners = cut(owners.select("doc_id", "a"), "shared-ids")
    shared = named.select("doc_id", *key).join(owners, "doc_id").join(classes, key).where("rep <> a").select("a", F.col("rep").alias("b")).distinct()

    stars = buckets.where("rep <> hub")
    first = verified(stars.groupBy(F.col("rep").alias("b")).agg(F.min("hub").alias("a")).select("a", "b"), "first")
    labels = components(first.unionByName(shared))
    own = buckets.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = own.join(labels.select(F.col("id").alias("hub"), F.col("component").alias("hub_component")), "hub", "left")
    mixed = mixed.where(F.col("component") != F.coalesce("hub_component", "hub"))
    more = verified(mixed.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "hubs")
    labels = components(more, labels)
    more = cut(_family_links(buckets, labels, sketches, sets, percent), "links-families")
    labels = components(more, labels)
    of = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    of = cut(of, "class-components")
    smallest = of.groupBy("component").agg(F.min("first").alias("least"))
    of = of.join(smallest, "component").select(*key, "least")
    out = rows.join(of, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Of each component one row of ``docs``, with all its columns: of the document that represents it, the row with the longest text
    (of equal ones any). Rows without words stay, one of each doc_id; rows without a doc_id all stay."""
    kept = near_components(docs, words, threshold).where("kept").groupBy("doc_id").agg(F.count("*").alias("c"))
    kept = cut(kept.select(F.col("doc_id").alias("_kept_id"), (F.col("c") > 1).alias("repeated")), "kept-ids")
    once = kept.where("not repeated or _kept_id is null")
    # The ids grow with the input: never broadcast, whatever the size.
    stay = lambda ids: docs.join(ids.hint("merge"), docs["doc_id"].eqNullSafe(ids["_kept_id"]), "left_semi")
    repeated = kept.where("repeated and _kept_id is not null")
    if repeated.isEmpty():
        return stay(once)
    best = stay(repeated).groupBy("doc_id").agg(F.max_by(F.struct(*docs.columns), F.struct(F.length(text_or_empty()), "text")).alias("row"))
    return stay(once).unionByName(best.select("row.*").select(*docs.columns))
