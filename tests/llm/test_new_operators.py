"""Attention quality, prefix trie and hard negatives against brute force, on small tables with nulls, empty and long values, ties, repeated
rows, extra columns of clashing names, and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import attention_quality, hard_negatives, prefix_trie


# --- attention quality ---

def _bags(seed=1):
    r = np.random.default_rng(seed)
    return r.random((5, attention_quality.STYLE)), r.integers(0, 50, 17), np.array([0, 4, 4, 9, 12, 17]), np.array([0, 2, 5]), np.array([0.0, 1.0])


def test_attention_gradient_is_that_of_the_loss():
    style, bucket, words, first, label = _bags()
    m = attention_quality._initial(np.random.default_rng(2))

    def loss():
        p = attention_quality.forward(m, style, bucket, words, first)["p"]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    g = attention_quality.gradient(m, style, bucket, words, first, label)
    for name, x in m.items():
        flat = x.ravel()
        for i in (0, len(flat) - 1) if name != "E" else (int(bucket[0]) * attention_quality.DIM, int(bucket[9]) * attention_quality.DIM + 3):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[name].ravel()[i]) < 1e-6, name


def test_attention_weights_are_a_softmax_over_each_documents_passages():
    style, bucket, words, first, _ = _bags()
    m = attention_quality._initial(np.random.default_rng(2))
    f = attention_quality.forward(m, style, bucket, words, first)
    for d in range(2):
        h = [np.tanh(style[k] @ m["W"] + (m["E"][bucket[words[k]:words[k + 1]]].mean(0) if words[k + 1] > words[k] else 0) + m["b"])
             for k in range(first[d], first[d + 1])]
        e = np.array([np.tanh(x @ m["V"]) / (1 + np.exp(-(x @ m["U"]))) @ m["w"] for x in h])
        a = np.exp(e) / np.exp(e).sum()
        assert np.allclose(f["a"][first[d]:first[d + 1]], a)
        assert math.isclose(f["p"][d], 1 / (1 + math.exp(-(a @ np.array(h) @ m["c"] + m["c0"][0]))))


def test_passages_cover_whole_texts(monkeypatch):
    r = random.Random(4)
    texts = ["", " \n ", "one", " ".join(r.choice(["Ab", "cd!", "é9"]) for _ in range(1000)), "x" * 5000, "  a b  "]
    for chunk in (1 << 22, 300):
        monkeypatch.setattr(attention_quality, "CHUNK", chunk)
        got = attention_quality.Passages(texts)
        assert len(got.first) == len(texts) + 1 and (np.diff(got.first) >= 1).all()
        for i, t in enumerate(texts):
            words = int(got.words[got.first[i + 1]] - got.words[got.first[i]])
            assert words == len(t.split()) or (chunk == 300 and i == 4)  # a word longer than a piece is cut
        assert got.first[4] - got.first[3] >= -(-1000 // attention_quality.PASSAGE)


def _quality_docs(n=240):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(20, 400))]
        bad = i % 3 == 0
        if bad:  # one passage decides
            at = r.randrange(len(words))
            words[at:at + 60] = [w.upper() + "!!" for w in words[at:at + 60]] + ["BUY!!"] * 30
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_quality_learns_from_document_labels_and_holds_out(spark, docs_of):
    docs, labels = _quality_docs()
    odd = [(1000, None), (1001, ""), (1002, " \t"), (None, "some text"), (3, docs[3][1]), (1003, "word " * 60_000)]
    labels += [(None, 1, 0), (5, None, 0), (7, 1, 0)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = attention_quality.quality(docs_of(docs + odd), frame).collect()
    assert len(out) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[3]) == 1
    held = [(r["doc_id"] % 3 != 0, r["predicted"]) for r in out if r["held_out"] and r["doc_id"] < 240]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.9
    # Labels of held-out rows change nothing.
    flipped = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    again = attention_quality.quality(docs_of(docs), spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in out if r["doc_id"] is not None and r["doc_id"] < 240}


def test_quality_without_labels_or_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in attention_quality.quality(docs_of([(1, "a b"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert attention_quality.quality(docs_of([]), none).collect() == []


# --- prefix trie ---

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, rep long, top long, seg int, shard string, l long, d long"


def _trie_by_force(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members, children = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    saved, leaves, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        mine = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p], leaves[p] = mine + sum(saved[q] for q in below), sum(leaves[q] for q in below) if below else 1
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(p))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(children.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(seed, n, longest, texts):
    r = random.Random(seed)
    rows = [(c if r.random() < 0.98 else None, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]) if r.random() < 0.2 else "user",
             r.choice(texts)) for c in range(n) for t in range(r.randint(0, longest))]
    return rows + r.sample(rows, min(len(rows), 5))


LONG = [(-7, i, "user", "a") for i in range(40)] + [(100, i, "user", "a") for i in range(41)] + [(2000, 0, "user", "word " * 30_000)]


@pytest.mark.parametrize("rows, group, seg", [
    ([], 10, 64), ([(5, 0, "user", "a b")], 10, 64),
    (_turns(1, 40, 4, ["a", "b c", " ", None]), 7, 2),
    (_turns(2, 60, 9, ["a", "b c"]), 3, 2),
    (_turns(3, 60, 9, ["a"]), 2, 3),
    (_turns(4, 30, 12, ["a", "b"]) + LONG, 1, 4),
    (_turns(5, 80, 5, ["a", "b", None]) + LONG, 1000, 64)])
def test_prefix_trie_equals_brute_force(spark, rows, group, seg):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5) for r in rows], TURNS)
    got = sorted((tuple(r[c] for c in TRIE) for r in prefix_trie.prefix_nodes(df, group, seg).collect()), key=str)
    assert got == _trie_by_force(rows)


def test_range_minima_by_binary_search():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 65):
        v = r.integers(-1, 6, n)
        table = prefix_trie.Minima(v)
        at, d = np.repeat(np.arange(n), 8), np.tile(np.arange(-1, 7), n)
        right, left = table.right(at, d), table.left(at, d)
        for i, x, a, b in zip(at, d, right, left):
            assert a == next((j for j in range(i, n) if v[j] < x), n) and b == next((j for j in range(i, -1, -1) if v[j] < x), -1)
        lo, hi = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
        assert all(m == (v[a:b + 1].min() if b >= a else prefix_trie.INF) for a, b, m in zip(lo, hi, table.of(lo, hi)))


# --- hard negatives ---

VECTORS = "vec_id long, embedding array<double>, label int, id long, block int, dim string, tree int, score double"
MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _mined_by_force(rows, positives=5, negatives=3):
    some = [(i, label, [math.floor(x * 256) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v and None not in v and all(map(math.isfinite, v))]
    out = []
    for i, label, v in some:
        if i % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in some if j != i and len(w) == len(v))
            for p, j, _ in [s for s in scores if s[2] == label][:positives]:
                fits = [s for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
                out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fits[:negatives])]
    return sorted(out)


def _vectors():
    r = np.random.default_rng(3)
    plain = [(i, (r.normal(size=6) + i % 3).tolist(), i % 4) for i in range(400)]
    odd = plain[:200] + plain[:30] + [
        (5, None, 1), (10, [float("nan")] * 6, 1), (None, [1.0] * 6, 1), (15, [1.0] * 6, None), (20, [], 1), (25, [None] * 6, 2),
        (30, [1.0, 1.0], 0), (31, [2.0, 1.0], 0), (32, [1.2, 0.9], 1), (33, [1e-9, 0.0], 1)]
    odd += [(1000 + i, [0.5] * 6, i % 4) for i in range(60)] + [(i, [-1.0] * 6, i % 4) for i in range(500, 530)]
    return {"empty": [], "one": plain[:1], "plain": plain, "odd": odd,
            "ties": [(i, [float(r.integers(0, 3)) * 1e6 for _ in range(8)], i % 3) for i in range(120)],
            "beyond 2^53": [(i, (r.normal(size=4) * 6e5).tolist(), i % 3) for i in range(60)]}


@pytest.mark.parametrize("name", ["empty", "one", "plain", "odd", "ties", "beyond 2^53"])
def test_hard_negatives_equal_brute_force(spark, name):
    rows = _vectors()[name]
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, 4.0) for r in rows], VECTORS)
    mined = hard_negatives.mine(df, is_anchor=F.col("vec_id") % 5 == 0, size=20, block_size=9, leaf=4)
    got = sorted(tuple(r[c] for c in MINED) for r in mined.collect())
    assert got == _mined_by_force(rows)


def test_ranges_prune_and_lose_nothing():
    """On crowded rows most subtrees go by their ranges alone, and what is left holds all that lies in the windows."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 8)) * 400
    data = np.floor(centres[r.integers(0, 12, 1500)] + r.normal(size=(1500, 8)) * 10)
    ids, labels = np.arange(1500), r.integers(0, 3, 1500)
    radius = float(np.sqrt((data ** 2).sum(1).max()))
    tree = hard_negatives.build(ids, labels, data, radius)
    q, n = data[:40], 40
    scores = q @ data.T
    top = scores.max(1)
    least, most = np.ceil(0.5 * top).astype(np.int64), np.floor(0.95 * top).astype(np.int64)
    items = hard_negatives.Items(np.arange(n), least, most, 3)
    work = hard_negatives.search(tree, q, ids[:40], labels[:40], items, same=False)
    for i in range(n):
        fits = sorted((-int(s), int(j)) for j, s in enumerate(scores[i]) if labels[j] != labels[i] and least[i] <= s <= most[i])[:3]
        got = [(-int(s), int(j)) for s, j in zip(items.score[i], items.id[i]) if s != hard_negatives.LEAST]
        assert got == fits
    assert work["pruned"] > 0.3 * work["subtrees"] and work["rows"] < 0.5 * n * len(data)
