"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages: consecutive runs of ``PASSAGE`` words that cover its whole text. A passage is encoded as
h = tanh(W s + mean of its words' hashed embeddings + b), where s are shares of byte kinds, the mean word length and the share of
words the text had before. Gated attention weighs the passages, a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))), and the
document's score is sigmoid(c . sum_k a_k h_k + c0). Labels are given for documents only; which passages decide is learned.

Fit: a bounded, hash-drawn sample of at most ``max_labelled`` labelled documents, each with at most ``max_passages`` evenly spaced
passages (parameters of the fit only). The sample is dealt into ``PARTS`` parts; in every round each part goes through its documents
(until it made ``STEPS`` steps) by Adam on the cross-entropy, from the common weights, and the driver averages the weights (``PARTS`` vectors of fixed size, about
0.5 MB each). Scoring reads whole texts, passage by passage, in one pass without a shuffle.

Defined cases: a null text is empty; a text without words is one passage without words, so it gets a score like any other. Labels with
a null id or quality are not used; an id labelled twice counts once per distinct label. With no usable label every score is 0.5.
Repeated rows get equal scores; rows with a null doc_id are scored and never learned from; an empty table gives no row. Pieces of
``CHUNK`` bytes, cut at white space, start a new passage; "had before" is counted within such a piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import cut, map_arrow, slices, text_or_empty
from strata.llm.words import _hashes

PASSAGE, CHUNK = 64, 1 << 22
BUCKETS, DIM, GATE = 1 << 13, 12, 8
PARTS, ROUNDS, STEPS, BATCH, RATE = 8, 10, 16, 32, 0.01
_KINDS = [b" ", b"\n\r\t\x0b\x0c", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b".", b",", b"!", b"?", b"|", b"%", b"$", b"&",
          b"*", b"#", b":;", b"'\"`", b"()[]{}", b"-_/\\", b"@", b"<>=+~^", bytes(range(128, 256))]
_KIND = np.full(256, len(_KINDS), np.int64)
for _i, _k in enumerate(_KINDS):
    _KIND[list(_k)] = _i
STYLE = len(_KINDS) + 1 + 2


def _pieces(data: bytes) -> list[bytes]:
    out, at = [], 0
    while len(data) - at > CHUNK:
        end = max(data.rfind(w, at, at + CHUNK) for w in (b" ", b"\n", b"\t", b"\r"))
        end = end + 1 if end >= at else at + CHUNK
        out.append(data[at:end])
        at = end
    return [*out, data[at:]]


class Passages:
    """The passages of several texts: ``style`` (a row each), ``bucket`` (a word each), ``words`` (words before each passage,
    and all), ``first`` (passages before each text, and all)."""

    def __init__(self, texts: list[str]):
        pieces, owner = [], []
        for i, t in enumerate(texts):
            for p in _pieces(t.encode("utf-8", "surrogatepass")):
                pieces.append(p)
                owner.append(i)
        raw = b"\n".join(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
        parts = self._words(raw, begin, lengths)
        hashes, start, piece = parts
        before = np.searchsorted(piece, np.arange(len(pieces) + 1))  # words before each piece
        index = np.arange(len(hashes)) - before[piece]
        head = np.flatnonzero(index % PASSAGE == 0)
        bare = np.flatnonzero(before[1:] == before[:-1])  # pieces without words
        where = np.concatenate((np.where(index[head] == 0, begin[piece[head]], start[head]), begin[bare]))
        mine = np.concatenate((piece[head], bare))
        at_word = np.concatenate((head, before[bare]))
        order = np.argsort(mine, kind="stable")
        where, mine, at_word = where[order], mine[order], at_word[order]
        last = np.append(mine[1:] != mine[:-1], True) if len(mine) else np.zeros(0, bool)
        until = np.where(last, (begin + lengths)[mine], np.append(where[1:], 0))
        n, size = len(where), until - where
        bytes_of = np.repeat(np.arange(n), size)
        at = np.arange(int(size.sum())) + np.repeat(where - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        kinds = np.bincount(bytes_of * (len(_KINDS) + 1) + _KIND[np.frombuffer(raw, np.uint8)[at]],
                            minlength=n * (len(_KINDS) + 1)).reshape(n, -1)
        self.words = np.append(at_word, len(hashes)).astype(np.int64)
        count = np.diff(self.words)
        seen = np.ones(len(hashes))
        if len(hashes):
            own = hashes ^ (piece.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            seen[np.unique(own, return_index=True)[1]] = 0
        had = np.concatenate(([0], np.cumsum(seen)))
        had = (had[self.words[1:]] - had[self.words[:-1]]) / np.maximum(count, 1)
        share = np.sqrt(kinds / np.maximum(size, 1)[:, None])
        self.style = np.column_stack((share, np.log1p(size / np.maximum(count, 1)) / 4, had)).astype(np.float32)
        self.bucket = (hashes >> np.uint64(64 - 13)).astype(np.int32)
        texts_of = np.array(owner, np.int64)[mine]
        self.first = np.searchsorted(texts_of, np.arange(len(texts) + 1))

    @staticmethod
    def _words(raw: bytes, begin, lengths):
        """Hash, byte offset and piece of every word; about ``CHUNK`` bytes at a time."""
        hashes, start, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while at < len(begin):
            end = int(np.searchsorted(begin, begin[at] + CHUNK, side="left"))
            end = max(end, at + 1)
            stop = int(begin[end - 1] + lengths[end - 1])
            h, s = _hashes(raw[begin[at]:stop].lower())
            hashes.append(h)
            start.append(s + begin[at])
            at = end
        h, s = np.concatenate(hashes), np.concatenate(start)
        return h, s, np.searchsorted(begin, s, side="right") - 1


def _initial(rng) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return rng.normal(0, scale, shape)
    return {"E": normal(BUCKETS, DIM, scale=0.05), "W": normal(STYLE, DIM, scale=1.0), "b": np.zeros(DIM), "V": normal(DIM, GATE, scale=0.3),
            "U": normal(DIM, GATE, scale=0.3), "w": normal(GATE, scale=0.3), "c": normal(DIM, scale=0.3), "c0": np.zeros(1)}


_SHAPES = {k: v.shape for k, v in _initial(np.random.default_rng(0)).items()}


def _flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in _SHAPES])


def _unflat(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[k] = x[at:at + n].reshape(shape).copy()
        at += n
    return out


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``x`` between consecutive entries of ``first``."""
    out = np.zeros((len(first) - 1, *x.shape[1:]), x.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(x, first[full], axis=0)
    return out


def forward(m: dict, style: np.ndarray, bucket: np.ndarray, words: np.ndarray, first: np.ndarray) -> dict:
    """All intermediate values, ``p`` (score of each document) and ``a`` (weight of each passage) among them."""
    count = np.maximum(np.diff(words), 1)[:, None]
    h = np.tanh(style @ m["W"] + _sums(m["E"][bucket], words) / count + m["b"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * g) @ m["w"]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    e = np.exp(e - np.abs(m["w"]).sum())  # e is at most the sum of |w|
    a = e / _sums(e, first)[doc]
    z = _sums(a[:, None] * h, first)
    logit = np.clip(z @ m["c"] + m["c0"][0], -40, 40)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-logit)), "doc": doc, "count": count}


def gradient(m: dict, style, bucket, words, first, label: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of the documents' scores."""
    f = forward(m, style, bucket, words, first)
    d = (f["p"] - label) / len(label)
    out = {"c": f["z"].T @ d, "c0": np.array([d.sum()])}
    per = d[f["doc"]][:, None] * m["c"]  # gradient of z, by passage
    dh = f["a"][:, None] * per
    da = (per * f["h"]).sum(1)
    de = f["a"] * (da - _sums(f["a"] * da, first)[f["doc"]])
    gated = f["t"] * f["g"]
    out["w"] = gated.T @ de
    dg = de[:, None] * m["w"]
    dt, ds = dg * f["g"] * (1 - f["t"] ** 2), dg * f["t"] * f["g"] * (1 - f["g"])
    out["V"], out["U"] = f["h"].T @ dt, f["h"].T @ ds
    dx = (dh + dt @ m["V"].T + ds @ m["U"].T) * (1 - f["h"] ** 2)
    out["W"], out["b"] = style.T @ dx, dx.sum(0)
    per_word = np.repeat(dx / f["count"], np.diff(words), axis=0)
    out["E"] = np.column_stack([np.bincount(bucket, per_word[:, k], BUCKETS) for k in range(DIM)])
    return out


def _epoch(x: np.ndarray, bags: list[tuple], rng, rate: float) -> np.ndarray:
    """Adam over ``bags`` (label, style, bucket, words per passage) from the weights ``x``: whole passes, ``STEPS`` batches at least."""
    m1, m2, step = np.zeros_like(x), np.zeros_like(x), 0
    passes = -(-STEPS * min(BATCH, len(bags)) // len(bags))
    order = np.concatenate([rng.permutation(len(bags)) for _ in range(passes)])
    for at in range(0, len(order), BATCH):
        some = [bags[i] for i in order[at:at + BATCH]]
        style = np.concatenate([b[1] for b in some])
        bucket = np.concatenate([b[2] for b in some])
        words = np.concatenate(([0], np.cumsum(np.concatenate([b[3] for b in some])))).astype(np.int64)
        first = np.concatenate(([0], np.cumsum([len(b[1]) for b in some])))
        g = _flat(gradient(_unflat(x), style, bucket, words, first, np.array([b[0] for b in some], np.float64)))
        step += 1
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        x = x - rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return x


_SAMPLE = "part int, id long, label double, style binary, bucket binary, words binary"


def _sample(docs: DataFrame, labelled: DataFrame, max_labelled: int, max_passages: int) -> DataFrame:
    """Passages of the drawn documents."""
    known = labelled.where("doc_id is not null and label is not null").select(
        F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("double").alias("_label")).distinct()
    known = known.orderBy(F.xxhash64("_id", F.lit(11)), "_id", "_label").limit(max_labelled)
    # At most max_labelled rows of two numbers: bounded by the parameter.
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty().alias("_text")).join(F.broadcast(known), "_id")
    # A repeated doc_id counts once; so the sample holds max_labelled documents at most.
    rows = rows.groupBy("_id", "_label").agg(F.max("_text").alias("_text")).select("_id", "_text", "_label")

    def run(batches):
        for ids, texts, labels in slices(batches, 1 << 20):
            got = Passages(texts)
            out = []
            for i, label in enumerate(labels):
                lo, hi = got.first[i], got.first[i + 1]
                take = lo + np.unique(np.linspace(0, hi - lo - 1, min(max_passages, hi - lo)).astype(np.int64))
                out.append((ids[i] % PARTS, ids[i], label, got.style[take].tobytes(),
                            np.concatenate([got.bucket[got.words[k]:got.words[k + 1]] for k in take]).astype(np.int32).tobytes(),
                            (got.words[take + 1] - got.words[take]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (
                pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()))], ["part", "id", "label", "style", "bucket", "words"])

    return map_arrow(rows, run, _SAMPLE)


def _round(x: np.ndarray, k: int):
    """What a part does in round ``k`` from the weights ``x``."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["id"], r["label"]))
        bags = [(r["label"], np.frombuffer(r["style"], np.float32).reshape(-1, STYLE), np.frombuffer(r["bucket"], np.int32),
                 np.frombuffer(r["words"], np.int64)) for r in rows]
        part = rows[0]["part"]
        got = _epoch(x, bags, np.random.default_rng([k, part]), RATE / (1 + k / 3))
        return pa.table({"part": pa.array([part], pa.int32()), "n": pa.array([len(rows)], pa.int64()),
                         "x": pa.array([got.astype(np.float32).tobytes()], pa.binary())})

    return run


def fit(docs: DataFrame, labelled: DataFrame, max_labelled: int = 4_000, max_passages: int = 24, rounds: int = ROUNDS) -> np.ndarray | None:
    """Weights from ``docs`` (doc_id, text) and ``labelled`` (doc_id, label 0 or 1); None without a usable label."""
    sample = cut(_sample(docs, labelled, max_labelled, max_passages), "quality-sample")
    x = _flat(_initial(np.random.default_rng(11)))
    for k in range(rounds):
        got = sample.groupBy("part").applyInArrow(_round(x, k), "part int, n long, x binary").collect()  # PARTS rows of fixed size
        if not got:
            return None
        got.sort(key=lambda r: r["part"])
        x = sum(np.frombuffer(r["x"], np.float32).astype(np.float64) * r["n"] for r in got) / sum(r["n"] for r in got)
    return x.astype(np.float32)


def scored(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """doc_id, score, n_passages and top_weight (the largest attention weight) of every whole text."""
    cols = docs.select("doc_id", text_or_empty().alias("_text"))

    def run(batches):
        model = None if weights is None else _unflat(weights)
        for ids, texts in slices(batches, 1 << 20):
            got = Passages(texts)
            n = np.diff(got.first)
            if model is None:
                p, top = np.full(len(texts), 0.5), 1.0 / n
            else:
                f = forward(model, got.style, got.bucket, got.words, got.first)
                p, top = f["p"], np.maximum.reduceat(f["a"], got.first[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(p.astype(np.float64)), pa.array(n.astype(np.int64)),
                                              pa.array(top.astype(np.float64))], ["doc_id", "score", "n_passages", "top_weight"])

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(cols.schema["doc_id"].dataType)
    return map_arrow(cols, run, f"doc_id {cols.schema['doc_id'].dataType.simpleString()}, score double, n_passages long, top_weight double")


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, top_weight: labels are learned from rows that are not held out."""
    known = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    out = scored(docs, fit(docs, known, **options))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      "n_passages", "top_weight")
