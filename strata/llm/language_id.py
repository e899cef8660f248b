"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built from a bounded sample of labelled text
(``ref_chars`` characters per language, from about ``docs_per_lang`` documents, at most
``slice_chars`` of each; these are parameters of the fit only). A text is cross-parsed
with each automaton: the next phrase is the longest string that occurs in the reference.
With c phrases over n symbols and a reference of N symbols, the cross-parsing entropy is
c * log2(N) / n; the language with the lowest one wins (ties: first name).

Symbols are lower-case letters, all that the references hold; every run of other characters is one space.
Transitions by the commonest letters are in a dense table, those by all others are sorted keys. Whole texts
are parsed, in blocks of ``BLOCK`` symbols that each begin a new phrase, so that numpy
steps through thousands of blocks at a time. The references travel in the task closure
(a few tens of KB); each Python worker builds the automata once.

Defined cases: a null text, or one without a letter, gets ``und`` and score 0; with no
labelled text at all everything is ``und``. Letters that no reference has are phrases of
one symbol in every language. The score is the margin of the winner over the runner-up,
1 - h_best / h_second, in 0 to 1 (1 if only one language is known). Repeated rows get
equal answers; other columns are carried or ignored; an empty table gives none.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import map_arrow, runs, ship, slices, trim

BLOCK = 512
DENSE, CELLS = 120, 40_000_000  # columns and cells of the dense table at most; what they are does not change results
SPACE, UNKNOWN = 0, 1


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(labelled: DataFrame, ref_chars: int = 24_000, docs_per_lang: int = 96, slice_chars: int = 1_500) -> dict[str, str]:
    """Reference text per language, from rows (doc_id, text, lang). What reaches the driver is
    bounded: a hash of id and text picks about 2 * docs_per_lang different documents per language, at most twice that in all."""
    rows = labelled.where("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, 2.0 * docs_per_lang / n)])
    draw = (F.xxhash64("doc_id", "text", F.lit(9)) % 1_000_003 + 1_000_003) % 1_000_003
    picked = rows.where(draw / 1_000_003.0 < share[F.col("lang")])
    start = F.greatest(F.lit(1), F.floor((F.length("text") - slice_chars) * (draw / 1_000_003.0)).cast("int"))
    sample = picked.select("lang", draw.alias("d"), F.substring(F.col("text"), start, F.lit(slice_chars)).alias("t"))
    sample = sample.distinct().orderBy("d", "lang", "t").limit(4 * docs_per_lang * len(counts)).collect()
    out: dict[str, str] = {}
    for lang in sorted(counts):
        text, seen = [], set()
        for r in sorted((r for r in sample if r["lang"] == lang), key=lambda r: (r["d"], r["t"])):
            if r["t"] not in seen and any(map(str.isalpha, r["t"])):
                seen.add(r["t"])
                text.append(r["t"])
        if text:
            out[lang] = " ".join(text)[:ref_chars]
    return out


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _squeeze(codes: np.ndarray) -> np.ndarray:
    """Runs of spaces become one."""
    space = codes == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    if len(keep):
        keep[0] = True
    return codes[keep]


def suffix_automaton(codes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``: symbol -> next state, per state; state 0 is the root."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """Cross-parses texts against several references at once.

    States of all languages share one numbering from 1. ``flat[state * width + symbol]`` holds the next state, or its
    negative where the symbol begins a new phrase. Symbols from ``width`` on are looked up among ``keys``,
    state * symbols + symbol; where there is none, ``first`` has the state after the language's root."""

    def __init__(self, refs: dict[str, str]):
        self.langs = sorted(refs)
        letters = Counter(c for t in refs.values() for c in t.lower() if c.isalpha())
        known = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))]
        self.lut = np.where(_letters(), UNKNOWN, SPACE).astype(np.int32)
        for i, c in enumerate(known):
            self.lut[ord(c)] = i + 2
        self.symbols = len(known) + 2
        roots, base, self.bits, edges = [], 1, [], []
        self.first = np.zeros((len(self.langs), self.symbols), np.int32)
        for j, lang in enumerate(self.langs):
            codes = _squeeze(self.lut[_points(refs[lang])])
            t = suffix_automaton(codes.tolist())
            e = np.array([(s, c, v) for s, row in enumerate(t) for c, v in row.items()], np.int64).reshape(-1, 3)
            e[:, 0] += base
            e[:, 2] += base
            root = e[:, 0] == base
            self.first[j] = base
            self.first[j, e[root, 1]] = e[root, 2]
            e[root, 2] *= -1
            edges.append(e)
            roots.append(base)
            base += len(t)
            self.bits.append(math.log2(max(2, len(codes))))
        self.roots = np.array(roots, np.int32)
        self.width = min(self.symbols, 2 + max(0, min(DENSE, CELLS // base - 2)))
        flat = np.zeros((base, self.width), np.int32)
        for j, root in enumerate(roots):
            flat[root:([*roots, base][j + 1])] = -self.first[j, :self.width]
        edge = np.concatenate([np.zeros((0, 3), np.int64), *edges])
        common = edge[:, 1] < self.width
        flat[edge[common, 0], edge[common, 1]] = edge[common, 2]
        self.flat = flat.ravel()
        rare = edge[~common]
        keys = rare[:, 0] * self.symbols + rare[:, 1]
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.next = np.append(rare[order, 2], 0).astype(np.int32)

    def _rare(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What ``flat`` would hold for symbols from ``width`` on."""
        key = state.astype(np.int64) * self.symbols + codes
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.next[at], -self.first[:, codes])

    def phrases(self, docs: list[np.ndarray]) -> np.ndarray:
        """Phrases per document and language of squeezed code arrays."""
        doc, cols, size = [], [], []
        for i, codes in enumerate(docs):
            for s in range(0, len(codes), BLOCK):
                block = codes[s:s + BLOCK]
                doc.append(i)
                cols.append(block)
                size.append(len(block))
        out = np.zeros((len(self.langs), len(docs)), np.int64)
        if not cols:
            return out.T
        order = np.argsort(-np.array(size), kind="stable")
        size = np.array(size)[order]
        codes = np.zeros((int(size[0]), len(order)), np.int32)
        for j, k in enumerate(order):
            codes[:size[j], j] = cols[k]
        state = np.repeat(self.roots[:, None], len(order), 1)
        count = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
        rare = codes >= self.width
        some = rare.any(1)
        dense = np.where(rare, UNKNOWN, codes)
        for k, n in enumerate(live):
            v = self.flat.take(state[:, :n] * self.width + dense[k, :n])
            if some[k]:
                at = np.flatnonzero(rare[k, :n])
                v[:, at] = self._rare(state[:, at], codes[k, at])
            count[:, :n] += v < 0
            np.abs(v, out=state[:, :n])
        doc = np.array(doc)[order]
        for j in range(len(self.langs)):
            out[j] = np.bincount(doc, count[j], len(docs)).astype(np.int64)
        return out.T

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, float | None]]:
        """(language, score, entropy in bits per symbol, entropy without the first phrase) of each text."""
        docs, n = [], []
        for t in texts:
            codes = _squeeze(self.lut[_points(t)]) if t else np.zeros(0, np.int32)
            ok = bool(len(codes)) and bool((codes != SPACE).any()) and bool(self.langs)
            docs.append(codes if ok else codes[:0])
            n.append(len(codes) if ok else 0)
        c = self.phrases(docs)
        out = []
        for i, m in enumerate(n):
            if not m:
                out.append(("und", 0.0, None, None))
                continue
            h = [(float(c[i, j]) * self.bits[j] / m, lang, self.bits[j]) for j, lang in enumerate(self.langs)]
            h.sort()
            out.append((h[0][1], max(0.0, 1 - h[0][0] / h[1][0]) if len(h) > 1 else 1.0, h[0][0], h[0][0] - h[0][2] / m))
        return out


_PARSERS: dict[tuple, Parser] = {}


def _parser(refs: dict[str, str]) -> Parser:
    key = tuple(sorted(refs.items()))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(refs)
    return _PARSERS[key]


def predict(docs: DataFrame, refs: dict[str, str], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep`` and lang_pred, score, entropy, excess (entropy without the first phrase) of every text."""
    cols = docs.select(*keep, F.col(text).cast("string").alias("_text"))

    def run(batches):
        parser = _parser(refs)
        for *kept, texts in slices(batches, 1 << 21, len(keep)):
            got = parser.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k, t) for k, t in zip(kept, types)), pa.array([g[0] for g in got], pa.string()),
                 *(pa.array([g[k] for g in got], pa.float64()) for k in (1, 2, 3))],
                [*keep, "lang_pred", "score", "entropy", "excess"])

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(cols.schema[k].dataType) for k in keep]
    schema = ", ".join([*(f"`{k}` {cols.schema[k].dataType.simpleString()}" for k in keep),
                        "lang_pred string", "score double", "entropy double", "excess double"])
    return map_arrow(cols, run, schema)


def own_limits(refs: dict[str, str], limit: float) -> dict[str, float]:
    """``limit``, or more for a language whose own text takes more bits per symbol (a large alphabet): what the second half
    of its reference takes by the first, and a quarter, but at most half way to a phrase a symbol."""
    out = {}
    for lang, ref in refs.items():
        half = Parser({lang: ref[:len(ref) // 2]})
        own = half.predict([ref[len(ref) // 2:]])[0][3]
        out[lang] = limit if own is None else max(limit, min(1.25 * own, (own + half.bits[0]) / 2))
    return out


def known_language(docs: DataFrame, refs: dict[str, str], limit: float = 6.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a letter and reads like a learned language: beyond the
    first phrase at most ``limit`` bits per symbol (of the given languages their own takes about 2.5, a foreign one about 7),
    or more where the language itself takes more (``own_limits``)."""
    most = own_limits(refs, limit)
    ship(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        parser = _parser(refs)
        got = [g for some in runs(texts) for g in parser.predict(some)]
        trim()
        return pa.array([g[0] != "und" and g[3] <= most[g[0]] for g in got], pa.bool_())

    # Only the text goes to Python; the other columns stay where they are.
    return docs.where(F.arrow_udf(run, "boolean")(F.col("text").cast("string")))


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy: learned from rows that are not held out."""
    refs = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), **options)
    return predict(docs, refs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy")
