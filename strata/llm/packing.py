"""Packing documents into fixed-length sequences: linear grouping, configurations, best fit.

1. Every document becomes its token ids plus an end mark; only those longer than a sequence are cut.
2. The lengths of the pieces are counted: at most ``capacity`` distinct lengths, however many
   documents there are. From this histogram the driver makes the whole plan; it is bounded by
   the capacity, not by the data.
3. Linear grouping: large pieces (longer than a fraction of the capacity) are sorted by length and dealt to
   a few groups of equal cardinality; every length is rounded up to the longest of its group. With
   so few sizes, sequences are filled by configurations: repeatedly the multiset of rounded sizes that starts
   with the longest one left and fills the sequence best (a knapsack over the capacity), used as often as the
   counts allow.
4. Substitution: in each group, actual pieces take the slots in order, longest first, so pieces of one length
   fill runs of equal slots, and what rounding wasted becomes room.
5. Small pieces go in best fit, longest first: to the sequence with the least room that still holds them, all
   sequences with equal room and equally many equal pieces at a time; new sequences open when none fits.

Planning takes well under a second, so it is done for each of ``SCHEMES`` and the plan with the fewest
sequences is used. It says, for each length, which rank range of its pieces goes to which sequences. Ranks are
handed out in parallel: pieces are counted per (length, shard), shards are laid end to end, and a
window numbers the pieces of one shard, so that a length shared by a third of all pieces is spread over
``SHARDS`` tasks or more.

Defined cases: null or empty text is the end mark alone. Repeated rows are documents of their own, told apart by
a row key. A null doc_id is carried. Empty input gives no row. Special-token strings inside a text follow the
tokenizer file. The tokenizer's path is a parameter.
"""

from __future__ import annotations

import array
import bisect
import functools
import re
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.util import cut, map_arrow, slices, text_or_empty

CAPACITY, END_ID = 4096, 1
SCHEMES = ((4, 16), (3, 16), (2, 16), (8, 16), (4, 64))  # (large: over capacity / this, groups); the best plan counts
SHARDS = 64
CACHE = 250_000  # pieces of words, in two generations


class _Known(dict):
    """What ``make`` gives for a key, kept for the keys used last: at most twice ``most``. When a generation is full it becomes the old one, from which
    keys in use come back; rare keys go with it, and frequent ones are not made again."""

    def __init__(self, make, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


class Tokens:
    """Token ids of whole texts by a cache of what a ``tokenizers`` file's pre-tokenizer cuts texts into; it never joins characters across
    white space. One expression cuts a whole text of the plain range, so "Word," and "word" share an entry. Of other texts, words
    outside that range go to the tokenizer as a whole, as do texts that hold control separators or special-token marks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.bytes = {b: chr(other.get(b, b)) for b in range(256)}
        self.tokenize = self.tokenizer.model.tokenize
        self.pieces = _Known(self._piece, CACHE // 2)
        self.words = _Known(self._word, CACHE // 8)  # of texts outside the plain range
        low = [c for c in map(chr, range(0x180)) if re.match(r"[\x21-\x7e\xa1-\xac\xae-ſ]", c) and (unicodedata.category(c)[0] != "N" or c in "0123456789")]
        letters = "".join(c for c in low if re.match(r"[^\W\d_]", c))
        space = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
        self.plain = re.compile(f"[{re.escape(''.join(low) + space)}]*").fullmatch
        # The cuts of the pre-tokenizer in plain text: contractions, letters, single digits, other characters.
        self.find = re.compile(rf"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|\d|[^\s\d{letters}]+").findall

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():  # an ASCII piece is spelled as it is: white space and control characters are in none
            piece = piece.encode().decode("latin-1").translate(self.bytes)
        return array.array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text.lower())))

    def _word(self, word: str) -> bytes:
        if self.plain(word):
            return self._plain(word)
        return array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        ids = b"".join(map(self.words.__getitem__, text.split())) if not self.plain(text) else self._plain(text)
        return np.frombuffer(ids, "<u4")


@functools.lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``row`` numbers the input rows, ``with_ids`` adds the ids (little-endian uint32)."""
    path = path or default_path()
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.monotonically_increasing_id().alias("row"))

    def run(batches):
        tokens = _tokens(path)
        for doc_ids, texts, keys in slices(batches, 1 << 21):
            out = []
            for doc, text, key in zip(doc_ids, texts, keys):
                ids = np.append(tokens.encode(text), np.uint32(END_ID)).astype("<u4")
                for i, s in enumerate(range(0, len(ids), capacity)):
                    b = ids[s:s + capacity].tobytes()
                    out.append((doc, key, i, s, len(b) // 4, zlib.crc32(b), b if with_ids else None))
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"]
            n = 7 if with_ids else 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols[:n], kinds)], names[:n])

    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(cols, run, schema)


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, dealt to runs of (length, pieces) with equally many pieces each; a length may be split."""
    size = -(-sum(counts.values()) // groups) if counts else 1
    out, room = [], 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not room:
                out.append([])
                room = size
            k = min(n, room)
            out[-1].append((length, k))
            n -= k
            room -= k
    return out


def configurations(sizes: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(size -> pieces per sequence, sequences): patterns that place all pieces of few sizes."""
    left, out = dict(sizes), []
    while left:
        top = max(left)
        # Best filling of what the longest leaves, by a bounded knapsack over the sizes left.
        room = capacity - top
        reach: dict[int, tuple] = {0: ()}
        best = 0
        for s in sorted(left, reverse=True):
            most = min(room // s, left[s] - (s == top))
            if most <= 0 or best == room:
                continue
            for total, how in list(reach.items()):
                for m in range(1, min(most, (room - total) // s) + 1):
                    t = total + m * s
                    if t not in reach:
                        reach[t] = (*how, (s, m))
                        best = max(best, t)
        use = defaultdict(int, reach[best])
        use[top] += 1
        times = min(left[s] // m for s, m in use.items())
        out.append((dict(use), times))
        for s, m in use.items():
            left[s] -= m * times
            if not left[s]:
                del left[s]
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY, large: int = 4, groups: int = 16):
    """Ranges (length, first rank, pieces, first sequence, pieces per sequence): the pieces of that length with these
    ranks fill sequences in order, so many in each. Every piece is placed once; no sequence overflows."""
    out: list[tuple[int, int, int, int, int]] = []
    used = defaultdict(int)  # ranks handed out per length
    sequences = 0
    blocks: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs of sequences (first, n)
    big = {n: c for n, c in counts.items() if n > capacity // large}
    dealt = linear_groups(big, groups)
    sizes: dict[int, int] = defaultdict(int)
    supply: dict[int, list[list[int]]] = defaultdict(list)  # rounded size -> [length, pieces], longest first
    for g in dealt:
        sizes[g[0][0]] += sum(k for _, k in g)
        supply[g[0][0]] += [[length, k] for length, k in g]
    for use, times in configurations(sizes, capacity):
        slots = []  # per size: runs (length, sequences) for each of its places in the configuration
        for s, m in use.items():
            for _ in range(m):
                runs, need = [], times
                while need:
                    length, k = supply[s][0]
                    take = min(k, need)
                    runs.append((length, take))
                    need -= take
                    supply[s][0][1] -= take
                    if not supply[s][0][1]:
                        supply[s].pop(0)
                slots.append(runs)
        ends = sorted({0, *(sum(r[1] for r in runs[:i + 1]) for runs in slots for i in range(len(runs)))})
        at = [[0, 0] for _ in slots]  # run number, sequences of it used
        for a, b in zip(ends, ends[1:]):
            room = capacity
            for j, runs in enumerate(slots):
                length, n = runs[at[j][0]]
                out.append((length, used[length], b - a, sequences + a, 1))
                used[length] += b - a
                room -= length
                at[j][1] += b - a
                if at[j][1] == n:
                    at[j] = [at[j][0] + 1, 0]
            blocks[room].append((sequences + a, b - a))
        sequences += times
    rooms = sorted(blocks)
    for length in sorted((n for n in counts if n <= capacity // large), reverse=True):
        left = counts[length]
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):  # none fits: open new sequences
                per = capacity // length
                n = -(-left // per)
                fresh = n if left >= per * n else n - 1
                for m, k in ((per, fresh), (left - per * fresh, n - fresh)):
                    if k:
                        out.append((length, used[length], m * k, sequences, m))
                        used[length] += m * k
                        _add(blocks, rooms, capacity - m * length, (sequences, k))
                        sequences += k
                break
            room = rooms[i]
            first, n = blocks[room].pop()
            # Best fit keeps filling the same sequence while no other has less room that fits: pieces per
            # sequence in one go, as long as the room left is still the least that holds the length.
            per = 1 + (room - length) // length if room - length >= length else 1
            if per * n > left:
                per = max(1, min(per, left // n))
            take = min(n, left // per)
            if take < n:
                blocks[room].append((first + take, n - take))
            if not blocks[room]:
                del blocks[room], rooms[i]
            out.append((length, used[length], take * per, first, per))
            used[length] += take * per
            left -= take * per
            _add(blocks, rooms, room - per * length, (first, take))
    return out, sequences


def _add(blocks, rooms, room: int, run: tuple[int, int]):
    if room not in blocks or not blocks[room]:
        bisect.insort(rooms, room)
    blocks[room].append(run)


def ranked(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds ``rank`` (from 0) among the pieces of equal length, in an order fixed by row and piece."""
    shard = F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int")
    rows = rows.withColumn("shard", shard)
    sizes = rows.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "shard").orderBy("row", "piece")
    return rows.withColumn("k", F.row_number().over(inside) - 1).join(sizes, ["length", "shard"]).withColumn(
        "rank", F.col("base") + F.col("k")).drop("shard", "k", "base")


def place(rows: DataFrame, ranges) -> DataFrame:
    """Adds sequence_id by the plan's ranges (a table bounded by the capacity, looked up in the task)."""
    ranges = sorted(ranges)
    table = np.array(ranges, np.int64).reshape(-1, 5)
    starts = table[:, 0] * (1 << 45) + table[:, 1]

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            hit = table[np.searchsorted(starts, length * (1 << 45) + rank, side="right") - 1] if b.num_rows else table[:0]
            seq = hit[:, 3] + (rank - hit[:, 1]) // hit[:, 4] if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq, pa.int64())], [*b.schema.names, "sequence_id"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", sequence_id bigint"
    return map_arrow(rows, run, schema)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece."""
    rows = cut(pieces(docs, path, capacity, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    ranges, _ = min((plan(counts, capacity, *scheme) for scheme in SCHEMES), key=lambda p: p[1])
    shards = max(SHARDS, max(counts.values(), default=0) // 500_000)  # a shard of one length stays a task's work
    placed = place(ranked(rows, shards), ranges)
    order = Window.partitionBy("sequence_id").orderBy("rank", "length", "row", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
