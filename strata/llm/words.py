"""Word and shingle hashes of whole texts, computed for many texts at a time with numpy.

A word is a maximal run of bytes other than the six ASCII white-space characters, with A-Z
lower-cased. Its 64-bit hash is a polynomial of its bytes modulo 2^64, mixed with its length.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int):
    if len(_powers[0]) <= n:
        for i, p in enumerate((_P, _PINV)):
            a = np.full(max(n + 1, 1 << 20), p, np.uint64)
            a[0] = 1
            _powers[i] = np.multiply.accumulate(a)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(data: bytes, affixes: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and where each begins; with ``affixes`` a row for each word: its own hash, that
    of its first five bytes and that of its last two."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros((0, 3) if affixes else 0, np.uint64), np.zeros(0, np.int64)
    edge = np.diff(np.concatenate(([True], _SPACE[raw], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    _grow(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers[0][:len(raw)])))

    def span(a, b, tag=0):
        h = (total[b] - total[a]) * _powers[1][a]
        return mix(h + (b - a + (tag << 32)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    if affixes:
        return np.stack([span(start, end), span(start, np.minimum(end, start + 5), 1),
                         span(np.maximum(start, end - 2), end, 2)], 1), start
    return span(start, end), start


def word_hashes(texts: list[str | None], affixes: bool = False) -> list[np.ndarray]:
    """The hashes of each text's words, in order (with ``affixes``, of word, beginning and end)."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush():
        nonlocal size
        if held:
            h, start = _hashes(b"\n".join(held), affixes)
            ends = np.cumsum([len(b) + 1 for b in held])
            out.extend(np.split(h, np.searchsorted(start, ends[:-1])))
            held.clear()
            size = 0

    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass").lower()
        if size + len(b) > _CHUNK:
            flush()
        if len(b) <= _CHUNK:
            held.append(b)
            size += len(b)
            continue
        parts, at = [], 0  # a very long text: pieces cut at white space
        while at < len(b):
            end = min(len(b), at + _CHUNK)
            while end < len(b) and not _SPACE[b[end]]:
                end += 1
            parts.append(_hashes(b[at:end], affixes)[0])
            at = end
        out.append(np.concatenate(parts))
    flush()
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of ``n`` consecutive words; a shorter, non-empty text is one shingle."""
    if not len(words):
        return words
    k = min(n, len(words))
    h = words[:len(words) - k + 1]
    for i in range(1, k):
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + words[i:len(words) - k + 1 + i])
    if k < n:
        h = mix(h + np.uint64(k))
    return np.unique(h)
