"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text.

``suffix_array`` classifies suffixes, sorts the leftmost-smaller (LMS) substrings by one induction, names them,
sorts the string of names recursively where names repeat, and induces the whole array from the sorted
LMS suffixes in linear time. For byte alphabets an induction runs bucket by bucket in numpy: all
suffixes of a bucket induce their predecessors at once. Name strings have wide alphabets and
few symbols per bucket, and are induced one by one.
"""

from __future__ import annotations

import numpy as np

from strata.llm.words import _P, mix

WIDE = 512  # alphabets from this size on are induced symbol by symbol


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (the last symbol is the sentinel, smaller than all)."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64)))  # 1: smaller than its successor
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    out = np.ones(n, bool)
    out[:-1] = np.append(step, 1)[nearest] > 0
    return out


def _deal(sa, heads, sym, pos, sign):
    """Puts ``pos`` into the buckets of their symbols, in order, from the heads on (sign 1) or back (-1)."""
    order = np.argsort(sym, kind="stable")
    s = sym[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    count = np.diff(np.append(first, len(s)))
    rank = np.arange(len(s)) - np.repeat(first, count)
    sa[heads[s] + sign * rank] = pos[order]
    heads[s[first]] += sign * count


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix order that the given order of LMS suffixes induces (numpy, bucket by bucket)."""
    n = len(t)
    sizes = np.bincount(t, minlength=k)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    sa = np.full(n, -1, np.int64)
    heads = begins.copy()
    lms_sym = t[lms]
    by = np.argsort(lms_sym, kind="stable")
    groups = dict(zip(*_split(lms[by], lms_sym[by])))
    used = np.flatnonzero(sizes)
    for c in used:
        lo = begins[c]
        while heads[c] > lo:  # larger suffixes of this bucket, as they come in
            cur = sa[lo:heads[c]]
            lo = heads[c]
            prev = cur[cur > 0] - 1
            prev = prev[~small[prev]]
            if len(prev):
                _deal(sa, heads, t[prev], prev, 1)
        if c in groups:
            prev = groups[c]
            prev = prev[prev > 0] - 1
            if len(prev):
                _deal(sa, heads, t[prev], prev, 1)
    tails = ends - 1
    for c in used[::-1]:
        hi = ends[c] - 1
        while tails[c] < hi:  # smaller suffixes of this bucket, from its end
            cur = sa[tails[c] + 1:hi + 1][::-1]
            hi = tails[c]
            prev = cur[cur > 0] - 1
            prev = prev[small[prev]]
            if len(prev):
                _deal(sa, tails, t[prev], prev, -1)
        cur = sa[begins[c]:heads[c]][::-1]
        prev = cur[cur > 0] - 1
        prev = prev[small[prev]]
        if len(prev):
            _deal(sa, tails, t[prev], prev, -1)
    sa[0] = n - 1
    return sa


def _split(values, keys):
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first].tolist(), np.split(values, first[1:]) if len(keys) else []


def _induce_wide(t, small, lms, k):
    """The same for wide alphabets, symbol by symbol."""
    sizes = np.bincount(t, minlength=k)
    ends = np.cumsum(sizes).tolist()
    begins = (np.cumsum(sizes) - sizes).tolist()
    t, small, n = t.tolist(), small.tolist(), len(t)
    sa = [-1] * n
    tails = [e - 1 for e in ends]
    for i in reversed(lms.tolist()):
        sa[tails[t[i]]] = i
        tails[t[i]] -= 1
    heads = begins[:]
    for x in range(n):
        j = sa[x] - 1
        if j >= 0 and not small[j]:
            c = t[j]
            sa[heads[c]] = j
            heads[c] += 1
    tails = [e - 1 for e in ends]
    for x in range(n - 1, -1, -1):
        j = sa[x] - 1
        if j >= 0 and small[j]:
            c = t[j]
            sa[tails[c]] = j
            tails[c] -= 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` (symbols 0 to k - 1; the last one is 0 and occurs nowhere else)."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    induce = _induce if k < WIDE else _induce_wide
    small = _types(t)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    sa = induce(t, small, lms, k)
    ordered = sa[is_lms[sa]]
    names, distinct = _names(t, lms, ordered)
    if distinct == len(lms):
        return induce(t, small, ordered, k)
    inner = suffix_array(names, distinct)
    return induce(t, small, lms[inner], k)


def _names(t, lms, ordered):
    """Names of the LMS substrings in text order, by their sorted order; equal substrings share one."""
    place = np.empty(len(t), np.int64)
    place[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms) + 1, 1)[place[ordered]]
    same = np.zeros(len(ordered), bool)
    near = np.flatnonzero(size[1:] == size[:-1]) + 1
    alive, at = near, 0
    while len(alive):  # compare all neighbours of equal length, symbol by symbol
        ended = size[alive] <= at
        same[alive[ended]] = True
        alive = alive[~ended]
        alive = alive[t[ordered[alive] + at] == t[ordered[alive - 1] + at]]
        at += 1
    rank = np.cumsum(~same) - 1
    names = np.empty(len(lms), np.int64)
    names[place[ordered]] = rank
    return names, int(rank[-1]) + 1


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, limit: int, at: np.ndarray | None = None) -> np.ndarray:
    """For each text position (of ``at``, else all), its common prefix (up to ``limit``) with the suffix sorted before it;
    found by halving over prefix hashes for all positions at once, then lengths of ``limit`` are confirmed symbol by symbol."""
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n - 1
    power = np.full(n + 1, _P, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(t.astype(np.uint64) + np.uint64(7)) * power[:n])))
    here = np.arange(n) if at is None else at
    before = before[here]
    out = np.zeros(len(here), np.int64)
    step = 1 << (limit.bit_length() - 1)
    while step:
        a, b = here + out, before + out
        ok = (out + step <= limit) & (np.maximum(a, b) + step <= n)
        a, b = np.where(ok, a, 0), np.where(ok, b, 0)
        x, y = total[np.where(ok, a + step, 0)] - total[a], total[np.where(ok, b + step, 0)] - total[b]
        far = a >= b
        x, y = np.where(far, x, x * power[np.where(far, 0, b - a)]), np.where(far, y * power[np.where(far, a - b, 0)], y)
        out[ok & (x == y)] += step
        step >>= 1
    full = np.flatnonzero(out >= limit)
    for s in range(0, len(full), 8192):
        f = full[s:s + 8192]
        span = np.arange(limit)
        wrong = (t[here[f][:, None] + span] != t[before[f][:, None] + span]).any(1)
        out[f[wrong]] = 0
    return out
