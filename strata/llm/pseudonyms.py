"""Format-preserving Feistel pseudonyms for validated numbers and dates.

Candidates found in a text are validated, and only valid ones change, each by a keyed permutation of
its own format, so the pseudonym is valid too, looks alike and is the same for equal values
in every document:

* ``card``: 13 to 19 digits (bare, or in the usual groups with one kind of separator) that pass the Luhn test; the digits but
  the last are permuted, and the last one makes the new number pass it. Others (serial numbers, times) stay.
* ``phone``: a North American number in groups with area code, or +<country> groups; all digits but the country
  code are permuted. Ten bare digits are no phone number: nothing tells them from a serial number.
* ``ssn``: ddd-dd-dddd outside the never-issued ranges.
* ``ipv4``: four octets of 0 to 255 in plain decimal; permuted over all 2^32 addresses.
* ``iban``: country, check digits, 11 to 30 characters with remainder 1 by 97; digits and letters
  of the account are permuted within their kind and the check digits computed anew.
* ``date``: yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy or dd-mm-yyyy, a real day of 1900 to 2099; permuted over those days.
  Where only mm/dd/yyyy or mm-dd-yyyy is a real day, it is permuted among the days above 12, so its form stays clear.
* ``email``: the local part, however long; its letters and digits are permuted within their kind, the domain stays.

A gap in a number may be a space or a no-break space.

The permutation is an alternating Feistel network of ``ROUNDS`` rounds with keyed BLAKE2b over a domain a * b >= size, with
cycle walking back into the domain. The same key gives the same pseudonym anywhere; ``unmask`` inverts
it. Separators never matter: "4111 1111 ..." and "41111111..." stay linked.

Everything is row-local: no shuffle, no broadcast. Defined cases: null text stays null with no spans; an empty text stays
empty; whole texts are scanned; extra columns are not touched; an empty table gives none. Overlapping candidates: the leftmost wins, then the
kind listed first in ``KINDS``.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import math
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import map_arrow, slices

ROUNDS = 8
KINDS = ("email", "iban", "ssn", "phone", "date", "ipv4", "card")
NBSP = "\u00a0"
_GAP = f" {NBSP}"
_FIND = re.compile(
    rf"(?<![A-Za-z0-9])(?P<iban>[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:[{_GAP}][A-Z0-9]{{4}}){{2,7}}(?:[{_GAP}][A-Z0-9]{{1,4}})?))(?![A-Za-z0-9])"
    r"|(?<![0-9\-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9\-])"
    rf"|(?<![0-9])(?P<phone>\+[0-9]{{1,3}}[{_GAP}.\-]?\(?[0-9]{{2,4}}\)?(?:[{_GAP}.\-]?[0-9]{{2,4}}){{2,4}}"
    rf"|(?:\([0-9]{{3}}\)[{_GAP}.\-]?|[0-9]{{3}}\)?[{_GAP}.\-])[0-9]{{3}}[{_GAP}.\-][0-9]{{4}})(?![0-9])"
    r"|(?<![0-9./\-])(?P<date>[0-9]{4}(?P<s1>[\-/])[0-9]{2}(?P=s1)[0-9]{2}|[0-9]{2}(?P<s2>[./\-])[0-9]{2}(?P=s2)[0-9]{4})(?![0-9/\-])"
    r"|(?<![0-9.])(?P<ipv4>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])"
    rf"|(?<![0-9\-])(?P<card>[0-9]{{13,19}}|[0-9]{{4}}(?P<s3>[{_GAP}\-])[0-9]{{4}}(?P=s3)[0-9]{{4}}(?P=s3)[0-9]{{1,7}}"
    rf"|[0-9]{{4}}(?P<s4>[{_GAP}\-])[0-9]{{6}}(?P=s4)[0-9]{{5}})(?![0-9\-])")
_DOMAIN = re.compile(r"@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_HAS = re.compile(r"[0-9@]")
_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _DAY0 + 1


class Feistel:
    """Keyed permutations of range(size), one per (kind, size)."""

    def __init__(self, key: bytes):
        self.key = key[:64]
        self.permute = functools.lru_cache(maxsize=1 << 14)(self._permute)

    @staticmethod
    def _halves(size: int) -> tuple[int, int]:
        a = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        return a, -(-size // a)

    def _round(self, kind: str, size: int, r: int, half: int) -> int:
        h = hashlib.blake2b(f"{kind}|{size}|{r}|{half}".encode(), key=self.key, digest_size=16)
        return int.from_bytes(h.digest(), "big")

    def stream(self, data: bytes, n: int) -> list[int]:
        """``n`` keyed numbers of 64 bits."""
        seed = hashlib.blake2b(data, key=self.key, digest_size=32).digest()
        return list(struct.unpack(f"<{n}Q", hashlib.shake_256(seed).digest(8 * n)))

    def _permute(self, kind: str, size: int, x: int, back: bool = False) -> int:
        a, b = self._halves(size)
        while True:
            left, right = divmod(x, b)  # left in range(a), right in range(b)
            for r in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
                sign = -1 if back else 1
                if r % 2 == 0:
                    left = (left + sign * self._round(kind, size, r, right)) % a
                else:
                    right = (right + sign * self._round(kind, size, r, left)) % b
            x = left * b + right
            if x < size:
                return x


def luhn_digit(digits: str) -> int:
    """The digit that completes ``digits`` to a number that passes the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2 == 0:
            d = d * 2 - 9 * (d > 4)
        total += d
    return -total % 10


def _iban_rest(bban: str, country: str) -> int:
    return int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97


def _fill(shape: str, chars: str) -> str:
    """``chars`` put in the places of the letters and digits of ``shape``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _mixed(f: Feistel, kind: str, s: str, back: bool) -> str:
    """Letters and digits of ``s`` permuted within their kind; other characters stay. The two halves of the characters are the sides of
    the network, and a round adds a keyed stream character by character, so the work grows with the length."""
    shape = "".join("d" if c.isdigit() else "U" if c.isupper() else "l" if c.isalpha() else c for c in s)
    marks = [c for c in shape if c in "dUl"]
    base = [10 if c == "d" else 26 for c in marks]
    value = [int(c) if c.isdigit() else ord(c.lower()) - 97 for c in s if c.isalnum()]
    cut = len(value) // 2
    sign, sides = (-1 if back else 1), (slice(0, cut), slice(cut, None))
    for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        to, by = sides[r % 2], sides[1 - r % 2]
        stream = f.stream(f"{kind}:{shape}|{r}|".encode() + bytes(value[by]), len(value[to]))
        value[to] = [(v + sign * x) % n for v, x, n in zip(value[to], stream, base[to])]
    return _fill(s, "".join(str(v) if c == "d" else chr((65 if c == "U" else 97) + v) for c, v in zip(marks, value)))


def _card(f, s, back):
    d = re.sub(r"[^0-9]", "", s)
    if len(set(d)) == 1 or luhn_digit(d[:-1]) != int(d[-1]):
        return None
    body = int(d[:-1])
    while True:
        body = f.permute(f"luhn:{len(d)}", 10 ** (len(d) - 1), body, back)
        new = str(body).zfill(len(d) - 1)
        new += str(luhn_digit(new))
        if len(set(new)) > 1:  # a repeated digit is no valid number
            return _fill(s, new)


def _phone(f, s, back):
    code = re.match(r"\+[0-9]{1,3}(?=[^0-9])|\+[0-9]|", s).group()
    d = re.sub(r"[^0-9]", "", s[len(code):])
    if not 7 <= len(d) <= 14:
        return None
    return code + _fill(s[len(code):], str(f.permute(f"phone:{len(d)}", 10 ** len(d), int(d), back)).zfill(len(d)))


def _ssn_ok(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(f, s, back):
    d = s.replace("-", "")
    if not _ssn_ok(d):
        return None
    while True:
        d = str(f.permute("ssn", 10 ** 9, int(d), back)).zfill(9)
        if _ssn_ok(d):
            return _fill(s, d)


def _day(y: str, m: str, d: str) -> datetime.date | None:
    try:
        day = datetime.date(int(y), int(m), int(d))
    except ValueError:
        return None
    return day if 1900 <= day.year <= 2099 else None


def _date(f, s, back):
    first = s[4] in "-/"
    a, b, c = (s[8:], s[5:7], s[:4]) if first else (s[:2], s[3:5], s[6:])
    day = _day(c, b, a)
    if day is not None:
        new = datetime.date.fromordinal(_DAY0 + f.permute("date", _DAYS, day.toordinal() - _DAY0, back))
        y, m, d = f"{new.year:04}", f"{new.month:02}", f"{new.day:02}"
        return _fill(s, y + m + d if first else d + m + y)
    day = None if first or s[2] == "." else _day(c, a, b)
    if day is None:
        return None
    while True:  # mm/dd, known by a day above 12: permuted among such days
        day = datetime.date.fromordinal(_DAY0 + f.permute("mm/dd", _DAYS, day.toordinal() - _DAY0, back))
        if day.day > 12:
            return _fill(s, f"{day.month:02}{day.day:02}{day.year:04}")


def _ipv4(f, s, back):
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = f.permute("ipv4", 2 ** 32, sum(int(p) << (24 - 8 * i) for i, p in enumerate(parts)), back)
    return ".".join(str(x >> k & 255) for k in (24, 16, 8, 0))


def _iban(f, s, back):
    t = s.replace(" ", "").replace(NBSP, "")
    if not 15 <= len(t) <= 34 or _iban_rest(t[4:], t[:2]) != (98 - int(t[2:4])) % 97 or not 2 <= int(t[2:4]) <= 98:
        return None
    bban = _mixed(f, "iban:" + t[:2], t[4:], back)
    return _fill(s, t[:2] + f"{98 - _iban_rest(bban, t[:2]):02}" + bban)


def _email(f, s, back):
    local, _, domain = s.rpartition("@")
    return _mixed(f, "email", local, back) + "@" + domain


_KINDS = {"email": _email, "iban": _iban, "ssn": _ssn, "phone": _phone, "date": _date, "ipv4": _ipv4, "card": _card}


def _emails(text: str) -> list[list[int]]:
    """[start, position of the @, end] of the addresses of ``text``, from left to right. Looking back from each @ reads a text once,
    however long its runs of letters are."""
    out, at = [], text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            start = at
            while start and text[start - 1] in _LOCAL:
                start -= 1
            if out:
                start = max(start, out[-1][2])
            out.append([start, at, m.end()])
        at = text.find("@", m.end() if m else at + 1)
    return out


def mask(f: Feistel, text: str, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each in code points of the new text."""
    if not _HAS.search(text):
        return text, []
    emails = _emails(text)[::-1]
    out, spans, at, size, pos = [], [], 0, 0, 0
    m = _FIND.search(text)
    while m or emails:
        if m and m.start() < pos:
            m = _FIND.search(text, pos)
            continue
        if emails:  # what is left of the next address begins with a letter or digit
            mail = emails[-1]
            mail[0] = max(mail[0], pos)
            while mail[0] < mail[1] and text[mail[0]] not in _ALNUM:
                mail[0] += 1
            if mail[0] >= mail[1]:
                emails.pop()
                continue
        if emails and (not m or emails[-1][0] <= m.start()):
            kind, (s, _, e) = "email", emails.pop()
        else:
            kind = next(k for k in KINDS[1:] if m[k] is not None)
            s, e = m.span(kind)
        new = _KINDS[kind](f, text[s:e], back)
        if new is None:  # not valid: look again behind its first character
            pos = s + 1
            while pos < e and text[pos].isdigit() and text[pos - 1].isdigit():
                pos += 1
            continue
        out += [text[at:s], new]
        size += s - at
        spans.append((size, size + len(new), kind))
        size += len(new)
        at = pos = e
    return "".join([*out, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: str, keep: tuple[str, ...] = ("doc_id",), back: bool = False) -> DataFrame:
    """Columns ``keep``, text (with pseudonyms), n_pii and spans (array of struct(start, end, kind))."""
    from pyspark.sql.pandas.types import to_arrow_type
    cols = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    types = [to_arrow_type(cols.schema[k].dataType) for k in keep]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches):
        f = Feistel(key.encode())
        for *kept, texts in slices(batches, 1 << 22, len(keep)):
            got = [(None, []) if t is None else mask(f, t, back) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k, t) for k, t in zip(kept, types)), pa.array([g[0] for g in got], pa.string()),
                 pa.array([len(g[1]) for g in got], pa.int32()),
                 pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in g[1]] for g in got], span)],
                [*keep, "text", "n_pii", "spans"])

    schema = ", ".join([*(f"`{k}` {cols.schema[k].dataType.simpleString()}" for k in keep),
                        "text string, n_pii int, spans array<struct<start:int,end:int,kind:string>>"])
    return map_arrow(cols, run, schema)
