"""Document operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and
extra columns of clashing names, and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import (components, exact_dedup, language_id, mixing, near_dedup, packing, pseudonyms, substring_dedup,
                        suffix_sort, words)


def _vocabulary(r, n=400):
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n)]


def _corpus(seed=3):
    r = random.Random(seed)
    vocab = _vocabulary(r)
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = text(120)
    rows = [(1, base), (2, base), (2, base), (3, base.replace(" ", "\n", 5)), (4, None), (5, ""), (6, " \t\n"), (7, "word"), (8, "WORD"),
            (9, "word word"), (None, base), (None, None), (10, text(6000)), (12, "é" * 300), (13, "é" * 300)]
    for i in range(20, 45):
        w = base.split()
        for _ in range(r.randint(1, 14)):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((i, " ".join(w)))
    passage = text(30)
    rows += [(i, f"{text(60)} {passage} {text(60)}") for i in range(50, 60)]
    rows.append((60, f"{passage} {passage} {text(20)} {passage}"))
    return rows


def test_exact_groups(docs_of):
    rows = _corpus()
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(strip(t), []).append((-len(t or ""), d is None, d or 0, d))
    got = sorted(exact_dedup.exact_groups(docs_of(rows)).collect(), key=lambda x: str(x))
    want = []
    for d, t in rows:
        g = groups[strip(t)]
        keep = min(g, key=lambda x: x[:3])[3]
        want.append((d, keep, len(g), d == keep, hashlib.sha256(strip(t).encode()).hexdigest()))
    assert sorted([tuple(x)[:5] for x in got], key=str) == sorted(want, key=str)
    assert exact_dedup.exact_groups(docs_of([])).count() == 0


def test_exact_groups_tell_failed_identifiers_apart(docs_of, spark):
    rows = exact_dedup.recipes(docs_of([(1, "abc"), (2, "abd")]))
    same = rows.selectExpr("doc_id", "n_cp", "text_sha256", "array(1L, 2L) as recipe")
    out = exact_dedup.split_failed(same, spark.createDataFrame([(1, 2)], "a long, b long"))
    assert len({r["extra"] for r in out.collect()}) == 2


def test_shingles_and_word_hashes():
    for t in ("", "a", "A a", "one two  three\tone two", "x" * 5000, " a\n\n b ", "\x00 \x00\x00"):
        w = t.encode().lower().split()
        h = words.word_hashes([t, "other text", t])
        assert len(h[0]) == len(w) and (h[0] == h[2]).all()
        assert len(set(h[0].tolist())) == len(set(w))
        assert len(words.shingles(h[0], 2)) == (len(set(zip(w, w[1:]))) if len(w) > 1 else len(w))
    long = "word " * 2_000_000
    assert len(words.word_hashes([long])[0]) == 2_000_000 and len(set(words.word_hashes([long])[0].tolist())) == 1


@pytest.mark.parametrize("n", [2, 5])
def test_near_components(docs_of, n):
    rows = _corpus()
    sets = {}
    for d, t in rows:
        if d is not None:
            w = (t or "").encode().lower().split()
            sets[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = near_dedup.near_components(docs_of(rows), n).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), find(r["doc_id"])), r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    if n == 2:
        assert near_dedup.near_components(docs_of([]), n).count() == 0


def test_sequential_bounds_keep_similar_pairs():
    r = np.random.default_rng(1)
    need = near_dedup.least_matches(80)
    for _ in range(2000):
        hit = r.random(near_dedup.HASHES) < 0.82
        assert all(hit[:k].sum() >= m for k, m in need)


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (7, 7)]
    one = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in one.collect()} == {(3, 3), (4, 3), (5, 3), (8, 8), (9, 8)}
    two = components.components(spark.createDataFrame([(9, 5), (11, 12)], "a long, b long"), one)
    assert {tuple(r) for r in two.collect()} == {(3, 3), (4, 3), (5, 3), (8, 3), (9, 3), (11, 11), (12, 11)}


def _brute_removed(rows):
    seen, out = set(), {}
    ids = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    for has, d, t in ids:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(b[p:p + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[(d if has else None, t)] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_substring_removal(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 6)  # both ways to settle a key
    rows = _corpus() + [(70, "ab" * 400), (71, "-" * 350), (72, "x" + "ab" * 200)]
    want = _brute_removed(rows)
    got = substring_dedup.remove_repeats(docs_of(rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(d, *want[(d, t or "")]) for d, t in rows], key=str)
    assert substring_dedup.remove_repeats(docs_of([])).count() == 0


def test_suffix_arrays():
    for seed in range(120):
        r = random.Random(seed)
        k = r.choice([1, 2, 3, 26])
        s = [r.randint(1, k) for _ in range(r.randint(0, 60))] * r.choice([1, 3]) + [0]
        want = sorted(range(len(s)), key=lambda i: s[i:])
        t = np.array(s, np.int64)
        assert suffix_sort.suffix_array(t, k + 1).tolist() == want
        common = suffix_sort.permuted_prefixes(t, np.array(want), 9)
        for a, b in zip(want, want[1:]):
            n = 0
            while n < 9 and b + n < len(s) and a + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert common[b] == n


def test_pseudonyms(docs_of):
    f = pseudonyms.Feistel(b"key")
    for size in (1, 7, 1000):
        assert sorted(f.permute("k", size, x) for x in range(size)) == list(range(size))
    text = ("pay 4111 1111 1111 1111 or 4111-1111-1111-1111, born 2001-02-28 not 2001-02-30, call +1 (212) 555-0123, ip 10.0.0.1, "
            "mail a.b7@example.org, iban GB82 WEST 1234 5698 7654 32, id 123-45-6789, version 1.2.3, year 1999")
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, "no numbers"), (None, "x" * 100_000 + " 10.0.0.1"), (5, "4111111111111111")]
    got = {(r["doc_id"], r["n_pii"]): r["text"] for r in pseudonyms.pseudonymise(docs_of(rows), "key").collect()}
    new = got[(1, 8)]
    assert "2001-02-30" in new and "version 1.2.3, year 1999" in new and "@example.org" in new
    for secret in ("4111 1111", "4111-1111", "2001-02-28", "555-0123", "10.0.0.1", "a.b7@", "GB82", "123-45-6789"):
        assert secret not in new
    card = re.search(r"pay ([\d ]{19})", new)[1].replace(" ", "")
    assert pseudonyms.luhn_digit(card[:-1]) == int(card[-1]) and got[(5, 1)] == card and card in new.replace("-", "")
    assert got[(2, 0)] is None and got[(3, 0)] == "" and got[(4, 0)] == "no numbers"
    assert got[(None, 1)].rpartition(" ")[2] == re.search(r"ip ([\d.]+),", new)[1]
    assert pseudonyms.mask(f, pseudonyms.mask(f, text)[0], back=True)[0] == text
    assert pseudonyms.pseudonymise(docs_of([]), "key").count() == 0


def test_pseudonyms_of_long_and_unusual_forms():
    f = pseudonyms.Feistel(b"key")
    for n in (1, 2, 40, 64, 300, 100_000):
        mail = "a7Z" * n
        mail = mail[:n]
        new, spans = pseudonyms.mask(f, f"to {mail}@example.org.")
        assert len(spans) == 1 and new != f"to {mail}@example.org." or n == 1
        kinds = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A"), **dict.fromkeys("bcdefghijklmnopqrstuvwxyz", "a")})
        assert new[3:3 + n].translate(kinds) == mail.translate(kinds)
        assert pseudonyms.mask(f, new, back=True)[0] == f"to {mail}@example.org."
    hostile = "a." * 50_000 + " " + "x" * 100_000 + " @ " + "1" * 50_000 + " " + "1.2" * 20_000 + " a@b@c.de"
    new, spans = pseudonyms.mask(f, hostile)
    assert [s[2] for s in spans] == ["email"] and pseudonyms.mask(f, new, back=True)[0] == hostile
    for text, kind in [("212 555 0123", "phone"), ("(212) 555 0123", "phone"), ("(212)555-0123", "phone"), ("212\u00a0555\u00a00123", "phone"),
                       ("12/25/2024", "date"), ("25-12-2024", "date"), ("25/12/2024", "date"), ("4111\u00a01111\u00a01111\u00a01111", "card"),
                       ("GB82\u00a0WEST\u00a01234\u00a05698\u00a07654\u00a032", "iban")]:
        new, spans = pseudonyms.mask(f, f"x {text}, y")
        assert [s[2] for s in spans] == [kind] and new != f"x {text}, y", text
        assert re.sub("[0-9A-Z]", "0", new[2:-3]) == re.sub("[0-9A-Z]", "0", text)
        assert pseudonyms.mask(f, new, back=True)[0] == f"x {text}, y"
    for text in ("1700000000000", "4111111111111112", "13/13/2024", "2024-13-01", "2125550123", "999.1.1.1", "GB82 WEST 1234 5698 7654 33"):
        assert pseudonyms.mask(f, text) == (text, [])


def _scan(text):
    """A naive scanner: at every place, the longest stretch that is a valid value of some kind by plain rules of its own."""
    out, at = [], 0
    def edge(i, chars):
        return not 0 <= i < len(text) or text[i] not in chars
    digits = "0123456789"
    while at < len(text):
        hit = None
        for end in range(min(len(text), at + 40), at, -1):
            t = text[at:end]
            d = "".join(c for c in t if c in digits)
            bare = t == d and 13 <= len(d) <= 19
            groups = len(t) == 19 and t[4] == t[9] == t[14] and t[4] in " -" and len(d) == 16
            if (bare or groups) and edge(at - 1, digits + "-") and edge(end, digits + "-") and len(set(d)) > 1:
                total = sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(int(c) for c in reversed(d)))
                if total % 10 == 0:
                    hit = ("card", end)
            if len(t) == 11 and t[3] == t[6] == "-" and len(d) == 9 and edge(at - 1, digits + "-") and edge(end, digits + "-"):
                if d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000":
                    hit = ("ssn", end)
            p = t.split(".")
            if len(p) == 4 and all(x and x.isdigit() and str(int(x)) == x and int(x) < 256 for x in p) and edge(at - 1, digits + "."):
                if edge(end, digits) and not (text[end:end + 1] == "." and text[end + 1:end + 2].isdigit()):
                    hit = ("ipv4", end)
            if hit:
                break
        if hit:
            out.append((at, hit[1], hit[0]))
            at = hit[1]
        else:
            at += 1
    return out


def test_pseudonyms_find_what_a_naive_scanner_finds():
    r, f = random.Random(6), pseudonyms.Feistel(b"key")

    def luhn(n, good):
        body = "".join(r.choice("0123456789") for _ in range(n - 1))
        return body + str((pseudonyms.luhn_digit(body) + (not good)) % 10)

    def piece():
        k = r.randrange(7)
        if k == 0:
            return luhn(r.randint(13, 19), r.random() < 0.6)
        if k == 1:
            c, sep = luhn(16, r.random() < 0.7), r.choice(" -")
            return sep.join(c[i:i + 4] for i in range(0, 16, 4))
        if k == 2:
            return f"{r.randint(0, 999):03}-{r.randint(0, 12):02}-{r.randint(0, 9999):04}"
        if k == 3:
            return ".".join(str(r.randint(0, 300)) for _ in range(4))
        return r.choice(["word", "v1.2.3", "7", "x9", "2.5"])
    for _ in range(300):
        text = r.choice([", ", "; ", "a "]).join(piece() for _ in range(8))
        new, spans = pseudonyms.mask(f, text)
        spans = [s for s in spans if s[2] in ("card", "ssn", "ipv4")]
        assert [(text[a:b], k) for a, b, k in _scan(text)] == [(pseudonyms.mask(f, new[a:b], back=True)[0], k) for a, b, k in spans]


def test_packing(docs_of):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.default_path())
    rows = _corpus() + [(80, "one " * 9000), (81, "a!\x1c!b ΣΑΣ é ½ <|endoftext|>")] + [(100 + i, "word " * i) for i in range(1, 40)]
    got = packing.pack(docs_of(rows), with_ids=True).collect()
    want = {}
    for d, t in rows:
        ids = tk.encode(t or "", add_special_tokens=False).ids + [1]
        want.setdefault(d, []).append(ids)
    by, total = {}, 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        total += len(ids)
        assert len(ids) == r["length"] <= 4096 and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["start"] == 4096 * r["piece"]
        assert any(w[r["start"]:r["start"] + 4096] == ids for w in want[r["doc_id"]])
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert total == sum(len(w) for ws in want.values() for w in ws)
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) == -(-total // 4096)
    assert packing.pack(docs_of([])).count() == 0


def test_word_cache_matches_the_tokenizer():
    tokens = packing.Tokens(packing.default_path())
    for c in filter(tokens.plain, map(chr, range(0x180))):
        for w in (c, f"m{c}", f"{c}m", f"x{c}y", f"2{c}y", f".{c}.", c + c, f"km{c}'s"):
            assert tokens.encode(w).tolist() == tokens.tokenizer.encode(w, add_special_tokens=False).ids, w


def test_packing_plans():
    for seed in range(12):
        r = random.Random(seed)
        counts = {r.randint(1, 4096): r.choice([1, 3, 200]) for _ in range(r.choice([1, 10, 500]))}
        ranges, n = packing.plan(counts, 4096, *r.choice(packing.SCHEMES))
        fill, seen = {}, {}
        for length, k, m, s, per in ranges:
            for i in range(m):
                fill[s + i // per] = fill.get(s + i // per, 0) + length
            seen.setdefault(length, []).extend(range(k, k + m))
        assert max(fill.values()) <= 4096 and len(fill) == n
        assert all(sorted(seen[x]) == list(range(c)) for x, c in counts.items())


def test_language_id(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got) > 100
    refs = {"aa": "abc abd abe " * 20, "zz": "zyx zyw zyv " * 20}
    rows = [(1, "abd abc"), (2, "zyw ZYX"), (3, None), (4, ""), (5, "123 !!"), (None, "abd abc"), (1, "abd abc"), (6, "абв"), (7, "zyx " * 20_000)]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(docs_of(rows), refs).collect()]
    assert [g[1] for g in got] == ["aa", "zz", "und", "und", "und", "aa", "aa", "aa", "zz"]
    assert all(0 <= g[2] <= 1 for g in got) and got[2][2] == 0
    assert {r["lang_pred"] for r in language_id.identify(docs_of(rows)).collect()} == {"und"}
    assert language_id.identify(docs_of([])).count() == 0


def test_cross_parsing_counts_longest_matches():
    p = language_id.Parser({"x": "abracadabra"})
    ref = "abracadabra"

    def count(t):
        n = at = 0
        while at < len(t):
            size = 1
            while at + size < len(t) and t[at:at + size + 1] in ref:
                size += 1
            n, at = n + 1, at + size
        return n

    for t in ("abra", "cadabrax", "zzz", "abraabracad", "dabcab", "r"):
        assert p.phrases([p.lut[language_id._points(t)]])[0, 0] == count(t), t


def test_languages_with_large_alphabets(docs_of, monkeypatch):
    r = random.Random(4)

    def speech(base, n):
        vocab = ["".join(chr(base + min(int(r.expovariate(1 / 250)), 1999)) for _ in range(r.choice([1, 2, 2, 3]))) for _ in range(3000)]
        return ["".join(vocab[min(int(r.expovariate(1 / 600)), 2999)] for _ in range(n)) for n in [14_000] + [60] * 20]

    said = {"xx": speech(0x4E00, 20), "yy": speech(0xAC00, 20), "zz": [" ".join(_vocabulary(r, 3) * 40) for _ in range(21)]}
    refs = {k: v[0][:24_000] for k, v in said.items()}
    docs = docs_of([(i, t, k) for k, v in said.items() for i, t in enumerate(v[1:]) if k != "zz"])
    got = language_id.predict(docs, refs, ("doc_id", "lang")).collect()
    assert all(x["lang_pred"] == x["lang"] for x in got) and min(x["score"] for x in got) > 0.1
    assert language_id.known_language(docs, refs).count() == len(got) == 40
    foreign = docs_of([(1, "".join(chr(r.randrange(0x1200, 0x1248)) for _ in range(300))), (2, said["xx"][1])])
    assert [x["doc_id"] for x in language_id.known_language(foreign, refs).collect()] == [2]
    texts = [v[i] for v in said.values() for i in (1, 2)] + [said["xx"][1] + " " + said["yy"][1]]
    want = language_id.Parser(refs).predict(texts)
    for dense, cells in ((0, 10 ** 9), (30, 10 ** 9), (120, 10)):
        monkeypatch.setattr(language_id, "DENSE", dense)
        monkeypatch.setattr(language_id, "CELLS", cells)
        p = language_id.Parser({"x": "abracadabra"})
        assert p.phrases([p.lut[language_id._points("cadabraxbra")]])[0, 0] == 3
        assert language_id.Parser(refs).predict(texts) == want


def test_mixing(spark, docs_of):
    r = random.Random(5)
    own = {"a": _vocabulary(r, 40), "b": [w + "q" for w in _vocabulary(r, 40)]}
    rows = [(i, " ".join(r.choice(own["a" if i % 4 else "b"]) for _ in range(r.randint(5, 40)))) for i in range(400)]
    labels = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(0, 400, 2)] + [(None, "a"), (3, None), (5, "other"), (0, "b")],
                                   "doc_id long, domain string")
    extra = [(None, None), (1000, ""), (0, rows[0][1])]
    got = mixing.mix(docs_of(rows + extra), labels, {"a": 0.4, "b": 0.6}).collect()
    assert len(got) == len(rows) + 3 and all(x["rate"] >= 0 and x["copies"] >= 0 for x in got)
    total = sum(x["tokens"] for x in got)
    assert abs(sum(x["rate"] * x["tokens"] * x["p_b"] for x in got) / total - 0.6) < 0.01
    right = [(x["p_b"] > 0.5) == (x["doc_id"] % 4 == 0) for x in got if x["tokens"] and x["doc_id"] is not None]
    assert sum(right) >= 0.97 * len(right)
    again = mixing.remix(docs_of(rows + extra), labels, {"a": 0.4, "b": 0.6})
    assert again.columns == docs_of([]).columns and again.count() == sum(x["copies"] for x in got)
    empty = mixing.mix(docs_of([]), labels.limit(0), {"a": 1.0, "b": 1.0})
    assert empty.count() == 0


def test_registered_mixing_meets_its_targets(spark, docs_of, tmp_root, monkeypatch):
    from strata.llm import queries
    r = random.Random(9)
    own = {d: [f"{d}{i}" for i in range(30)] for d in ("high", "low", "toxic")}
    domain = {i: "toxic" if i % 10 == 0 else "low" if i % 10 == 1 else "high" for i in range(800)}
    rows = [(i, " ".join(r.choice(own[d]) for _ in range(r.randint(6, 9) if d == "low" else r.randint(40, 60)))) for i, d in domain.items()]
    docs_of(rows).write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(i, int(d == "high"), int(d == "toxic")) for i, d in domain.items()],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_root}/labels.parquet")
    mixed = mixing.cut(queries.op1_mixing(spark, tmp_root), "test-mixed")
    assert mixed.agg({"rate": "max"}).first()[0] > 8
    for x in mixing.reached(mixed, queries.TARGETS).collect():
        assert abs(x["reached"] / sum(len(t.split()) for _, t in rows) - queries.TARGETS[x["domain"]]) < 1e-3, x
    g = np.random.default_rng(1)
    members = spark.createDataFrame([(5, [float(a), 1 - float(a)]) for a in g.uniform(0.2, 0.7, 50)], "tokens long, p array<double>")
    once = mixing.fit_rates(members, [0.75, 0.25], iterations=12)
    monkeypatch.setattr(mixing, "RENEW", 5)  # stored rates change nothing
    again = mixing.fit_rates(members, [0.75, 0.25], iterations=12)
    assert len(once) == len(again) > 5 and np.allclose(once, again)


def test_near_components_link_all_texts_of_an_id(docs_of):
    r = random.Random(12)
    vocab = _vocabulary(r)
    a, b, c = (" ".join(r.choice(vocab) for _ in range(200)) for _ in range(3))
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (9, c), (9, c), (4, c + " more"), (10, None), (10, ""), (11, a), (11, None)]
    got = near_dedup.near_components(docs_of(rows), 2).collect()
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by.setdefault((x["doc_id"], x["n_shingles"] > 0), set()).add((x["component_id"], x["kept"]))
    assert by == {(5, True): {(5, True)}, (7, True): {(5, False)}, (8, True): {(5, False)}, (9, True): {(4, False)}, (4, True): {(4, True)},
                  (10, False): {(10, True)}, (11, True): {(5, False)}, (11, False): {(11, True)}}
    kept = [(x["doc_id"], x["text"]) for x in near_dedup.drop_near_copies(docs_of(rows), 2).collect()]
    assert len(kept) == len(set(kept)) and {d for d, _ in kept} == {5, 4, 10, 11} and sum(d == 5 for d, _ in kept) == 1


def test_exact_copies_of_a_row_go(docs_of):
    rows = [(5, "a b"), (5, "ab"), (5, "a b"), (6, "ab"), (7, "c"), (7, "d"), (None, "e"), (None, "e"), (8, None), (9, "")]
    got = sorted(((x["doc_id"], x["text"]) for x in exact_dedup.drop_copies(docs_of(rows)).collect()), key=str)
    assert got in [sorted(x, key=str) for x in ([(5, "a b"), (7, "c"), (7, "d"), (None, "e"), (8, None)], [(5, "a b"), (5, "ab"), (7, "c"), (7, "d"), (None, "e"), (8, None)])]


def test_tokens_keep_frequent_pieces_and_match_the_tokenizer(monkeypatch):
    """A piece in use is tokenized once however many rare ones come between, whatever stands around it; ids are the tokenizer's."""
    monkeypatch.setattr(packing, "CACHE", 16)
    tokens, made = packing.Tokens(packing.default_path()), []
    make = tokens.pieces.make
    tokens.pieces.make = lambda p: made.append(p) or make(p)
    text = " ".join(f"The (the) {'abcdefgh'[i % 8]}x{'ijklmnop'[i // 8]}q the, THE's" for i in range(64))
    texts = [text, "", " \t\n", "a_b--c' don't I'LL 'tis x'sy 12.5", "Äß ſİı ½ ² 日本 é \x00\x7f \xa0\x85 a​b", "a\x1cb", "x <|endoftext|> y"]
    for t in texts:
        assert list(tokens.encode(t)) == tokens.tokenizer.encode(t, add_special_tokens=False).ids, t
    assert made.count("the") == 1 and made.count("'s") == 1
    assert len(tokens.pieces) + len(tokens.pieces.old) <= 16
