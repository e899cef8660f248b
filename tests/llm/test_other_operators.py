"""WARC, top-k search, perspective rotation and the registered queries with their SQL."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import perspectives, queries, topk, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    res = con.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in res.fetchall()]
    assert sorted([tuple(r[c] for c in cols) for r in got.collect()], key=str) == sorted(want, key=str) and want


def test_warc(spark):
    big = "<p>" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(1, "http://a/x", big, 9), (2, "http://b", big, 9), (3, None, big, 9), (4, "http://a", None, 9), (5, "http://c\r\nX: y", "é", 9), (6, "http://a", "é", 9),
            (None, "http://n", big, 9), (1, "http://a/x", big, 9), (7, "http://z", "y" * 3_000_000, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type long")
    found = warc.captures(spark, pages).collect()
    got = {r["metadata"]["page_id"]: r for r in found}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, None} and len(found) == len(rows) == len({r["record_id"] for r in found})
    for p, _, h, _ in rows:
        r = got[p]
        b = (h or "").encode()
        assert r["response"]["payload_bytes"] == len(b) and r["response"]["payload_digest"] == hashlib.sha1(b).hexdigest()
        assert r["request"]["request_id"] and r["metadata"]["metadata_id"]
        if h == big and p != 3:
            assert (r["response"]["type"], r["refers_to"], bytes(r["response"]["payload"])) == ("revisit", 3, b"")
        else:
            assert (r["response"]["type"], r["refers_to"], bytes(r["response"]["payload"])) == ("response", None, b)
    assert warc.captures(spark, pages.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [
    [(1, "a", "x"), (1, "a", "x"), (2, "a", "x")],
    [(1, "a", "y" * 1200)] * 2500 + [(2, "a", "y" * 1200), (2, "b", "y" * 1200), (2, "b", "y" * 1200), (None, "c", "y" * 1200), (3, "a", "x" * 2000)],
    [(None, "a", "y" * 1200), (None, "b", "y" * 1200), (None, "b", "y" * 1200)]])
def test_warc_matches_its_sql_on_repeated_rows(spark, rows, monkeypatch):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(queries, "table", lambda *_: pages)
    got = queries.op7_warc(spark, "")
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    want = con.execute(queries.ORACLES["op7_warc"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) == len(rows)


def test_top_k(spark, monkeypatch):
    for name, size in (("SHARD", 40), ("BLOCK", 16), ("LEAF", 8)):
        monkeypatch.setattr(topk, name, size)
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(150)] + [(200 + i, [0.5] * 6) for i in range(60)]
    rows += [(300, None), (301, []), (302, [None] + [0.1] * 5), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (None, [0.1] * 6),
             (310, [0.1, 0.2]), (320, [1e6] * 6), (321, [1e6] * 6), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df.selectExpr("*", "1 as score", "2 as rank"), 5, 256.0, df["vec_id"] % 10 == 0).collect()
    import math
    v = [(i, [math.floor(x * 256) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for q, e in v:
        if q % 10 == 0:
            s = sorted((-sum(a * b for a, b in zip(e, f)), i) for i, f in v if i != q and len(f) == len(e))[:5]
            want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(df.limit(0), 5, 256.0, df["vec_id"] % 10 == 0).count() == 0


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"), (1, None, None, "?"),
            (None, 0, "ann", "x"), (2, 0, "system", "alone")] + [(3, 7, "ann", f"t{i}") for i in range(600)]
    df = spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn long, role string, text string, roster string")
    got = perspectives.rotate(df).collect()
    one = {r["speaker"]: r for r in got if r["conv_id"] == 1 and r["part"] == 0}
    assert set(one) == {"ann", "bob", "unknown"} and one["ann"]["n_turns"] == 5 and one["ann"]["n_trained"] == 3
    text = one["ann"]["text"]
    spans = [tuple(map(int, s.split("-"))) for s in one["ann"]["spans"].split(";")]
    assert [text[a:b] for a, b in spans] == ["hi", "bye", "bye"]
    assert "<|system|>\nbe kind" in text and "<|user name=bob|>\n\n<|end|>" in text and "name=ann" not in text
    assert {r["conv_id"] for r in got} == {1, None, 3}
    three = [r for r in got if r["conv_id"] == 3]
    assert sum(r["n_turns"] for r in three) == 600 and len(three) > 1
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P
    from strata.llm import packing
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in P.STAGES[:-1]:
        docs = P.cut(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        kept.append([r[0] for r in docs.select("doc_id").collect()])
    assert len(kept[0]) > 0.95 * 200 and set(kept[1]) <= set(kept[0]) and set(kept[2]) <= set(kept[1]) and set(kept[3]) <= set(kept[2])
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [d for d in kept[2] if labels.get(d) == 0]
    assert sum(d in set(kept[3]) for d in clean) >= 0.9 * len(clean)
    rows = P.run(spark, SF).collect()
    lengths = {}
    for r in rows:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert max(lengths.values()) <= packing.CAPACITY and sum(r["piece"] == 0 for r in rows) == len(kept[3])


def test_pipeline_keeps_clean_documents_of_any_share(spark, docs_of, tmp_root):
    import corpus_pipeline as P
    r = random.Random(8)
    common, own = [f"w{i}" for i in range(60)], {d: [f"{d}{i}" for i in range(30)] for d in ("high", "low", "toxic")}
    domain = {i: "toxic" if i % 10 == 0 else "low" if i % 3 == 0 else "high" for i in range(600)}  # low: a third
    rows = [(i, " ".join(r.choice(own[d] if r.random() < (0.5 if d == "toxic" else 0.15) else common) for _ in range(r.randint(15, 60)))) for i, d in domain.items()]
    labels = [(i, int(d == "high"), int(d == "toxic")) for i, d in domain.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_root}/labels.parquet")
    copies = dict.fromkeys(domain, 0)
    for x in P.mixed(spark, docs_of(rows), tmp_root).collect():
        copies[x["doc_id"]] += 1
    gone = [i for i, n in copies.items() if not n]
    assert not [i for i in gone if domain[i] != "toxic"]
    assert len(gone) >= 0.5 * sum(d == "toxic" for d in domain.values())


def test_rotation_cuts_large_parts_in_order(spark):
    turns = [(t, "ann" if i % 2 else "bob", f"t{t}-{i}") for t in range(256) for i in range(4)] + [(3, "ann", "again")] * 900 + [(None, "bob", "?")]
    df = spark.createDataFrame([(c, *t) for c in (1, None) for t in turns] + [(2, 0, "ann", "x")], "conv_id long, turn long, role string, text string")
    got = [r for r in perspectives.rotate(df).collect() if r["speaker"] == "ann"]
    for c in (1, None):
        mine = sorted((r for r in got if r["conv_id"] == c and r["part"] == 0), key=lambda r: r["slice"])
        assert [r["slice"] for r in mine] == list(range(8)) and [r["n_turns"] for r in mine] == [256] * 7 + [132]
        assert "".join(r["text"] for r in mine) == "".join(
            f"<|{'assistant' if role == 'ann' else 'user name=bob'}|>\n{text}\n<|end|>\n" for _, role, text in sorted(t for t in turns if t[0] is not None))
    assert len(got) == 2 * 9 + 1


def test_pipeline_on_odd_rows_and_clashing_columns(spark, tmp_root):
    import corpus_pipeline as P
    from strata.llm.util import table
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    odd = spark.createDataFrame([(None, None, None, None, None), (100_001, None, "en", "s", 0), (100_002, "", "en", None, 0), (100_003, " \n", None, "s", 2),
                                 (None, "the of and to in " * 30, "en", "s", 10), (None, "the of and to in " * 30, "en", "s", 10)], docs.schema)
    extra = {c: F.lit(1) for c in ("lang_pred", "score", "entropy", "excess", "_copies", "_draw", "_text", "rep", "kept", "n", "_kept_id", "tokens", "p")}
    rows = docs.unionByName(odd).unionByName(docs.limit(20)).withColumns(extra)
    rows.write.parquet(f"{tmp_root}/documents.parquet")
    labels.write.parquet(f"{tmp_root}/labels.parquet")
    docs = table(spark, tmp_root, "documents")
    for name, stage in P.STAGES[:-1]:
        docs = P.cut(stage(spark, docs, tmp_root), f"odd-{name}")
        assert docs.columns == rows.columns
        if name == "exact_dedup":  # equal rows are copies
            assert docs.groupBy("doc_id", "text").count().where("count > 1").isEmpty()
        if name == "near_dedup":
            assert docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    packed = P.STAGES[-1][1](spark, docs, tmp_root)
    assert packed.where("piece = 0").count() == docs.count()
    empty = f"{tmp_root}/empty"
    rows.limit(0).write.parquet(f"{empty}/documents.parquet")
    labels.limit(0).write.parquet(f"{empty}/labels.parquet")
    assert P.run(spark, empty).count() == 0


def test_warc_archives_stream_in_pieces(spark, tmp_path):
    """Archives of many batches, payloads full of separators and header look-alikes, and several archives to a task."""
    text = ["", "\r\n", "\r\n\r\n", "\r\n\r\r\n\r\n\n", "a\r\n\r", "\r\n\r\n\r\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n", "é€" * 700 + "\r\n"]
    html = [t * n for n in (1, 2, 301) for t in text] + ["x" * 3_000_000 + "\r\n\r\n" + "y" * 3_000_000]
    pages = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    path = str(tmp_path / "archives")
    warc.write(pages.repartition(3), path)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = warc.read(spark, path).coalesce(1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(found) == 3 * len(html)
    got = {r.target_uri: bytes(r.payload).decode() for r in found if r.type == "response"}
    assert all(got[f"http://h/{i}"] == h for i, h in enumerate(html) if f"http://h/{i}" in got)
    assert len(got) == len({h for h in html if len(h.encode()) >= 1000}) + sum(len(h.encode()) < 1000 for h in html)


def test_warc_cut_archive_is_an_error():
    whole = b"".join(t + warc.END.encode() for t in warc.transaction(1, "http://h/1", b"abc", "s", None))
    assert [h["warc-type"] for _at, h, _b in warc.parse(whole)] == ["request", "response", "metadata"]
    with pytest.raises(ValueError):
        list(warc.parse(whole[:-40]))
