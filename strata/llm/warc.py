"""WARC archives: transactions written, read back and assembled.

``write`` turns captures (page_id, url, html) into WARC/1.1 archives of request,
response (or revisit) and metadata records, tied together by WARC-Concurrent-To. A
record is one string whose UTF-8 bytes end in CR LF CR LF, so Spark's text writer with that
line separator writes valid archives into the shared folder (gzip, one member a
file, at most ``RECORDS_PER_FILE`` captures each) with Spark's own commit of task output.
Pages stay in their input partition: only digests are shuffled.

``read`` parses the archives by Content-Length as their bytes stream by, so an archive may be larger than memory, and ``assemble`` joins each
request and metadata record to the response or revisit it is concurrent to, and each revisit to the
response it refers to, giving one nested row per capture.

Of captures with equal payloads (length and SHA-256) of at least ``REVISIT_FROM`` bytes, the one
with the largest page_id is a response and the others revisit it (rows that share that page_id are all responses, and the largest
url of them is revisited); a hot payload costs a partial aggregate per task plus an equi-join that adaptive execution can split.

Defined cases: null html is an empty payload, a null url is written as ``urn:none``. A null page_id is the
smallest. Rows equal in page_id, url and html are captures of their own, told apart by a number. Line breaks in a url are percent-encoded. Payload may
hold anything, record separators and header look-alikes included. An empty table gives no record.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.util import cut, map_arrow, shared_path, slices

REVISIT_FROM = 1000
RECORDS_PER_FILE = 2000
COPIES = 1000
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("file string, position long, type string, record_id string, concurrent_to string, refers_to string, "
          "target_uri string, payload binary, payload_bytes long, payload_digest string, headers string")
PAYLOAD = 7  # its place in RECORD


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16])}>"


def response_id(page_id, url, sha256, copy: int = 0) -> str:
    return _urn("response", page_id, url, sha256, copy)


def _record(kind: str, rid: str, fields: list[tuple[str, str]], *block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *fields,
            ("Content-Length", str(sum(map(len, block))))]
    return b"".join([("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode(), *block])


def transaction(page_id, url: str, body: bytes, sha256: str, refers: tuple | None, copy: int = 0) -> list[bytes]:
    """The three records of a capture; ``refers``: (page_id, url) of the response it revisits; ``copy`` numbers equal captures."""
    uri = url.replace("\r", "%0D").replace("\n", "%0A")
    digest = hashlib.sha1(body).hexdigest()
    rid = response_id(page_id, url, sha256, copy)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        main = _record("response", rid, fields, http, body)
    else:
        main = _record("revisit", rid, [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", response_id(*refers, sha256))], http)
    path = "/" + uri.partition("://")[2].partition("/")[2]
    request = _record("request", _urn("request", rid), [("WARC-Target-URI", uri), ("WARC-Concurrent-To", rid),
                      ("Content-Type", "application/http; msgtype=request")],
                      f"GET {path} HTTP/1.1\r\nHost: {uri.partition('://')[2].partition('/')[0]}\r\n\r\n".encode())
    meta = _record("metadata", _urn("metadata", rid), [("WARC-Target-URI", uri), ("WARC-Concurrent-To", rid),
                   ("Content-Type", "application/warc-fields")],
                   f"page-id: {'' if page_id is None else page_id}\r\nhttp-length: {len(body)}\r\n".encode())
    return [request, main, meta]


def _rows(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("urn:none")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return rows.withColumn("sha256", F.sha2("html", 256)).withColumn("n", F.octet_length("html"))


def _marked(rows: DataFrame) -> DataFrame:
    """Of captures (page_id, url, payload) that are repeated or revisit another: how often they occur, and the capture they revisit."""
    key = ["page_id", "url", "sha256", "n"]
    found = rows.groupBy(*key).agg(F.count("*").alias("c"))
    first = (found.where(F.col("n") >= REVISIT_FROM).groupBy("sha256", "n").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("m"))
             .where("m > 1").select("sha256", "n", "first"))
    found = found.join(first, ["sha256", "n"], "left")
    to = F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first"))
    return found.withColumn("to", to).where("c > 1 or to is not null").select(
        F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.col("sha256").alias("_sha"), "c", "to")


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` under ``path``."""
    rows = _rows(pages)
    marked = cut(_marked(rows), "warc-marks")
    on = rows["page_id"].eqNullSafe(marked["_id"]) & (rows["url"] == marked["_url"]) & (rows["sha256"] == marked["_sha"])
    rows = rows.join(marked, on, "left").select(
        "page_id", "url", "html", "sha256", F.col("to.page_id").alias("to_id"), F.col("to.url").alias("to_url"), "c")
    many = marked.where("c > 1")
    if many.isEmpty():
        rows = rows.drop("c").withColumn("copy", F.lit(0).cast("long"))
    else:  # equal rows are combined on the map side, and numbered as they are dealt out again
        some = rows.where("c > 1").dropDuplicates(["page_id", "url", "sha256"])
        some = some.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / COPIES)))).repartition("page_id", "url", "part")
        some = some.withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, F.least("c", (F.col("part") + 1) * COPIES) - 1)))
        rows = rows.where("c is null or c = 1").drop("c").withColumn("copy", F.lit(0).cast("long")).unionByName(some.drop("c", "part"))

    def run(batches):
        for ids, urls, bodies, shas, to_ids, to_urls, copies in slices(batches, 1 << 22, 2):
            records = [r for p, u, h, s, ti, tu, k in zip(ids, urls, bodies, shas, to_ids, to_urls, copies)
                       for r in transaction(p, u, h, s, None if tu is None else (ti, tu), k)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).cast(pa.string())], ["value"])

    rows = rows.withColumn("html", F.col("html").cast("binary"))
    (map_arrow(rows, run, "value string").write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * RECORDS_PER_FILE).text(path))


class Records:
    """The records of one archive from its bytes, fed piece by piece: holds one record and a piece."""

    def __init__(self):
        self.data, self.at, self.need = bytearray(), 0, 1

    def feed(self, piece: bytes):
        """(position, headers, block) of every record that ``piece`` completes."""
        self.data += piece
        start = 0
        while len(self.data) - start >= self.need:
            end = self.data.find(b"\r\n\r\n", start)
            if end < 0:
                break
            head = {}
            for line in bytes(self.data[start:end]).split(b"\r\n")[1:]:
                k, _, v = line.partition(b":")
                head[k.strip().lower().decode()] = v.strip().decode()
            stop = end + 4 + int(head["content-length"])
            if len(self.data) < stop + 4:
                self.need = stop + 4 - start
                break
            with memoryview(self.data) as view:
                block = bytes(view[end + 4:stop])
            yield self.at, head, block
            self.at += stop + 4 - start
            start, self.need = stop + 4, 1
        del self.data[:start]

    def finish(self):
        """The last record, where a reader of lines took the archive's last line end; an error if it is cut short."""
        if self.data:
            yield from self.feed(b"\r\n\r\n")
        if self.data:
            raise ValueError(f"archive ends within the record at {self.at}")


def parse(data: bytes):
    """(position, headers, block) of every record of an archive's bytes."""
    records = Records()
    yield from records.feed(data)
    yield from records.finish()


def _row(name: str, at: int, h: dict, block: bytes) -> tuple:
    kind = h["warc-type"]
    payload, size, digest, note = None, None, None, None
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = h["warc-payload-digest"].partition(":")[2].lower()
        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{name}: payload at {at} does not match its digest")
    elif kind == "metadata":
        note = block.decode()
    return (name, at, kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"),
            h.get("warc-target-uri"), payload, size, digest, note)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzip archives under ``path``. Spark's text reader unpacks an archive as a stream and hands
    its bytes over in pieces that end where CR LF CR LF stands, in order and in one task, as gzip is not split; a task holds a
    batch of pieces and one record, whatever the archive's size."""
    pieces = (spark.read.option("lineSep", END).option("pathGlobFilter", "part-*.gz").text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")))

    def parsed(batches):
        name, records = None, Records()
        for batch in batches:
            files = batch.column(0)
            one = len(files) and files[0] == files[-1]  # the pieces of a file follow one another
            for file, piece in zip([files[0].as_py()] * len(files) if one else files.to_pylist(), batch.column(1).to_pylist()):
                if file == name:
                    piece = b"\r\n\r\n" + piece
                else:
                    yield from (_row(name, *r) for r in records.finish())
                    name, records = file, Records()
                yield from (_row(name, *r) for r in records.feed(piece))
        yield from (_row(name, *r) for r in records.finish())

    def run(batches):
        rows, held = [], 0
        for row in parsed(batches):
            rows.append(row)
            held += len(row[PAYLOAD] or "")
            if held > 1 << 22 or len(rows) >= 10000:
                yield _batch(rows)
                rows, held = [], 0
        yield _batch(rows)

    return map_arrow(pieces, run, RECORD)


def _batch(rows):
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, request, response, metadata (structs) and refers_to (page_id of
    the response a revisit refers to). Records that repeat an id are one record."""
    def part(kind, *cols):
        return records.where(F.col("type").isin(*kind)).select(*cols)

    once = [F.first(c).alias(c) for c in ("type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to")]
    main = part(("response", "revisit"), "record_id", "type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to")
    main = main.groupBy("record_id").agg(*once)
    meta = part(("metadata",), F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("metadata_id"),
                F.regexp_extract("headers", r"(?m)^page-id: (-?\d+)", 1).try_cast("long").alias("page_id"))
    meta = meta.dropDuplicates(["record_id"])
    request = part(("request",), F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("request_id"),
                   F.col("target_uri").alias("request_uri")).dropDuplicates(["record_id"])
    rows = main.join(meta, "record_id", "left").join(request, "record_id", "left")
    asked = main.where(F.col("type") == "revisit").select(F.col("refers_to").alias("record_id")).distinct()
    targets = meta.join(asked, "record_id", "left_semi").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"))
    rows = rows.join(targets, "refers_to", "left")
    return rows.select(
        "record_id", F.struct("request_id", "request_uri").alias("request"),
        F.struct("type", "target_uri", "payload", "payload_bytes", "payload_digest").alias("response"),
        F.struct("metadata_id", "page_id").alias("metadata"), F.col("to_page").alias("refers_to"))


def captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives to the shared folder and assembles what they hold. The parsed records are written too: the joins
    take them from there, column by column, instead of parsing the archives once for each kind."""
    path = shared_path(spark, "warc")
    write(pages, path)
    return assemble(cut(read(spark, path), "warc-records"))


ORACLE = """
with t as (select page_id, coalesce(html, '') as h from pages),
m as (select h, max(page_id) as top from t where strlen(h) >= 1000 group by h)
select t.page_id, strlen(t.h) as payload_bytes, sha1(t.h) as payload_digest,
       case when top is null or top = t.page_id then 'response' else 'revisit' end as record_type,
       case when top is distinct from t.page_id then top end as refers_to
from t left join m using (h)
"""
