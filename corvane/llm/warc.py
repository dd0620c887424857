"""WARC archives: writing captures with revisit records, reading them back, and assembling transactions.

A capture is three records - request, response (or revisit) and metadata - tied by WARC-Concurrent-To. Spark's text
writer makes the files, with the end of a record as line separator, so that archives go to whatever store Spark writes
to and a lost task is simply written again; every file is a gzip stream of whole records. Spark's text reader streams
them back, cut at empty lines, and the pieces are put together again by each record's Content-Length, never by what
payloads happen to contain: a record is held in memory at a time, not a file. Assembly brings the records of a capture
together by the identifier that they are concurrent to, and gives one nested row per capture. A record with a broken
header or a cut-off end is left out, and reading goes on with the next one.

Defined cases: a null html is an empty payload; a null or odd url is percent-escaped or left out of the headers;
repeated rows are captures of their own (equal page ids with the largest id among equal payloads are all responses);
an empty table makes an empty archive; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, drop_tables, fresh_path, settle, small

CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "type string, record_id string, concurrent_to string, refers_to string, uri string, digest string, payload_bytes long, fields string, block binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digested(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, capture (a unique id), digest, n_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [x.as_py().encode() for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([sha1_base32(p) for p in payloads], pa.string()), pa.array([len(p) for p in payloads], pa.int64())], [*b.schema.names, "digest", "n_bytes"])

    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    base = base.withColumn("capture", F.md5(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.monotonically_increasing_id().cast("string"))))
    return base.mapInArrow(run, "page_id long, url string, html string, capture string, digest string, n_bytes long")


def _urn(kind: str, capture: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), capture))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write request, response or revisit, and metadata records of every row below ``path``.

    Of rows with equal payloads of at least min_bytes, that with the largest id is the response that others revisit.
    """
    rows = settle(digested(pages, id_col, url_col, html_col), "warc-rows")  # captures must have the same ids wherever they are read
    known = (rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "capture")).alias("top"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("digest").alias("k_digest"), F.col("top.page_id").alias("top_id"), F.col("top.capture").alias("top_capture")))
    known = settle(known, "warc-known")
    joined = rows.join(small(known), (F.col("digest") == F.col("k_digest")) & (F.col("n_bytes") >= min_bytes), "left")
    again = F.coalesce(F.col("page_id") < F.col("top_id"), F.col("top_id").isNotNull() & F.col("page_id").isNull())
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    to = F.coalesce(line("WARC-Target-URI", url), F.lit(""))
    hub = _urn("response", F.col("capture"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END))

    def record(kind: Column, rid: Column, more: list[Column], mime: str, block: Column) -> Column:
        return F.concat(F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind), line("WARC-Record-ID", rid), to, line("WARC-Date", F.lit(date)), *more, line("Content-Type", F.lit(mime)),
                        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)

    host = F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("-"))
    request = record(F.lit("request"), _urn("request", F.col("capture")), [line("WARC-Concurrent-To", hub)], "application/http; msgtype=request", F.concat(F.lit("GET "), F.coalesce(url, F.lit("-")), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(END)))
    refers = F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _urn("response", F.col("top_capture"))))).otherwise(F.lit(""))
    response = record(F.when(again, F.lit("revisit")).otherwise(F.lit("response")), hub, [line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), refers], "application/http; msgtype=response", F.when(again, http).otherwise(F.concat(http, F.col("html"))))
    metadata = record(F.lit("metadata"), _urn("metadata", F.col("capture")), [line("WARC-Concurrent-To", hub)], "application/warc-fields", F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    out = joined.select(F.explode(F.array(request, response, metadata)).alias("value"))
    out.write.option("lineSep", END).option("compression", "gzip").text(path)
    drop_tables(pages.sparkSession, rows, known)


_LINE = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def header(data: bytes) -> dict[str, str] | None:
    """Headers with lower-case names, if this is the head of a record with a valid length."""
    if not data.startswith(b"WARC/"):
        return None
    head = {k.decode("utf-8", "replace").lower(): v.decode("utf-8", "replace").strip() for k, v in _LINE.findall(data + b"\r\n", data.find(b"\n") + 1)}
    return head if re.fullmatch(r"[0-9]{1,18}", head.get("content-length", "")) else None


class Assembler:
    """Records out of pieces of an archive that were cut at empty lines."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.left, self.parts = 0, []

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        if self.head is None:
            piece = piece.lstrip(b"\r\n")
            if (head := header(piece)) is not None:
                self.head, self.left, self.parts = head, int(head["content-length"]) + 4, []
            return
        self.parts += [piece, b"\r\n\r\n"]  # the stream as it was: a block may end within an empty line
        self.left -= len(piece) + 4
        if self.left <= 0:
            head, data = self.head, b"".join(self.parts)
            self.head, self.parts = None, []
            end = int(head["content-length"])
            if data[end : end + 4] == b"\r\n\r\n":
                yield head, data[:end]
                rest = data[end + 4 : -4]
            else:  # the length was wrong: what follows may be a record
                at = data.find(b"WARC/", end)
                rest = data[at:-4] if at >= 0 else b""
            if rest:
                yield from self.feed(rest)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of an uncompressed archive."""
    a = Assembler()
    for piece in data.split(b"\r\n\r\n"):
        yield from a.feed(piece)


def read_archive(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """One row per record of gzip archives; digest and payload_bytes are of the payload itself, for revisits as their headers say."""

    def row(head: dict[str, str], block: bytes) -> tuple:
        kind, digest, n = head.get("warc-type"), None, None
        if "http" in head.get("content-type", "") and kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            if kind == "response":
                digest, n = sha1_base32(payload), len(payload)
            else:
                said = {k.lower(): v for k, v in _LINE.findall(http + b"\r\n")}
                digest, n = head.get("warc-payload-digest", "").removeprefix("sha1:"), int(x) if (x := said.get(b"content-length", b"0").strip()).isdigit() else 0
        fields = block.decode("utf-8", "replace") if head.get("content-type") == "application/warc-fields" else None
        return kind, head.get("warc-record-id"), head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"), digest, n, fields, block if with_block else None

    names = ["type", "record_id", "concurrent_to", "refers_to", "uri", "digest", "payload_bytes", "fields", "block"]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, records, rows, size = None, Assembler(), [], 0
        for b in batches:
            for file, piece in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if file != now:
                    now, records = file, Assembler()
                for head, block in records.feed(piece.as_buffer().to_pybytes()):
                    rows.append(row(head, block))
                    size += len(block)
                    if len(rows) >= 2000 or size > 1 << 24:
                        yield table(rows)
                        rows, size = [], 0
        if rows:
            yield table(rows)

    # a compressed file is read by one task, in order
    pieces = spark.read.option("lineSep", END).text(path).select("_metadata.file_path", F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(run, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, request, response (or revisit), metadata; those without a response too."""
    own = F.col("type").isin("response", "revisit", "resource")
    hub = F.when(own, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
    body = F.struct("type", "record_id", "refers_to", "uri", "digest", "payload_bytes", "fields", "block")
    one = lambda cond, name: F.any_value(F.when(cond, body), F.lit(True)).alias(name)
    return records.groupBy(hub.alias("record_id")).agg(one(F.col("type") == "request", "request"), one(own, "response"), one(F.col("type") == "metadata", "metadata"))


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every capture, as read back from archives."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path, **columns)
    t = transactions(read_archive(spark, path, with_block=False))
    page = F.expr("try_cast(regexp_extract(metadata.fields, 'page-id: (-?[0-9]+)', 1) as bigint)")
    flat = settle(t.select("record_id", page.alias("page_id"), "response.payload_bytes", F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("r_id")), "warc-captures")
    asked = flat.where("r_id is not null").select(F.col("r_id").alias("a_id")).distinct()
    drop_path(spark, path)
    known = asked.join(flat, F.col("a_id") == F.col("record_id")).select("a_id", F.col("page_id").alias("refers_to"))
    return flat.join(small(settle(known, "warc-refers")), F.col("r_id") == F.col("a_id"), "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
