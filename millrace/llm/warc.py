"""WARC archives: written from pages, read back, and assembled to one row a capture.

Writing. Of pages with equal payloads the one with the smallest id is a response, the others are revisits that refer
to it. Every page also gets a request and a metadata record, both concurrent to its response or revisit. Files come from
Spark's own text writer (any file system, its commit protocol, gzip): a row holds whole records without the last line
feed, which that writer adds. Rows hold about `chunk` bytes and files 64 rows, so files stay small enough to be read whole.

Reading. Each file is a row; records are found by their lengths, never by marks that a payload might hold.

Assembly. Requests and metadata name their capture, or the capture names them, through WARC-Concurrent-To; metadata may
also name a request. These names are joined as tables; nothing is gathered per capture but one record of each kind
and counts.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import io
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ship

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES, OTHERS = ("response", "revisit", "resource"), ("request", "metadata")

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("refers_to", T.StringType()),
    T.StructField("declared_digest", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType())])


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(kind: str, page, digest: str) -> str:
    h = hashlib.sha256(f"{kind} {page} {digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def record(kind: str, name: str, date: str, uri: str | None, content_type: str, block: bytes, **more) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else quote(c) for c in uri))
    lines += [f"WARC-{key.replace('_', '-')}: {value}" for key, value in more.items()]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def transaction(page, url: str | None, payload: bytes, first, date: str) -> bytes:
    """The three records of one page; `first` is the page whose response has the same payload, or None."""
    digest = base32(hashlib.sha1(payload).digest())
    name = record_id("capture", page, digest)
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    http = "application/http; msgtype="
    if first is None:
        capture = record("response", name, date, url, http + "response", head + payload,
                         Payload_Digest=f"sha1:{digest}")
    else:
        capture = record("revisit", name, date, url, http + "response", head, Payload_Digest=f"sha1:{digest}",
                         Profile=PROFILE, Refers_To=record_id("capture", first, digest))
    try:
        parts = urlsplit(url or "")
    except ValueError:
        parts = urlsplit("")
    path = quote((parts.path or "/") + (f"?{parts.query}" if parts.query else ""), safe="/?&=%")
    ask = f"GET {path} HTTP/1.1\r\nHost: {quote(parts.netloc, safe=':@')}\r\n\r\n".encode()
    return (capture
            + record("request", record_id("request", page, digest), date, url, http + "request", ask, Concurrent_To=name)
            + record("metadata", record_id("metadata", page, digest), date, url, "application/warc-fields",
                     b"" if page is None else f"page-id: {page}\r\n".encode(), Concurrent_To=name))


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", date: str = "2000-01-01T00:00:00Z", chunk: int = 1 << 20) -> None:
    """Writes a transaction for every row of `pages` to gzipped files below `path`.

    Payloads of at least `least` bytes are stored once. A null payload is empty; a null url gives no target; a row
    without an id is always a response. Rows that repeat the smallest id of a payload are all responses.
    """
    ship(pages.sparkSession)
    own = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload"))
    # Sums of a popular payload are formed before the shuffle; only payloads that occur again are joined.
    again = (own.where((F.length("payload") >= least) & F.col("page").isNotNull()).groupBy("sha1")
             .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first"))
    dealt = own.join(again, "sha1", "left").select(
        "page", "url", F.when(F.col("first") != F.col("page"), F.col("first")).alias("first"), "payload")

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for page, url, first, payload in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(transaction(page, url, payload, first, date))
                size += len(held[-1])
                if size >= chunk:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])

    (dealt.mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
     .write.option("compression", "gzip").option("maxRecordsPerFile", 64).text(path))


def headers(stream) -> list[tuple[str, str]]:
    """Name (small letters) and value of each line up to the empty one."""
    out = []
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        if line[:1] in b" \t" and out:
            out[-1] = (out[-1][0], out[-1][1] + " " + line.decode("utf-8", "replace").strip())
        else:
            out.append((name.strip().lower(), value.strip()))
    return out


def records_of(data: bytes):
    """Header list and block of every record of a file."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    stream = io.BufferedReader(stream) if not isinstance(stream, io.BytesIO) else stream
    while True:
        line = stream.readline()
        while line and not line.strip():
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = headers(stream)
        size = int(dict(head)["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record is cut off")
        yield head, block


def parsed(head: list[tuple[str, str]], block: bytes, with_payload: bool) -> dict:
    one = dict(head)
    kind, form = one.get("warc-type"), one.get("content-type", "")
    fields, payload = [], block
    if form.startswith("application/http"):
        stream = io.BytesIO(block)
        stream.readline()
        fields = headers(stream)
        payload = stream.read()
    elif form.startswith("application/warc-fields"):
        fields, payload = headers(io.BytesIO(block)), b""
    declared = one.get("warc-payload-digest", "").rpartition(":")[2] or None
    digest, size = base32(hashlib.sha1(payload).digest()), len(payload)
    fields = dict(fields)
    if kind == "revisit":  # both of the full payload, which stands elsewhere
        digest = declared
        size = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None
    return {"record_id": one.get("warc-record-id"), "type": kind, "date": one.get("warc-date"),
            "target_uri": one.get("warc-target-uri"),
            "concurrent_to": [v for k, v in head if k == "warc-concurrent-to"], "refers_to": one.get("warc-refers-to"),
            "declared_digest": declared, "payload_digest": digest, "payload_bytes": size, "fields": fields,
            "payload": payload if with_payload else None}


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the files below `path` (RECORD). Payload digests and lengths are computed from what the file
    holds; a revisit has those that it states."""
    ship(spark)

    def parse(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(RECORD)
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for head, block in records_of(content.as_buffer()):
                    held.append(parsed(head, block, with_payload))
                    size += len(block)
                    if size >= 1 << 20 or len(held) >= 2000:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, capture, request, metadata, n_requests, n_metadata.

    `records` is read several times; pass a stored table. Of several requests (or metadata records) of one capture the
    smallest id is nested and all are counted. Requests and metadata that lead to no capture give rows of their own with
    a null capture. Records without an id cannot be named: captures stand alone, others are such loose rows.
    """
    row = F.struct(*[F.col(c) for c in records.columns]).alias("row")
    captures = records.where(F.col("type").isin(*CAPTURES)).select(F.col("record_id").alias("capture_id"), row)
    others = records.where(F.col("type").isin(*OTHERS)).select(F.col("record_id").alias("other"), row)
    names = captures.select("capture_id").where("capture_id is not null").distinct()
    named = (others.select("other", F.explode("row.concurrent_to").alias("to"))
             .unionByName(captures.select(F.explode("row.concurrent_to").alias("other"), F.col("capture_id").alias("to")))
             .where("other is not null and to is not null").distinct())
    direct = named.join(names, F.col("to") == F.col("capture_id")).select("other", "capture_id")
    via = (named.join(direct.select("other").distinct(), "other", "left_anti")
           .join(direct.withColumnRenamed("other", "to"), "to").select("other", "capture_id"))
    led = direct.unionByName(via).distinct()
    own = led.join(others, "other")
    kind = lambda k: F.col("row.type") == k
    first = lambda k: F.min_by(F.when(kind(k), F.col("row")), F.when(kind(k), F.col("other")))
    held = own.groupBy("capture_id").agg(first("request").alias("request"), first("metadata").alias("metadata"),
                                         F.count_if(kind("request")).alias("n_requests"),
                                         F.count_if(kind("metadata")).alias("n_metadata"))
    whole = captures.join(held, "capture_id", "left").select(
        "capture_id", F.col("row").alias("capture"), "request", "metadata",
        F.coalesce("n_requests", F.lit(0)).cast("long").alias("n_requests"),
        F.coalesce("n_metadata", F.lit(0)).cast("long").alias("n_metadata"))
    loose = others.join(led.select("other").distinct(), "other", "left_anti").select(
        F.lit(None).cast("string").alias("capture_id"), F.lit(None).cast(RECORD).alias("capture"),
        F.when(kind("request"), F.col("row")).alias("request"), F.when(kind("metadata"), F.col("row")).alias("metadata"),
        kind("request").cast("long").alias("n_requests"), kind("metadata").cast("long").alias("n_metadata"))
    return whole.unionByName(loose)


def pages_of(captures: DataFrame) -> DataFrame:
    """The pages that `write` stored, from assembled captures: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to (the page whose response has the payload)."""
    flat = captures.where("capture is not null").select(
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"), F.col("capture.target_uri").alias("url"),
        "capture.payload_bytes", "capture.payload_digest", F.col("capture.type").alias("record_type"),
        "capture_id", F.col("capture.refers_to").alias("to"))
    told = (flat.where("record_type = 'response'").groupBy(F.col("capture_id").alias("to"))
            .agg(F.min("page_id").alias("refers_to")))
    return flat.drop("capture_id").join(told, "to", "left").drop("to")
