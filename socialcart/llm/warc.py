"""WARC: write captures as request, response (or revisit) and metadata
records, read archives back, and assemble one nested row per capture.

Writing uses Spark's text writer: a record is one string and ``lineSep`` is
the two line ends that close a record, so the files are plain WARC/1.1
(gzip-compressed) in any store that Spark can write.  Equal payloads of at
least ``min_revisit`` bytes are stored once: the page with the smallest id is
the response, the others are revisit records that name its digest and URI.

Reading takes whole archive files from Spark (``binaryFile``; a file holds at
most ``RECORDS_PER_FILE`` records), and walks the records by Content-Length,
so payloads may contain any bytes, WARC headers included.

Assembly meets the records of a capture by the concurrent-to identifier:
request and metadata name the response's record id in WARC-Concurrent-To, the
response counts under its own id.  The meeting is an aggregate with a bounded
state (one record of each kind and counts), so no capture is collected.

Defined cases: null html is an empty payload; a null url writes no target
URI; control characters and blanks in a url are percent-encoded; a null page
id writes no page id and comes last when the response is chosen; rows
repeated with one id are captures of their own, and all those with the
smallest id of their group are responses; other columns are not looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root

from .common import join_by_key, map_arrow, scratch_table

MIN_REVISIT = 100
RECORDS_PER_FILE = 30_000
EPOCH = "1970-01-01T00:00:00Z"

# Names and values of the WARC/1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, target_uri string, date string, "
                 "refers_to_uri string, payload_digest string, payload_bytes long, block_digest string, "
                 "fields map<string,string>, payload binary")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, rid: Column, concurrent: Column, uri: Column, date: str, mime: str, more: Column,
            block: Column) -> Column:
    return F.concat(F.lit(f"{VERSION}\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", rid),
                    _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", uri),
                    _line("WARC-Concurrent-To", concurrent), more, _line("Content-Type", F.lit(mime)),
                    _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def _safe_uri(url: Column) -> Column:
    for char in ("\r", "\n", "\t", " "):
        url = F.replace(url, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return F.regexp_replace(url, r"[\x00-\x1F\x7F]", "")


def _new_id() -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))


def response_table(pages: DataFrame, id_col: str, url_col: str, html_col: str,
                   min_revisit: int) -> tuple[DataFrame, int]:
    """(sha, first id and url, n) of the payloads that occur more than once,
    as a stored table, and the number of pages."""
    narrow = scratch_table(pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        F.sha2(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 256).alias("sha"),
        F.octet_length(F.coalesce(F.col(html_col), F.lit(""))).alias("n_bytes")), "payloads")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("url").alias("url")))
    groups = (narrow.where(F.col("n_bytes") >= min_revisit).groupBy("sha")
              .agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    return scratch_table(groups, "responses"), narrow.count()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = MIN_REVISIT, date: str = EPOCH) -> None:
    """Write the archives of ``pages`` below ``path``."""
    groups, total = response_table(pages, id_col, url_col, html_col, min_revisit)
    own = pages.select(F.col(id_col).alias("id"), _safe_uri(F.col(url_col)).alias("uri"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("sha", F.sha2(F.col("html").cast("binary"), 256))
    own = join_by_key(own, groups, "sha", "n", total)
    revisit = F.col("found").isNotNull() & ~F.col("id").eqNullSafe(F.col("found.first.id"))
    own = own.withColumn("revisit", revisit).withColumn("rid", _new_id())

    none = F.lit(None).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", F.octet_length("html").cast("string")), F.lit("\r\n"))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha")))
    points = F.concat(_line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                      _line("WARC-Refers-To-Target-URI", _safe_uri(F.col("found.first.url"))))
    capture = _record(F.when(F.col("revisit"), "revisit").otherwise("response"), F.col("rid"), none, F.col("uri"),
                      date, "application/http;msgtype=response",
                      F.concat(digest, F.when(F.col("revisit"), points).otherwise("")),
                      F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("html"))))
    host = F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    asked = F.regexp_replace("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|#.*$", "")
    request = _record(F.lit("request"), _new_id(), F.col("rid"), F.col("uri"), date, "application/http;msgtype=request",
                      F.lit(""), F.concat(F.lit("GET "), F.coalesce(asked, F.lit("/")), F.lit(" HTTP/1.1\r\n"),
                                          F.lit("Host: "), F.coalesce(host, F.lit("")), F.lit("\r\n\r\n")))
    metadata = _record(F.lit("metadata"), _new_id(), F.col("rid"), F.col("uri"), date, "application/warc-fields",
                       F.lit(""), F.concat(_line("page-id", F.col("id").cast("string")),
                                           _line("refers-to-page", F.when(F.col("revisit"), F.col("found.first.id").cast("string")))))
    (own.select(F.explode(F.array(request, capture, metadata)).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in iter(stream.readline, b""):
        if line in (b"\r\n", b"\n"):
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse_archive(data: bytes, keep_payload: bool = True) -> Iterator[dict]:
    """The records of one archive file, plain or gzip (one member or many)."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    for line in iter(stream.readline, b""):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head = _headers(stream)
        block = stream.read(int(head["content-length"]))
        if len(block) < int(head["content-length"]):
            raise ValueError(f"record {head.get('warc-record-id')} is cut off")
        out = {"record_id": head.get("warc-record-id"), "type": head.get("warc-type"),
               "concurrent_to": head.get("warc-concurrent-to"), "target_uri": head.get("warc-target-uri"),
               "date": head.get("warc-date"), "refers_to_uri": head.get("warc-refers-to-target-uri"),
               "payload_digest": (head.get("warc-payload-digest") or "").partition(":")[2] or None}
        mime = head.get("content-type", "")
        if mime.startswith("application/http"):
            body = io.BytesIO(block)
            out["fields"] = {"start-line": body.readline().decode("utf-8", "replace").strip()} | _headers(body)
            payload = block[body.tell():]
            if out["type"] == "revisit":
                out["payload_bytes"] = int(out["fields"].get("content-length", 0))
            else:
                out["payload_bytes"] = len(payload)
                out["block_digest"] = hashlib.sha256(payload).hexdigest()
                out["payload"] = payload if keep_payload else None
        else:
            out["fields"] = _headers(io.BytesIO(block)) if mime.startswith("application/warc-fields") else {}
            out["payload_bytes"], out["payload"] = len(block), block if keep_payload else None
        yield out


def read_records(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.  Without payloads
    only their lengths and digests are kept."""
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()),
                        ("target_uri", pa.string()), ("date", pa.string()), ("refers_to_uri", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("block_digest", pa.string()),
                        ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for r in parse_archive(content.as_py(), keep_payload):
                    rows.append(r | {"fields": list(r["fields"].items())})
                    held += len(r.get("payload") or b"") + 1000
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_arrow(files, read, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its id, the response or revisit record,
    the request and the metadata record, and how many of each were found.
    Request and metadata records without a response make a row, too."""
    whole = F.struct("record_id", "type", "target_uri", "date", "refers_to_uri", "payload_digest", "payload_bytes",
                     "block_digest", "fields", "payload")
    kind = F.when(F.col("type").isin("response", "revisit"), "response").otherwise(F.col("type"))
    own = records.select(F.coalesce("concurrent_to", "record_id").alias("capture_id"), kind.alias("kind"),
                         F.col("record_id"), whole.alias("r"))
    aggs = []
    for k in ("response", "request", "metadata"):
        of = F.col("kind") == k
        aggs += [F.max_by(F.when(of, F.col("r")), F.when(of, F.col("record_id"))).alias(k),
                 F.count_if(of).alias(f"n_{k}")]
    return own.groupBy("capture_id").agg(*aggs)


def archive_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and
    return per page what the captures say (see the module docstring)."""
    spark = pages.sparkSession
    path = f"{checkpoint_root(spark)}/llm-warc-{uuid.uuid4().hex}"
    write_archives(pages, path, min_revisit=min_revisit)
    captures = assemble(read_records(spark, path, keep_payload=False))
    meta, got = F.col("metadata.fields"), F.col("response")
    return captures.where(got.isNotNull()).select(
        F.element_at(meta, "page-id").cast("long").alias("page_id"), got["payload_bytes"].alias("payload_bytes"),
        # of a stored payload, the digest of the bytes that were read
        F.coalesce(got["block_digest"], got["payload_digest"]).alias("payload_digest"),
        got["type"].alias("record_type"), F.element_at(meta, "refers-to-page").cast("long").alias("refers_to"))
