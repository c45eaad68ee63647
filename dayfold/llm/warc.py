"""WARC archives of crawled pages: writing, reading, and assembling transactions.

Writing is a Spark text write whose records end in CRLF CRLF, so each part file is a gzip-compressed WARC file and the
usual commit protocol covers lost executors. Every page becomes three records: a response (or a revisit of an equal
payload), and a request and a metadata record whose WARC-Concurrent-To names it. Equal payloads are found by their
digest with a grouped minimum, so a payload that a third of all pages share is one row per task in that shuffle.

Reading parses the files by Content-Length, as a stream: a task holds one compressed part file and one record. A
payload that itself looks like a WARC record is therefore read back unharmed. Assembly is the full outer equi-join of
the request, response and metadata records on the record they name, done as one grouping on that identifier, and
gives one nested row per capture.

Defined results: a null payload is an empty one; a null URL has no WARC-Target-URI; control characters and blanks in
a URL are written as %20; rows of one page with the same payload are one capture with ``copies`` > 1; rows sharing the
smallest page_id of a payload are all responses; a page without id never is the response others refer to; records that
lack a partner leave its struct null; an empty table gives no captures; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
#: Records per part file at most; Spark's partition sizes bound the bytes.
FILE_RECORDS = 30_000


def _uuid(*parts) -> F.Column:
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind, record_id, date: str, content_type: str, block, more: list) -> F.Column:
    """One record without the CRLF CRLF that ends it. ``more``: (header, column); a null value leaves the header out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
             F.lit(f"WARC-Date: {date}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in more]
    lines += [F.lit(f"Content-Type: {content_type}"),
              F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   min_revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a response or revisit, a request and a metadata record per row to WARC files below ``path``."""
    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.regexp_replace(F.col(f"`{url_col}`"), r"[\x00-\x20\x7F]", "%20").alias("url"),
                     F.coalesce(F.col(f"`{body_col}`").cast("string"), F.lit("")).alias("body"))
    p = p.withColumns({"digest": F.sha2("body", 256), "size": F.octet_length("body")})
    first = (p.where(F.col("size") >= min_revisit_bytes).groupBy("digest")
             .agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null")
             .select("digest", "first_id"))
    p = p.join(first, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    kind = F.when(again, "revisit").otherwise("response")
    page = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    own = _uuid(kind, page, "digest")
    p = p.withColumns({"kind": kind, "page": page, "own": own})
    uri = ("WARC-Target-URI", F.col("url"))
    head = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.col("size").cast("string"), F.lit(CRLF * 2))
    response = _record(F.col("kind"), F.col("own"), date, "application/http; msgtype=response",
                       F.when(again, head).otherwise(F.concat(head, "body")),
                       [uri, ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
                        ("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
                        ("WARC-Refers-To", F.when(again, _uuid(F.lit("response"), F.col("first_id").cast("string"),
                                                               "digest")))])
    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("-"))
    file = F.coalesce(F.try_parse_url("url", F.lit("FILE")), F.lit("/"))
    request = _record(F.lit("request"), _uuid(F.lit("request"), "own"), date, "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.when(file == "", "/").otherwise(file), F.lit(f" HTTP/1.1{CRLF}Host: "),
                               host, F.lit(CRLF * 2)), [uri, ("WARC-Concurrent-To", F.col("own"))])
    metadata = _record(F.lit("metadata"), _uuid(F.lit("metadata"), "own"), date, "application/warc-fields",
                       F.concat(F.lit("page-id: "), "page", F.lit(CRLF)), [uri, ("WARC-Concurrent-To", F.col("own"))])
    (p.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .text(path))


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every whole record of a WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()) not in (b"", b"\r\n", b"\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length") or 0)
        block = stream.read(length)
        if len(block) == length:
            yield headers, block


def _fields(text: bytes) -> list[tuple[str, str]]:
    pairs = (x.partition(":") for x in text.decode("utf-8", "replace").splitlines())
    return [(name.strip().lower(), value.strip()) for name, colon, value in pairs if colon]


RECORDS = pa.schema([
    ("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()),
    ("date", pa.string()), ("refers_to", pa.string()), ("status", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))])
RECORDS_SQL = ("record_id string, kind string, concurrent_to string, target_uri string, date string, refers_to string, "
               "status string, payload_bytes long, payload_digest string, payload binary, fields map<string,string>")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record. Size and SHA-256 of a response are taken from the payload read; those of a revisit, which
    has none, from its headers. ``with_payload=False`` leaves the bodies in the task that read them."""
    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers.get("warc-type")
        status = size = digest = payload = None
        fields = []
        if kind in ("response", "revisit"):
            top, _, payload = block.partition(b"\r\n\r\n")
            status, _, rest = top.partition(b"\r\n")
            status, http = status.decode("utf-8", "replace"), dict(_fields(rest))
            if kind == "response":
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            else:
                size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
                digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
                payload = None
        elif kind == "metadata":
            fields = list(dict(_fields(block)).items())
        elif kind == "request":
            status = block.partition(b"\r\n")[0].decode("utf-8", "replace")
        return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
                headers.get("warc-date"), headers.get("warc-refers-to"), status,
                size, digest, payload if with_payload else None, fields)

    def run(batches):
        for rb in batches:
            for content in rb.column(0):
                raw = content.as_buffer()
                stream = io.BytesIO(raw)
                if raw[:2].to_pybytes() == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
                rows, size = [], 0
                for headers, block in records_of(stream):
                    rows.append(row(headers, block))
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield batch(RECORDS, *zip(*rows))
                        rows, size = [], 0
                if rows:
                    yield batch(RECORDS, *zip(*rows))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where("length > 0").select("content").mapInArrow(run, RECORDS_SQL)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, target_uri, date, copies, request, response, metadata. A record belongs
    to the record that its WARC-Concurrent-To names, or to itself if it names none."""
    def one(*kinds: str) -> F.Column:
        keep = [c for c in records.columns if c not in ("concurrent_to", "target_uri", "date")]
        return F.first(F.when(F.col("kind").isin(*kinds), F.struct(*keep)), ignorenulls=True)

    main = F.col("kind").isin("response", "revisit")
    wanted = records.where(F.col("kind").isin("request", "response", "revisit", "metadata"))
    return wanted.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        F.first("target_uri", ignorenulls=True).alias("target_uri"), F.first("date", ignorenulls=True).alias("date"),
        F.count(F.when(main, 1)).alias("copies"), one("request").alias("request"),
        one("response", "revisit").alias("response"), one("metadata").alias("metadata"))
