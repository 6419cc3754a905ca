"""WARC archives with revisit resolution.

Every page becomes one WARC/1.1 record: a small HTTP response whose payload is
the html in UTF-8. Headers (page, length, SHA-1 of the payload) are shuffled
by payload digest; of the records with equal payloads of at least
``min_bytes`` bytes that with the largest page_id is the original response,
and the others are joined to it and written as revisit records without a
payload, with fresh headers that name the original. The payloads themselves
only move if the written table of shared digests is larger than Spark sends to
tasks (its broadcast threshold).

The archives are written with Spark's text sink (one record per row, the blank
lines between records as separator), so they land in any store Spark can write
to, and are read back as whole files and parsed by Content-Length.

Defined cases: a null html is an empty payload; a null page_id loses its
header and comes back null, and never names an original unless all equal
payloads have none (then each is a response); rows with the same page_id and
payload are each a record of their own, of equal type; line breaks and blanks
in a url are percent-encoded, a null url has no header; an empty table writes
no record; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, scratch, staged

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 5000
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"


def _urn(*parts: Column) -> Column:
    """A record id that depends only on what it names."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[
        x for k, (at, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        for x in ([F.lit("-")] if k else []) + [F.substring(h, at, n)]], F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)))


def page_headers(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, n_bytes, digest`` of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url")
    for raw, coded in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        url = F.replace(url, F.lit(raw), F.lit(coded))
    return pages.select("page_id", url.alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("n_bytes"),
        F.sha1(F.col("payload").cast("binary")).alias("digest"))


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``original`` (page_id of the response) to the headers that are revisits, null to the rest."""
    originals = (headers.select("page_id", "digest", "n_bytes").where(F.col("n_bytes") >= min_bytes)
                 .groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")))
    # written first, so that its size is known when the join is planned: Spark sends it to the tasks if it is small
    # and shuffles both sides if it isn't
    originals = staged(originals.where("n > 1").select(F.col("digest").alias("shared"), "first"), "originals")
    # short payloads get keys of their own, so that they never meet in one task
    key = F.when(F.col("n_bytes") >= min_bytes, F.col("digest")).otherwise(
        F.concat(F.lit("short "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    joined = headers.withColumn("shared", key).join(originals, "shared", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select(*headers.columns, F.when(again, F.col("first")).alias("original"))


def records(resolved: DataFrame, date: str = DATE) -> DataFrame:
    """One WARC record per row, as text without the closing blank lines."""
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    kind = F.when(revisit, "revisit").otherwise("response")
    own = _urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("digest"))
    refers = F.when(revisit, _urn(F.lit("response"), F.col("original").cast("string"), F.col("digest")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.when(revisit, _urn(
            F.lit("revisit"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("digest"))).otherwise(own)),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", refers), _header("X-Refers-To-Page", F.col("original")),
        _header("WARC-Profile", F.when(
            revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("X-Page", F.col("page_id")), _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)), F.lit(CRLF))
    return resolved.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Write the deduplicated archives of ``pages`` (page_id, url, html) as gzip files below ``path``."""
    (records(resolve(page_headers(pages), min_bytes), date).write
     .option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(data: bytes):
    """(headers, payload) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        block = data[start:start + int(head["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        head |= {f"http.{k}": v for k, v in (x.split(": ", 1) for x in http.decode().split(CRLF)[1:])}
        yield head, payload
        at = start + len(block) + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``; ``intact``: a response's payload has the stated length and digest."""
    bounded_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "record_id string, target_uri string, intact boolean")
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}

    def rows(batches):
        for b in batches:
            for content in b.column("content"):
                out = []
                for head, payload in parse(gzip.decompress(content.as_py())):
                    page, origin = head.get("X-Page"), head.get("X-Refers-To-Page")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    n = int(head["http.Content-Length"])
                    intact = head["WARC-Type"] == "revisit" or (
                        len(payload) == n and hashlib.sha1(payload).hexdigest() == digest)
                    out.append((page and int(page), n, digest, head["WARC-Type"], origin and int(origin),
                                head["WARC-Record-ID"], head.get("WARC-Target-URI"), intact))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], types[x.split()[1]]) for k, x in enumerate(schema.split(", "))],
                    names=names)

    return files.mapInArrow(rows, schema)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and return what reading them back gives."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
