"""Registered ingest queries: key rules, document grouping, page table,
envelope decoding, file moves and folder counts (KEYS / ENV bindings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import keys as K
from doclake.operators import ingest as I
from doclake.plans import bindings as B
from doclake.sources import envelope as V

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DUCK_TS_FMT = "%Y-%m-%d %H:%M:%S"

_BASENAME = "string_split(object_key, '/')[-1]"
_PAGE_RE = r"'^(.+?)[_-](\d+)\.(.+)$'"
_SPLITEXT = r"'^(\.*[^.].*)(\.[^.]*)$'"
_BASE_SQL = f"""CASE WHEN regexp_extract({_BASENAME}, {_PAGE_RE}, 1) <> '' THEN regexp_extract({_BASENAME}, {_PAGE_RE}, 1)
        WHEN regexp_extract({_BASENAME}, {_SPLITEXT}, 1) <> '' THEN regexp_extract({_BASENAME}, {_SPLITEXT}, 1)
        ELSE {_BASENAME} END"""
_PAGE_SQL = f"CAST(nullif(regexp_extract({_BASENAME}, {_PAGE_RE}, 2), '') AS BIGINT)"
_ROUTE_SQL = ("CASE WHEN object_key LIKE 'incoming/%' AND (" + " OR ".join(
    f"suffix(object_key, '{s}')" for s in K.DOCUMENT_SUFFIXES)
    + ") THEN 'document' WHEN object_key LIKE 'incoming/%' AND suffix(object_key, '.zip') THEN 'archive' END")
_MIME_SQL = "coalesce(content_type IN (" + ", ".join(f"'{m}'" for m in K.SUPPORTED_MIME_TYPES) + "), false)"

PARSED_SQL = f"""
    SELECT object_key, content_type, event_time, bucket, l_orderkey, l_linenumber,
           {_BASE_SQL} AS base_name, {_PAGE_SQL} AS page_no,
           regexp_extract({_BASENAME}, {_SPLITEXT}, 2) AS extension,
           {_ROUTE_SQL} AS route, {_MIME_SQL} AS mime_ok
    FROM ({B.MANIFEST_SQL})"""

ACCEPTED_SQL = f"""
    SELECT * FROM ({PARSED_SQL}) p
    WHERE route = 'document' AND mime_ok
      AND base_name NOT IN (SELECT original_filename FROM ({B.EXISTING_SQL}))"""


def _parsed(spark, sf_dir):
    return I.parse_keys(B.manifest(spark, sf_dir))


def _accepted(spark, sf_dir):
    return I.skip_existing(I.accepted_pages(_parsed(spark, sf_dir)), B.existing_documents(spark, sf_dir))


def keys_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key rules on every stored object."""
    return _parsed(spark, sf_dir).select("object_key", "base_name", "page_no", "extension",
                                         "content_type", "route", "mime_ok")


def keys_parse_sql() -> str:
    return f"SELECT object_key, base_name, page_no, extension, content_type, route, mime_ok FROM ({PARSED_SQL})"


def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New document records: accepted pages minus existing bases, grouped."""
    d = I.document_records(_accepted(spark, sf_dir))
    return d.select("document_id", "status", "original_filename", "bucket_name", "pages_received",
                    "first_page_no", "last_page_no", "ocr_mode",
                    F.date_format("created_at", TS_FMT).alias("created_at"))


def ingest_documents_sql() -> str:
    return f"""
    SELECT sha256(bucket || '|' || base_name) AS document_id, 'OCR_RUNNING' AS status,
           base_name AS original_filename, bucket AS bucket_name,
           CAST(count(DISTINCT object_key) AS BIGINT) AS pages_received,
           min(page_no) AS first_page_no, max(page_no) AS last_page_no,
           CASE WHEN count(DISTINCT object_key) = 1 THEN 'SYNC' ELSE 'ASYNC' END AS ocr_mode,
           strftime(max(event_time), '{DUCK_TS_FMT}') AS created_at
    FROM ({ACCEPTED_SQL}) GROUP BY bucket, base_name"""


def ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page table with numeric page order."""
    return I.page_table(_accepted(spark, sf_dir), order="numeric").select(
        "document_id", "object_key", "page_no", "page_ordinal")


def _pages_sql(order: str) -> str:
    return f"""
    SELECT sha256(bucket || '|' || base_name) AS document_id, object_key, page_no,
           CAST(row_number() OVER (PARTITION BY bucket, base_name ORDER BY {order}) AS BIGINT) AS page_ordinal
    FROM (SELECT DISTINCT bucket, base_name, object_key, page_no FROM ({ACCEPTED_SQL}))"""


def ingest_pages_sql() -> str:
    return _pages_sql("page_no NULLS LAST, object_key")


def ingest_pages_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page table in plain text order of the keys (F1, T4)."""
    return I.page_table(_accepted(spark, sf_dir), order="lexical").select(
        "document_id", "object_key", "page_no", "page_ordinal")


def ingest_pages_lexical_sql() -> str:
    return _pages_sql("object_key")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed objects refused by the MIME check, kept with the reason."""
    return I.rejected_objects(_parsed(spark, sf_dir)).select("object_key", "route", "error_reason")


def ingest_rejects_sql() -> str:
    return f"""
    SELECT object_key, route, 'unsupported content type: ' || coalesce(content_type, 'none') AS error_reason
    FROM ({PARSED_SQL}) WHERE route IS NOT NULL AND NOT (route = 'archive' OR mime_ok)"""


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level envelope decode with quarantine rows."""
    msgs = B.queue_messages(spark, sf_dir)
    return V.decode_storage_events(msgs, ["message_id"], prefix="incoming/").select(
        "message_id", "record_idx", "bucket", "object_key", "error_reason")


def envelope_decode_sql() -> str:
    return f"""
    WITH m AS ({B.QUEUE_MESSAGES_SQL}),
    v AS (SELECT message_id, body, json_valid(body) AS ok FROM m),
    r AS (SELECT message_id,
                 CASE WHEN NOT ok THEN 'malformed_json'
                      WHEN json_extract_string(body, '$.Event') = 's3:TestEvent' THEN 'test_event'
                      WHEN coalesce(json_array_length(json_extract(body, '$.Records')), 0) = 0 THEN 'no_records'
                 END AS reason, body FROM v),
    good AS (SELECT message_id, recs, unnest(range(len(recs))) AS i
             FROM (SELECT message_id, json_extract(body, '$.Records[*]') AS recs FROM r WHERE reason IS NULL))
    SELECT message_id, CAST(i AS INTEGER) AS record_idx, json_extract_string(recs[i + 1], '$.s3.bucket.name') AS bucket,
           url_decode(replace(json_extract_string(recs[i + 1], '$.s3.object.key'), '+', ' ')) AS object_key,
           CASE WHEN url_decode(replace(json_extract_string(recs[i + 1], '$.s3.object.key'), '+', ' ')) NOT LIKE 'incoming/%'
                THEN 'outside_prefix' END AS error_reason
    FROM good
    UNION ALL
    SELECT message_id, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), reason
    FROM r WHERE reason IS NOT NULL"""


def file_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(old_key, new_key) moves of every ingested page to complete/."""
    return I.file_moves(I.distinct_pages(_accepted(spark, sf_dir))).select("document_id", "old_key", "new_key")


def file_moves_sql() -> str:
    return f"""
    SELECT document_id, object_key AS old_key,
           replace(object_key, 'incoming/', 'complete/' || document_id || '/') AS new_key
    FROM (SELECT DISTINCT sha256(bucket || '|' || base_name) AS document_id, object_key FROM ({ACCEPTED_SQL}))"""


def folder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects per top folder after a run (D14, B21), one pass over the manifest:
    ingested pages moved to complete/, their page texts in staging/, one result
    per document in results/, archives in archive/, everything else still in incoming/."""
    parsed = _parsed(spark, sf_dir)
    existing = B.existing_documents(spark, sf_dir).select(
        F.col("original_filename").alias("base_name"), F.lit(True).alias("_exists")).distinct()
    flagged = parsed.join(existing, "base_name", "left").withColumn(
        "accepted", F.coalesce((F.col("route") == "document") & F.col("mime_ok") & F.col("_exists").isNull(),
                               F.lit(False)))
    return I.folder_counts_after_run(flagged).select("folder", F.col("n_objects").cast("bigint").alias("n_objects"))


def folder_counts_sql() -> str:
    return f"""
    WITH parsed AS ({PARSED_SQL}), acc AS ({ACCEPTED_SQL}),
    pages AS (SELECT sha256(bucket || '|' || base_name) AS document_id, object_key,
                     row_number() OVER (PARTITION BY bucket, base_name ORDER BY page_no NULLS LAST, object_key) AS ord
              FROM (SELECT DISTINCT bucket, base_name, object_key, page_no FROM acc)),
    k AS (
      SELECT replace(object_key, 'incoming/', 'complete/' || document_id || '/') AS object_key FROM pages
      UNION ALL SELECT 'staging/' || document_id || '/text_page_' || CAST(ord AS VARCHAR) || '.txt' FROM pages
      UNION ALL SELECT DISTINCT 'results/' || document_id || '_response.json' FROM pages
      UNION ALL SELECT 'archive/' || string_split(object_key, '/')[-1] FROM parsed WHERE route = 'archive'
      UNION ALL SELECT object_key FROM parsed
                WHERE object_key NOT IN (SELECT object_key FROM acc) AND coalesce(route <> 'archive', true))
    SELECT string_split(object_key, '/')[1] AS folder, CAST(count(*) AS BIGINT) AS n_objects FROM k GROUP BY 1"""
