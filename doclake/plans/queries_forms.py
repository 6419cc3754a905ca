"""Registered queries over filled forms (PIIX binding), PII-branch messages, and smaller operators of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import keys as K
from doclake.operators import ingest as I
from doclake.operators import pii
from doclake.operators import state as ST
from doclake.plans import bindings as B
from doclake.plans import queries_ingest as G
from doclake.plans.oracle_pii import detections_sql
from doclake.sources import envelope as V
from doclake.sources.tables import table

_PAGES_SQL = f"(SELECT page_no, text FROM ({B.PIIX_SQL}))"


def form_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of personal data in filled forms."""
    return pii.explode_detections(pii.with_detections(B.forms(spark, sf_dir)), ["page_no"])


def form_detections_sql() -> str:
    return detections_sql(_PAGES_SQL, "page_no")


def form_detections_sure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of at least medium confidence (H32), numbered among themselves."""
    found = pii.with_detections(B.forms(spark, sf_dir), min_confidence="medium")
    return pii.explode_detections(found, ["page_no"]).select("page_no", "pii_type", "pii_text", "start_pos", "confidence")


def form_detections_sure_sql() -> str:
    return f"""SELECT page_no, pii_type, pii_text, start_pos, confidence FROM ({detections_sql(_PAGES_SQL, 'page_no')})
    WHERE confidence IN ('medium', 'high')"""


def pii_result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The PII result document of every customer as JSON, its forms in page order."""
    return pii.result_json(pii.with_detections(B.forms(spark, sf_dir)), "document_id", "page_no")


def pii_result_documents_sql() -> str:
    one = """'{"type":"' || pii_type || '","text":' || CAST(to_json(pii_text) AS VARCHAR) || ',"start_pos":' || start_pos
             || ',"end_pos":' || end_pos || ',"confidence":"' || confidence || '"}'"""
    return f"""
    WITH p AS ({B.PIIX_SQL}), d AS ({detections_sql(_PAGES_SQL, 'page_no')}),
    n AS (SELECT p.document_id, count(*) FILTER (d.page_no IS NOT NULL) AS n_found,
                 count(DISTINCT p.page_no) AS n_pages, count(DISTINCT d.page_no) AS n_with,
                 coalesce(string_agg({one}, ',' ORDER BY p.page_no, d.det_idx), '') AS found,
                 list_sort(list_distinct(list(d.pii_type) FILTER (d.pii_type IS NOT NULL))) AS types
          FROM p LEFT JOIN d USING (page_no) GROUP BY p.document_id)
    SELECT document_id, '{{"status":"PII_PROCESSED","detected_pii":' || CASE WHEN n_found > 0 THEN 'true' ELSE 'false' END
           || ',"redacted_images":[],"pii_detections":[' || found || '],"processing_summary":{{"total_pages":' || n_pages
           || ',"pages_with_pii":' || n_with || ',"total_pii_instances":' || n_found || ',"pii_types_detected":['
           || coalesce(array_to_string(list_transform(types, lambda t: '"' || t || '"'), ','), '') || ']}}}}' AS result_json
    FROM n"""


def pii_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the PII branch in both shapes, bad ones with their reason."""
    c = table(spark, sf_dir, "conversations", "conv_id").distinct().selectExpr("conv_id", f"{B.PII_PAYLOAD_SQL} AS payload")
    m = V.decode_pii_messages(c, "conv_id", default_bucket=B.BUCKET)
    return m.select("conv_id", F.col("msg_idx").cast("int").alias("msg_idx"), "document_id",
                    F.array_join("ocr_text_keys", ",").alias("ocr_text_keys"), "bucket_name", "error_reason")


def pii_messages_sql() -> str:
    def direct(source, i):
        return f"""SELECT conv_id, {i} AS msg_idx, CAST(conv_id AS VARCHAR) AS document_id,
           CASE WHEN conv_id % 7 = 0 THEN '' ELSE 'staging/' || conv_id || '/text_page_1.txt' END AS ocr_text_keys,
           CASE WHEN conv_id % 3 = 0 THEN 'other' ELSE '{B.BUCKET}' END AS bucket_name,
           CASE WHEN '{source}' <> 'aws:sqs' THEN 'not_a_queue_record'
                WHEN conv_id % 7 = 0 THEN 'No OCR text keys provided for PII processing' END AS error_reason FROM c"""
    return f"""
    WITH c AS (SELECT DISTINCT conv_id FROM conversations)
    {direct('aws:sqs', 0)} WHERE conv_id % 5 IN (0, 1, 2)
    UNION ALL {direct('aws:sns', 1)} WHERE conv_id % 5 = 2
    UNION ALL SELECT conv_id, 0, NULL, '', '{B.BUCKET}', 'malformed_json' FROM c WHERE conv_id % 5 = 3
    UNION ALL SELECT conv_id, 0, CAST(conv_id AS VARCHAR),
           CASE WHEN conv_id % 7 = 0 THEN '' ELSE 'staging/' || conv_id || '/text_page_1.txt' END,
           CASE WHEN conv_id % 3 = 0 THEN 'other' ELSE '{B.BUCKET}' END, 'malformed_json' FROM c WHERE conv_id % 5 = 4"""


def envelope_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope decoding with both source checks and the prefix: nothing vanishes without a reason."""
    m = B.queue_messages(spark, sf_dir).select(
        "message_id", F.when(F.col("message_id") % 9 == 0, "aws:sns").otherwise("aws:sqs").alias("src"),
        F.when(F.col("message_id") % 8 == 0, F.replace("body", F.lit("aws:s3"), F.lit("custom"))).otherwise(F.col("body"))
        .alias("body"))
    d = V.decode_storage_events(m, ["message_id"], source_col="src", require_sources=True, prefix="incoming/")
    return d.select("message_id", "record_idx", "object_key", "error_reason")


def envelope_sources_sql() -> str:
    return f"""
    SELECT message_id, CASE WHEN message_id % 9 <> 0 THEN record_idx END AS record_idx,
           CASE WHEN message_id % 9 <> 0 THEN object_key END AS object_key,
           CASE WHEN message_id % 9 = 0 THEN 'not_a_queue_record'
                WHEN record_idx IS NOT NULL AND message_id % 8 = 0 THEN 'not_a_storage_record'
                ELSE error_reason END AS error_reason
    FROM ({G.envelope_decode_sql()})
    WHERE message_id % 9 <> 0 OR record_idx IS NULL OR record_idx = 0"""


def doc_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose file name starts with a prefix."""
    return ST.by_filename_prefix(B.state_documents(spark, sf_dir), "ORD12").select("document_id", "original_filename")


def doc_prefix_sql() -> str:
    return f"SELECT document_id, original_filename FROM ({B.STATE_DOCS_SQL}) WHERE original_filename LIKE 'ORD12%'"


def page_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored objects that share a base name with an arriving first page."""
    listing = G._parsed(spark, sf_dir)
    arrived = listing.where((F.col("l_linenumber") == 1) & (F.col("extension") == ".png"))
    return I.siblings(listing, arrived).select("base_name", "object_key")


def page_siblings_sql() -> str:
    return f"""SELECT base_name, object_key FROM ({G.PARSED_SQL}) WHERE base_name IN (
      SELECT base_name FROM ({G.PARSED_SQL}) WHERE l_linenumber = 1 AND extension = '.png')"""


def page_siblings_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored objects that share a base name with an arriving page, every accepted object arriving."""
    listing = G._parsed(spark, sf_dir)
    return I.siblings(listing, I.accepted_pages(listing)).select("base_name", "object_key")


def page_siblings_all_sql() -> str:
    return f"""SELECT base_name, object_key FROM ({G.PARSED_SQL}) WHERE base_name IN (
      SELECT base_name FROM ({G.PARSED_SQL}) WHERE route = 'document' AND mime_ok)"""


def page_text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages paired with text keys by position, up to the shorter list (C4): a failed page has no text key."""
    j = B.state_jobs(spark, sf_dir)
    text = F.when(F.col("job_status") != "FAILED", K.text_page_key(F.col("document_id"), F.col("page_ordinal")))
    rows = j.groupBy("document_id").agg(F.array_sort(F.collect_list(
        F.struct("page_ordinal", "page_key", text.alias("t")))).alias("p"))
    m = rows.select("document_id", F.transform("p", lambda x: x["page_key"]).alias("pages"),
                    F.array_compact(F.transform("p", lambda x: x["t"])).alias("ocr_text_keys"))
    return pii.pair_pages_with_text_keys(m).select("document_id", F.col("page_no").cast("bigint").alias("page_no"),
                                                   "page_key", "text_key")


def page_text_pairs_sql() -> str:
    return f"""
    WITH j AS ({B.JOBS_SQL}),
    a AS (SELECT document_id, page_key, row_number() OVER (PARTITION BY document_id ORDER BY page_ordinal, page_key) AS i FROM j),
    b AS (SELECT document_id, 'staging/' || document_id || '/text_page_' || page_ordinal || '.txt' AS text_key,
                 row_number() OVER (PARTITION BY document_id ORDER BY page_ordinal, page_key) AS i
          FROM j WHERE job_status <> 'FAILED')
    SELECT a.document_id, CAST(a.i AS BIGINT) AS page_no, page_key, text_key FROM a JOIN b USING (document_id, i)"""


def text_key_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's text keys after its first page was read again: the key is not added twice."""
    j = B.state_jobs(spark, sf_dir).groupBy("document_id").agg(F.sort_array(F.collect_list("page_ordinal")).alias("o"))
    key = lambda n: K.text_page_key(F.col("document_id"), n)
    listed = j.withColumn("keys", F.transform("o", key))
    for page in (1, 1, 99):
        listed = listed.withColumn("keys", ST.append_if_absent(F.col("keys"), key(F.lit(page))))
    return listed.select("document_id", F.array_join("keys", ",").alias("text_keys"))


def text_key_lists_sql() -> str:
    key = "'staging/' || document_id || '/text_page_' || {} || '.txt'"
    return f"""
    WITH j AS ({B.JOBS_SQL}),
    k AS (SELECT document_id, page_ordinal, min(page_ordinal) AS o FROM j GROUP BY 1, 2),
    l AS (SELECT document_id, list({key.format('page_ordinal')} ORDER BY o) AS keys FROM k GROUP BY 1),
    m AS (SELECT document_id, CASE WHEN list_contains(keys, {key.format('1')}) THEN keys
                                   ELSE list_append(keys, {key.format('1')}) END AS keys FROM l)
    SELECT document_id, array_to_string(list_append(keys, {key.format('99')}), ',') AS text_keys FROM m"""
