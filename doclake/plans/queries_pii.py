"""Registered PII queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import pii
from doclake.plans import bindings as B
from doclake.plans.oracle_pii import detections_sql
from doclake.sources.tables import table


def pii_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection in every document, with offsets."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.explode_detections(pii.with_detections(docs), ["doc_id"])


def pii_detections_sql() -> str:
    return detections_sql("documents", "doc_id")


def pii_pages_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections in raw web pages (the same rules over `pages.html`)."""
    pages = table(spark, sf_dir, "pages", "page_id", "html").withColumnRenamed("html", "text")
    return pii.explode_detections(pii.with_detections(pages), ["page_id"])


def pii_pages_html_sql() -> str:
    return detections_sql("(SELECT page_id, html AS text FROM pages)", "page_id")


def pii_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document processing summary (D4, D5); conversation = document, turn = page."""
    pages = pii.with_detections(B.conversation_pages(spark, sf_dir))
    s = pii.result_record(pii.document_summary(pages, "document_id"), "document_id")
    return s.select(
        "document_id", "status", "detected_pii", "pii_result_key",
        F.col("total_pages").cast("bigint").alias("total_pages"),
        F.col("pages_with_pii").cast("bigint").alias("pages_with_pii"),
        F.col("total_pii_instances").cast("bigint").alias("total_pii_instances"),
        F.array_join("pii_types_detected", ",").alias("pii_types_detected"))


def pii_summary_sql() -> str:
    det = detections_sql(f"({B.CONVERSATION_PAGES_SQL})", "page_key")
    return f"""
    WITH p AS ({B.CONVERSATION_PAGES_SQL}),
         d AS ({det})
    SELECT p.document_id, 'PII_PROCESSED' AS status,
           count(d.page_key) > 0 AS detected_pii,
           'pii-results/' || p.document_id || '_pii_analysis.json' AS pii_result_key,
           CAST(count(DISTINCT p.page_key) AS BIGINT) AS total_pages,
           CAST(count(DISTINCT d.page_key) AS BIGINT) AS pages_with_pii,
           CAST(count(d.page_key) AS BIGINT) AS total_pii_instances,
           coalesce(array_to_string(list_sort(list_distinct(list(d.pii_type))), ','), '') AS pii_types_detected
    FROM p LEFT JOIN d ON p.page_key = d.page_key
    GROUP BY p.document_id"""
