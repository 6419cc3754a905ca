"""Ingest operators: from an object manifest to document records and the
page table.

The manifest is ``(object_key, content_type, event_time, bucket)``, one row
per stored object (from a listing, a ``binaryFile`` scan or decoded events).
The page table ``(document_id, object_key, page_no, page_ordinal)`` is the
primary representation of a document's pages; the array form of the record
is built only on request (``pages_array``) because it puts a whole document
in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.functions import keys as K
from doclake.operators.scan import positions

INITIAL_STATUS = "OCR_RUNNING"


def parse_keys(manifest: DataFrame, key_col: str = "object_key") -> DataFrame:
    """Add base name, page number, extension, route and the MIME verdict (narrow)."""
    k = F.col(key_col)
    name = K.basename(k)
    return (manifest
            .withColumn("file_name", name)
            .withColumn("base_name", K.base_name(k))
            .withColumn("page_no", K.page_number(k))
            .withColumn("extension", K.extension(name))
            .withColumn("route", K.route(k))
            .withColumn("mime_ok", K.mime_supported(F.col("content_type"))))


def accepted_pages(parsed: DataFrame) -> DataFrame:
    """Objects routed to documents whose MIME type is supported."""
    return parsed.where((F.col("route") == "document") & F.col("mime_ok"))


def rejected_objects(parsed: DataFrame) -> DataFrame:
    """Routed objects the MIME check turns away, with a reason (reported, not lost)."""
    return (parsed.where(F.col("route").isNotNull() & ~((F.col("route") == "archive") | F.col("mime_ok")))
            .withColumn("error_reason", F.concat(F.lit("unsupported content type: "),
                                                 F.coalesce(F.col("content_type"), F.lit("none")))))


def skip_existing(pages: DataFrame, documents: DataFrame, base_col: str = "base_name") -> DataFrame:
    """Drop pages whose base name already has a document (left anti join).

    ``documents`` needs ``original_filename``; only that column is read.
    """
    existing = documents.select(F.col("original_filename").alias(base_col)).distinct()
    return pages.join(existing, base_col, "left_anti")


def siblings(listing: DataFrame, triggers: DataFrame, base_col: str = "base_name") -> DataFrame:
    """All listed objects sharing a base name with a triggering object."""
    return listing.join(triggers.select(base_col).distinct(), base_col, "left_semi")


def _pages(pages: DataFrame, bucket_col: str) -> DataFrame:
    return pages.select(bucket_col, "base_name", "object_key", "page_no",
                        K.document_id_for(F.col(bucket_col), F.col("base_name")).alias("document_id"))


def distinct_pages(pages: DataFrame, bucket_col: str = "bucket") -> DataFrame:
    """One row per distinct page object with its document id (no ordering)."""
    return _pages(pages, bucket_col).distinct()


def page_table(pages: DataFrame, bucket_col: str = "bucket", order: str = "numeric") -> DataFrame:
    """One row per distinct page object with its document id and ordinal.

    ``order='numeric'`` sorts by the page number in the name (then the key);
    ``'lexical'`` sorts by key text, as a plain string sort does. Either way a
    document's pages spread over range partitions of that order.
    """
    by = [F.col("page_no").asc_nulls_last(), "object_key"] if order == "numeric" else ["object_key"]
    return positions(distinct_pages(pages, bucket_col), ["document_id"], by, "page_ordinal")


def document_records(pages: DataFrame, bucket_col: str = "bucket",
                     created_col: str = "event_time") -> DataFrame:
    """One new document record per base name (status OCR_RUNNING).

    Only decomposable aggregates, so a base name with very many pages is
    combined map-side before the shuffle.
    """
    g = (pages.groupBy(bucket_col, "base_name").agg(
        F.count_distinct("object_key").alias("pages_received"),
        F.max(created_col).alias("created_at"),
        F.min("page_no").alias("first_page_no"),
        F.max("page_no").alias("last_page_no")))
    return (g.withColumn("document_id", K.document_id_for(F.col(bucket_col), F.col("base_name")))
            .select("document_id", F.lit(INITIAL_STATUS).alias("status"),
                    F.col("base_name").alias("original_filename"),
                    F.col(bucket_col).alias("bucket_name"),
                    F.col("pages_received").cast("bigint").alias("pages_received"),
                    "first_page_no", "last_page_no",
                    ocr_mode(F.col("pages_received")).alias("ocr_mode"),
                    F.col("created_at"), F.col("created_at").alias("updated_at")))


def ocr_mode(n_pages) -> F.Column:
    """One page is read synchronously, more pages asynchronously."""
    return F.when(n_pages == 1, F.lit("SYNC")).otherwise(F.lit("ASYNC"))


def pages_array(page_tbl: DataFrame) -> DataFrame:
    """The record's ``pages`` list (keys in ordinal order) for bounded documents."""
    return (page_tbl.groupBy("document_id")
            .agg(F.sort_array(F.collect_list(F.struct("page_ordinal", "object_key"))).alias("_p"))
            .select("document_id", F.transform("_p", lambda x: x["object_key"]).alias("pages")))


def file_moves(page_tbl: DataFrame) -> DataFrame:
    """(old_key, new_key) for moving a finished document's pages to complete/."""
    return page_tbl.select("document_id", F.col("object_key").alias("old_key"),
                           K.complete_key(F.col("object_key"), F.col("document_id")).alias("new_key"))


def folder_counts_after_run(parsed: DataFrame, accepted_flag: str = "accepted") -> DataFrame:
    """Objects per top folder after a run, from the parsed manifest in one pass:
    accepted pages move to complete/ and get a page text in staging/, each new
    document one result in results/, archives go to archive/, the rest stays
    in incoming/."""
    acc = F.col(accepted_flag)
    arch = F.coalesce(F.col("route") == "archive", F.lit(False))
    doc = F.when(acc, F.concat_ws("|", F.col("bucket"), F.col("base_name")))
    c = parsed.agg(
        F.count_distinct(F.when(acc, F.col("object_key"))).alias("complete"),
        F.count_distinct(doc).alias("results"),
        F.count_if(arch & ~acc).alias("archive"),
        F.count_if(~arch & ~acc).alias("incoming"))
    return c.select(F.expr("stack(5, 'complete', complete, 'staging', complete, 'results', results, "
                           "'archive', archive, 'incoming', incoming) AS (folder, n_objects)")) \
            .where(F.col("n_objects") > 0)
