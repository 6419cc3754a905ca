"""Registered page-text queries (CONV, LINES bindings): page texts, combined
text, the page-text sink, line boxes of detections and masked text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import pages as PG
from doclake.operators import pii
from doclake.operators.scan import positions
from doclake.plans import bindings as B
from doclake.plans.oracle_pii import detections_sql

MASK = "[REDACTED]"


def _conv_pages(spark, sf_dir):
    p = B.conversation_pages(spark, sf_dir)
    return positions(p, ["document_id"], [F.col("page_no").asc_nulls_last(), "page_key"], "page_ordinal")


_CONV_ORD_SQL = f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page_no, page_key) AS BIGINT) AS page_ordinal
    FROM ({B.CONVERSATION_PAGES_SQL})"""


def page_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page text rebuilt from the LINE blocks of stored OCR responses."""
    t = PG.page_text_from_blocks(B.ocr_responses(spark, sf_dir), ["doc_id"])
    return t.select("doc_id", "n_lines", F.length("text").cast("bigint").alias("n_chars"),
                    F.md5("text").alias("text_md5"))


def page_text_lines_sql() -> str:
    return """
    SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines,
           CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, md5(coalesce(text, '')) AS text_md5
    FROM documents"""


def page_text_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same text from the exploded line table, regrouped per page in line order."""
    lines = PG.lines_from_blocks(B.ocr_responses(spark, sf_dir), ["doc_id"])
    t = PG.page_text(lines, ["doc_id"])
    return t.select("doc_id", "n_lines", F.md5("text").alias("text_md5"))


def page_text_grouped_sql() -> str:
    return """
    SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines,
           md5(coalesce(text, '')) AS text_md5 FROM documents"""


def page_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-text sink rows: ordinal, staging key and 100-character preview."""
    s = PG.page_text_sink(_conv_pages(spark, sf_dir))
    return s.select("document_id", "page_no", "page_ordinal", "text_key", "preview")


def page_text_sink_sql() -> str:
    return f"""
    SELECT document_id, page_no, page_ordinal,
           'staging/' || document_id || '/text_page_' || CAST(page_ordinal AS VARCHAR) || '.txt' AS text_key,
           substr(text, 1, 100) AS preview
    FROM ({_CONV_ORD_SQL})"""


def combined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined text per document with page headers, in page order."""
    c = PG.combined_text(_conv_pages(spark, sf_dir))
    return c.select("document_id", "combined_key", "n_pages",
                    F.length("combined_text").cast("bigint").alias("n_chars"),
                    F.md5("combined_text").alias("text_md5"))


def combined_text_sql() -> str:
    return f"""
    SELECT document_id, 'staging/' || document_id || '/combined.txt' AS combined_key,
           n_pages, CAST(length(ct) AS BIGINT) AS n_chars, md5(ct) AS text_md5
    FROM (SELECT document_id, CAST(count(*) AS BIGINT) AS n_pages,
                 string_agg('--- Page ' || CAST(page_ordinal AS VARCHAR) || ' ---' || chr(10) || coalesce(text, '')
                            || chr(10) || chr(10), '' ORDER BY page_ordinal) AS ct
          FROM ({_CONV_ORD_SQL}) GROUP BY document_id)"""


def combined_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte range of every page in its document's combined text, whatever the document's size."""
    return PG.combined_layout(_conv_pages(spark, sf_dir)).select(
        "document_id", "page_ordinal", "combined_key", "part_md5", "byte_from", "byte_to")


def combined_offsets_sql() -> str:
    return f"""
    SELECT document_id, page_ordinal, 'staging/' || document_id || '/combined.txt' AS combined_key, md5(part) AS part_md5,
           CAST(sum(strlen(part)) OVER w - strlen(part) AS BIGINT) AS byte_from, CAST(sum(strlen(part)) OVER w AS BIGINT) AS byte_to
    FROM (SELECT document_id, page_ordinal, '--- Page ' || CAST(page_ordinal AS VARCHAR) || ' ---' || chr(10) || coalesce(text, '')
                 || chr(10) || chr(10) AS part FROM ({_CONV_ORD_SQL}))
    WINDOW w AS (PARTITION BY document_id ORDER BY page_ordinal ROWS UNBOUNDED PRECEDING)"""


def pii_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections mapped to line boxes and padded pixel rectangles.

    Lines, page text and detections all come from the same response row, so
    the mapping runs inside the row (``boxes_in_page``): no join, no shuffle."""
    resp = B.ocr_responses(spark, sf_dir)
    line_blocks = F.filter("Blocks", lambda b: b["BlockType"] == PG.LINE_BLOCK)
    pages = resp.select("doc_id", F.transform(line_blocks, lambda b: F.struct(
        b["Text"].alias("text"), b["Geometry"]["BoundingBox"].alias("bbox"))).alias("lines"),
        F.array_join(F.transform(line_blocks, lambda b: b["Text"]), "\n").alias("text"))
    det = pii.with_detections(pages)
    # explode_outer + null filter: a plain explode's inferred size() filter
    # would be pushed below and run the detection twice
    boxed = (pii.boxes_in_page(det).select("doc_id", F.explode_outer("boxes").alias("b"))
             .where(F.col("b").isNotNull()))
    r = pii.redaction_rect(F.col("b.m.bbox"), F.lit(B.IMG_W), F.lit(B.IMG_H))
    return boxed.select("doc_id", F.col("b.det_idx").cast("bigint").alias("det_idx"),
                        F.col("b.m.type").alias("pii_type"), F.col("b.m.text").alias("pii_text"),
                        r["left"].alias("left"), r["top"].alias("top"),
                        r["right"].alias("right"), r["bottom"].alias("bottom"))


def pii_boxes_sql() -> str:
    def px(x):
        return f"CAST(trunc({x}) AS INTEGER)"
    left, top = "0.0625", "((box_ord - 1) % 64) / 64.0"
    width, height = "least(length(box_text), 60) / 64.0", f"{1 / 64!r}"
    return f"""
    WITH det AS ({detections_sql('documents', 'doc_id')}),
    lines AS ({B.LINES_SQL}),
    boxes AS (SELECT doc_id, text, min(line_ord) AS first_ord, max(line_ord) AS box_ord FROM lines GROUP BY 1, 2),
    exact AS (SELECT d.doc_id, d.det_idx, d.pii_type, d.pii_text, b.box_ord
              FROM det d JOIN boxes b ON b.doc_id = d.doc_id AND b.text = d.pii_text),
    cont AS (SELECT d.doc_id, d.det_idx, d.pii_type, d.pii_text, arg_min(b.box_ord, b.first_ord) AS box_ord
             FROM det d JOIN boxes b ON b.doc_id = d.doc_id AND contains(lower(b.text), lower(d.pii_text))
             WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.doc_id = d.doc_id AND e.det_idx = d.det_idx)
             GROUP BY 1, 2, 3, 4),
    m AS (SELECT x.*, l.text AS box_text FROM (SELECT * FROM exact UNION ALL SELECT * FROM cont) x
          JOIN lines l ON l.doc_id = x.doc_id AND l.line_ord = x.box_ord)
    SELECT doc_id, det_idx, pii_type, pii_text,
           greatest(0, {px(f'{left} * 1024')} - 8) AS "left",
           greatest(0, {px(f'{top} * 1024')} - 8) AS top,
           least(1024, {px(f'({left} + {width}) * 1024')} + 8) AS "right",
           least(1024, {px(f'({top} + {height}) * 1024')} + 8) AS bottom
    FROM m"""


def pii_boxes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box mapping from separate tables of lines, page texts and detections (C5, E7, H12, join form)."""
    resp = B.ocr_responses(spark, sf_dir)
    lines = PG.lines_from_blocks(resp, ["doc_id"])
    text = PG.page_text_from_blocks(resp, ["doc_id"]).select("doc_id", "text")
    det = pii.explode_detections(pii.with_detections(text), ["doc_id"])
    boxed = pii.map_to_boxes(det, lines, text, ["doc_id"])
    r = pii.redaction_rect(F.col("bbox"), F.lit(B.IMG_W), F.lit(B.IMG_H))
    return boxed.select("doc_id", "det_idx", "pii_type", "pii_text", r["left"].alias("left"), r["top"].alias("top"),
                        r["right"].alias("right"), r["bottom"].alias("bottom"))


def masked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every detected span replaced by a mask."""
    docs = pii.with_detections(B.table(spark, sf_dir, "documents", "doc_id", "text"))
    m = pii.with_masked_text(docs, mask=MASK)
    return m.select("doc_id", F.size("detections").cast("bigint").alias("n_spans"),
                    F.length("masked_text").cast("bigint").alias("n_chars"), F.md5("masked_text").alias("text_md5"))


def masked_text_sql() -> str:
    return f"""
    WITH det AS ({detections_sql('documents', 'doc_id')}),
    s AS (SELECT doc_id, start_pos AS a, end_pos AS b,
                 max(end_pos) OVER (PARTITION BY doc_id ORDER BY start_pos, end_pos
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmax,
                 row_number() OVER (PARTITION BY doc_id ORDER BY start_pos, end_pos) AS rn
          FROM det),
    g AS (SELECT *, sum(CASE WHEN pmax IS NULL OR a >= pmax THEN 1 ELSE 0 END)
                    OVER (PARTITION BY doc_id ORDER BY rn) AS island FROM s),
    isl AS (SELECT doc_id, island, min(a) AS s, max(b) AS e FROM g GROUP BY 1, 2),
    isl2 AS (SELECT *, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY island
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pe FROM isl),
    d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    pieces AS (SELECT i.doc_id, string_agg(substr(d.text, i.pe + 1, i.s - i.pe) || '{MASK}', '' ORDER BY i.island) AS body,
                      max(i.e) AS last_e
               FROM isl2 i JOIN d USING (doc_id) GROUP BY i.doc_id),
    cnt AS (SELECT doc_id, count(*) AS n FROM det GROUP BY 1),
    out AS (SELECT d.doc_id, CASE WHEN p.doc_id IS NULL THEN d.text
                                  ELSE p.body || substr(d.text, p.last_e + 1) END AS masked,
                   coalesce(c.n, 0) AS n_spans
            FROM d LEFT JOIN pieces p USING (doc_id) LEFT JOIN cnt c USING (doc_id))
    SELECT doc_id, CAST(n_spans AS BIGINT) AS n_spans, CAST(length(masked) AS BIGINT) AS n_chars,
           md5(masked) AS text_md5 FROM out"""
