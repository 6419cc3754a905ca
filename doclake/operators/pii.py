"""Personal-data operators over page and line tables.

Detection runs narrow (no shuffle) on the page-text table; only the small
``(keys, detections)`` rows travel across later exchanges, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from doclake.functions.pii import confidence_at_least, detections, line_numbers, masked

PII_STATUS = "PII_PROCESSED"


def with_detections(df: DataFrame, text_col: str = "text", out: str = "detections",
                    min_confidence: str | None = None) -> DataFrame:
    """Add ``out`` = array of detections found in ``text_col`` (narrow: one Arrow pass over the text)."""
    found = df.withColumn(out, detections(F.col(text_col)))
    if min_confidence:
        found = found.withColumn(out, F.filter(out, lambda d: confidence_at_least(d["confidence"], min_confidence)))
    return found


def explode_detections(df: DataFrame, keys: list[str], col: str = "detections") -> DataFrame:
    """One row per detection: keys, det_idx (reference order), type, text, offsets.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: the planner
    infers ``size(col) > 0`` for a plain explode and pushes it below the
    projection, which would run the whole detection twice.
    """
    return (df.select(*keys, F.posexplode_outer(col).alias("det_idx", "d"))
              .where(F.col("d").isNotNull())
              .select(*keys, F.col("det_idx").cast("bigint").alias("det_idx"),
                      F.col("d.type").alias("pii_type"), F.col("d.text").alias("pii_text"),
                      F.col("d.start_pos").cast("bigint").alias("start_pos"),
                      F.col("d.end_pos").cast("bigint").alias("end_pos"),
                      F.col("d.confidence").alias("confidence")))


def page_detection_counts(pages: DataFrame, doc_col: str, col: str = "detections") -> DataFrame:
    """Per page: number of detections and the distinct types (narrow)."""
    return pages.select(
        doc_col, F.size(col).alias("n_pii"),
        F.array_distinct(F.transform(col, lambda d: d["type"])).alias("types"))


def document_summary(pages: DataFrame, doc_col: str, col: str = "detections") -> DataFrame:
    """Processing summary per document from a page table holding detections.

    ``pages_with_pii`` counts pages with at least one detection. All parts are
    decomposable aggregates, so the map-side partial aggregation keeps a
    document with very many pages cheap to shuffle; the type set is bounded by
    the number of rule types.
    """
    per_page = page_detection_counts(pages, doc_col, col)
    return (per_page.groupBy(doc_col).agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.sum(F.when(F.col("n_pii") > 0, 1).otherwise(0)).alias("pages_with_pii"),
        F.sum("n_pii").alias("total_pii_instances"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("pii_types_detected"))
        .withColumn("detected_pii", F.col("total_pii_instances") > 0))


def result_record(summary: DataFrame, doc_col: str) -> DataFrame:
    """The per-document result fields and the result object key."""
    return (summary
            .withColumn("status", F.lit(PII_STATUS))
            .withColumn("pii_result_key", F.format_string("pii-results/%s_pii_analysis.json",
                                                          F.col(doc_col).cast("string")))
            .withColumn("pii_processing_complete", F.lit(True))
            .withColumn("pii_error", F.lit(None).cast("string")))


def result_json(pages: DataFrame, doc_col: str, page_col: str,
                col: str = "detections", redacted_col: str | None = None) -> DataFrame:
    """Per document: the result document as JSON text (the JSON result sink).

    Detections are concatenated in page order. This builds one value per
    document, so it is meant for the result sink of documents of bounded size;
    the exploded detection table stays the primary form.
    """
    agg = pages.groupBy(doc_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("p"), F.col(col).alias("d")))).alias("pp"),
        *([F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("p"), F.col(redacted_col).alias("k"))))
           .alias("rr")] if redacted_col else []))
    dets = F.flatten(F.transform("pp", lambda x: x["d"]))
    redacted = (F.filter(F.transform("rr", lambda x: x["k"]), lambda k: k.isNotNull())
                if redacted_col else F.filter(F.transform("pp", lambda x: F.lit(None).cast("string")),
                                              lambda k: k.isNotNull()))
    summary = F.struct(
        F.size("pp").alias("total_pages"),
        F.size(F.filter("pp", lambda x: F.size(x["d"]) > 0)).alias("pages_with_pii"),
        F.size(dets).alias("total_pii_instances"),
        F.array_sort(F.array_distinct(F.transform(dets, lambda d: d["type"]))).alias("pii_types_detected"))
    body = F.struct(F.lit(PII_STATUS).alias("status"), (F.size(dets) > 0).alias("detected_pii"),
                    redacted.alias("redacted_images"), dets.alias("pii_detections"),
                    summary.alias("processing_summary"))
    return agg.select(doc_col, F.to_json(body).alias("result_json"))


def pair_pages_with_text_keys(messages: DataFrame, doc_col: str = "document_id",
                              pages_col: str = "pages", keys_col: str = "ocr_text_keys") -> DataFrame:
    """Positional pairing of page keys with text keys, stopping at the shorter list."""
    n = F.least(F.size(pages_col), F.size(keys_col))
    zipped = F.arrays_zip(F.slice(pages_col, 1, n).alias("page_key"),
                          F.slice(keys_col, 1, n).alias("text_key"))
    return (messages.select(doc_col, F.posexplode(zipped).alias("i", "z"))
            .select(doc_col, (F.col("i") + 1).alias("page_no"), "z.page_key", "z.text_key"))


# ---------------------------------------------------------------- line boxes

def distinct_line_boxes(lines: DataFrame, keys: list[str], ord_col: str = "line_ord",
                        text_col: str = "text", box_col: str = "bbox") -> DataFrame:
    """Line text -> box within a page: the last box wins, the first position is kept."""
    return (lines.groupBy(*keys, text_col).agg(
        F.min(ord_col).alias("first_ord"),
        F.max_by(box_col, ord_col).alias(box_col)))


def map_to_boxes(detections: DataFrame, lines: DataFrame, page_text: DataFrame,
                 keys: list[str], ord_col: str = "line_ord", text_col: str = "text",
                 box_col: str = "bbox") -> DataFrame:
    """Box of every detection: a line equal to the detected text, else the first
    line containing it (case-insensitive); detections with neither are dropped.

    ``page_text`` holds (keys, text) where the text is the page's LINE texts
    joined by newlines in line order (the stored page text). A detection
    without a newline occurs inside a line exactly where it occurs in the page
    text, so the first containing line is the one holding its first
    occurrence. That turns the contains-lookup into equi-joins: no pairwise
    comparison of detections and lines within a page.
    """
    boxes = distinct_line_boxes(lines, keys, ord_col, text_col, box_col)
    det = detections.select(*keys, "det_idx", "pii_type", "pii_text", "confidence")
    exact = (det.join(boxes.withColumnRenamed(text_col, "pii_text"), [*keys, "pii_text"], "inner")
             .select(*keys, "det_idx", "pii_type", "pii_text", "confidence", box_col))
    rest = det.join(exact.select(*keys, "det_idx"), [*keys, "det_idx"], "left_anti")
    low = F.lower(F.col("page_text"))
    pos = F.instr(low, F.lower(F.col("pii_text")))
    located = (rest.join(page_text.withColumnRenamed(text_col, "page_text"), keys, "inner")
               .where(~F.col("pii_text").contains("\n") & (pos > 0))
               .select(*keys, "det_idx", "pii_type", "pii_text", "confidence",
                       (F.size(F.split(F.substring(F.col("page_text"), 1, pos - 1), "\n", -1)) - 1)
                       .alias("line_idx")))
    # line_idx counts lines in page order, 0-based; line_ord is that order
    ordered = lines.select(*keys, ord_col, text_col).withColumn(
        "line_idx", F.row_number().over(Window.partitionBy(*keys).orderBy(ord_col)) - 1)
    contained = (located.join(ordered, [*keys, "line_idx"], "inner")
                 .join(boxes, [*keys, text_col], "inner")
                 .select(*keys, "det_idx", "pii_type", "pii_text", "confidence", box_col))
    return exact.unionByName(contained)


def redaction_rect(box: Column, width: Column, height: Column, padding: int = 8) -> Column:
    """Pixel rectangle for a normalized box: truncate, pad, clamp to the page."""
    left = (box["Left"] * width).cast("int")
    top = (box["Top"] * height).cast("int")
    right = ((box["Left"] + box["Width"]) * width).cast("int")
    bottom = ((box["Top"] + box["Height"]) * height).cast("int")
    return F.struct(
        F.greatest(F.lit(0), left - padding).alias("left"),
        F.greatest(F.lit(0), top - padding).alias("top"),
        F.least(width, right + padding).alias("right"),
        F.least(height, bottom + padding).alias("bottom"))


def redacted_image_key(doc: Column, page_no: Column) -> Column:
    return F.format_string("results/%s_page_%d_redacted.jpg", doc.cast("string"), page_no)


# ------------------------------------------------------------------ masking

def with_masked_text(df: DataFrame, text_col: str = "text", det_col: str = "detections",
                     out: str = "masked_text", mask: str = "[REDACTED]") -> DataFrame:
    """Add ``out`` = the text with every detected span replaced by ``mask`` (narrow; spans and text share the row)."""
    return df.withColumn(out, masked(F.col(text_col), F.col(det_col), mask))


def boxes_in_page(df: DataFrame, lines_col: str = "lines", det_col: str = "detections",
                  out: str = "boxes") -> DataFrame:
    """Box mapping inside each page row, when the page's LINE blocks and its
    detections sit in the same row (one OCR response): narrow, no join, no
    shuffle. Same rule as ``map_to_boxes``: a line equal to the detected text
    (the last such line's box), else the first line containing it
    case-insensitively (the box of that text's last line); otherwise dropped.

    ``lines_col`` is ``array<struct<text, bbox>>`` in block order; lines are
    looked up by hash and position, not compared one by one.
    """
    numbers = line_numbers(F.transform(lines_col, lambda ln: ln["text"]), F.col(det_col))
    idx = F.transform(F.arrays_zip(F.col(det_col).alias("d"), F.col("_line").alias("k")), lambda x, i: F.struct(
        i.alias("det_idx"), F.struct(
            x["d"]["type"].alias("type"), x["d"]["text"].alias("text"), x["d"]["confidence"].alias("confidence"),
            F.get(F.col(lines_col), x["k"])["bbox"].alias("bbox")).alias("m")))
    return (df.withColumn("_line", numbers).withColumn(out, F.filter(idx, lambda x: x["m"]["bbox"].isNotNull()))
            .drop("_line"))
