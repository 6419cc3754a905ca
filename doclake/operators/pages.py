"""Page-text operators: OCR blocks -> lines -> page text -> combined text.

A page's text is one value, so it is assembled per page (bounded by what one
page image holds). The combined document text is offered in two forms: the
exploded parts (one row per page, streamable to any writer) and the single
string, built only where a consumer needs the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.functions import keys as K
from doclake.operators.scan import Scan, plain, ranged, scanned

# ---------------------------------------------------------------------------
# Fixed values of the text formats.
LINE_BLOCK = "LINE"
PAGE_HEADER = "--- Page %d ---\n"
PAGE_TRAILER = "\n\n"
PREVIEW_CHARS = 100
# ---------------------------------------------------------------------------

BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("Left", "Top", "Width", "Height")])
BLOCK = T.StructType([
    T.StructField("BlockType", T.StringType()),
    T.StructField("Text", T.StringType()),
    T.StructField("Geometry", T.StructType([T.StructField("BoundingBox", BOX)])),
])
OCR_RESPONSE = T.StructType([T.StructField("Blocks", T.ArrayType(BLOCK))])


def lines_from_blocks(responses: DataFrame, keys: list[str], blocks_col: str = "Blocks") -> DataFrame:
    """LINE blocks of stored OCR responses as rows (keys, line_ord, text, bbox);
    ``line_ord`` is the block's position in the response."""
    return (responses.select(*keys, F.posexplode(blocks_col).alias("block_idx", "b"))
            .where(F.col("b.BlockType") == LINE_BLOCK)
            .select(*keys, F.col("block_idx").cast("bigint").alias("line_ord"),
                    F.col("b.Text").alias("text"), F.col("b.Geometry.BoundingBox").alias("bbox")))


def page_text_from_blocks(responses: DataFrame, keys: list[str], blocks_col: str = "Blocks") -> DataFrame:
    """Page text straight from each response row: LINE texts in block order,
    newline-joined ('' when the page has no LINE block). Narrow: no shuffle."""
    lines = F.filter(blocks_col, lambda b: b["BlockType"] == LINE_BLOCK)
    return responses.select(*keys, F.array_join(F.transform(lines, lambda b: b["Text"]), "\n").alias("text"),
                            F.size(lines).cast("bigint").alias("n_lines"))


def page_text_from_parts(responses: DataFrame, keys: list[str], part_col: str = "part_no",
                         blocks_col: str = "Blocks") -> DataFrame:
    """Page text of paginated OCR results: the parts of a page (rows with equal ``keys``) in the order of
    ``part_col``, lines in block order. Each part becomes its text first, so one short row per part is grouped."""
    parts = page_text_from_blocks(responses, [*keys, part_col], blocks_col)
    return (parts.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(part_col).alias("o"), F.col("n_lines").alias("n"),
                                                      F.col("text").alias("t")))).alias("_p"))
            .select(*keys, F.array_join(F.transform(F.filter("_p", lambda x: x["n"] > 0), lambda x: x["t"]), "\n")
                    .alias("text"), F.aggregate("_p", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("n_lines")))


def page_text(lines: DataFrame, keys: list[str], ord_col: str = "line_ord") -> DataFrame:
    """Page text from a line table (lines of one page can come from several rows)."""
    return (lines.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col("text").alias("t"))))
                 .alias("_l"))
            .select(*keys, F.array_join(F.transform("_l", lambda x: x["t"]), "\n").alias("text"),
                    F.size("_l").cast("bigint").alias("n_lines")))


def page_text_sink(pages: DataFrame, doc_col: str = "document_id", ordinal_col: str = "page_ordinal") -> DataFrame:
    """Rows for the page-text sink: staging key per page ordinal and a preview."""
    return pages.withColumn("text_key", K.text_page_key(F.col(doc_col), F.col(ordinal_col))) \
                .withColumn("preview", F.substring(F.col("text"), 1, PREVIEW_CHARS))


def combined_parts(pages: DataFrame, ordinal_col: str = "page_ordinal") -> DataFrame:
    """Each page's piece of the combined text (header, text, blank line)."""
    return pages.withColumn("part", F.concat(F.format_string(PAGE_HEADER, F.col(ordinal_col)),
                                             F.coalesce(F.col("text"), F.lit("")), F.lit(PAGE_TRAILER)))


def combined_text(pages: DataFrame, doc_col: str = "document_id", ordinal_col: str = "page_ordinal") -> DataFrame:
    """One combined text per document, pages in ordinal order (sorted explicitly:
    list order after a shuffle is not defined)."""
    parts = combined_parts(pages, ordinal_col)
    return (parts.groupBy(doc_col)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(ordinal_col).alias("o"), F.col("part").alias("p"))))
                 .alias("_p"))
            .select(doc_col, F.array_join(F.transform("_p", lambda x: x["p"]), "").alias("combined_text"),
                    F.size("_p").cast("bigint").alias("n_pages"),
                    K.combined_key(F.col(doc_col)).alias("combined_key")))


def combined_layout(pages: DataFrame, doc_col: str = "document_id", ordinal_col: str = "page_ordinal") -> DataFrame:
    """Where each page's part stands in its document's combined text: ``combined_key, byte_from, byte_to``.

    Byte offsets are prefix sums over the parts' lengths (a segmented scan on narrow rows), so a document of any size
    is laid out without being in one row; pages with an equal ordinal are in order of their texts' digests.
    """
    part = combined_parts(pages, ordinal_col)
    sizes = part.select(doc_col, ordinal_col, F.md5("part").alias("part_md5"),
                        F.octet_length("part").cast("long").alias("n_bytes"))
    ends = scanned(ranged(sizes, [doc_col], [ordinal_col, "part_md5"]), [doc_col], [Scan("byte_to", "sum", F.col("n_bytes"))])
    return plain(ends).select(doc_col, ordinal_col, K.combined_key(F.col(doc_col)).alias("combined_key"), "part_md5",
                              (F.col("byte_to") - F.col("n_bytes")).alias("byte_from"), "byte_to")


def write_combined(pages: DataFrame, path: str, doc_col: str = "document_id", ordinal_col: str = "page_ordinal") -> DataFrame:
    """Write every document's combined text as parts in order with their byte range, and return the written table.

    The files are range-partitioned and sorted by (document, page), so their statistics are the offset index: a page,
    a byte range or a document is read from the few files that can hold it. Joining a document's parts in byte order
    gives ``combined_text``.
    """
    part = combined_parts(pages, ordinal_col).select(doc_col, ordinal_col, "part", F.octet_length("part").cast("long").alias("n_bytes"))
    rows = ranged(part, [doc_col], [ordinal_col, F.md5("part")])
    laid = plain(scanned(rows, [doc_col], [Scan("byte_to", "sum", F.col("n_bytes"))])).select(
        doc_col, ordinal_col, (F.col("byte_to") - F.col("n_bytes")).alias("byte_from"), "byte_to", "part")
    by = [doc_col, "byte_from"]
    laid.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.schema(laid.schema).parquet(path)


def read_combined(parts: DataFrame, document_id: str, byte_from: int = 0, byte_to: int | None = None,
                  doc_col: str = "document_id") -> DataFrame:
    """The parts of one document that a byte range touches, in order (the filters reach the files' statistics)."""
    wanted = parts.where((F.col(doc_col) == document_id) & (F.col("byte_to") > byte_from))
    if byte_to is not None:
        wanted = wanted.where(F.col("byte_from") < byte_to)
    return wanted.orderBy("byte_from")
