"""Document-state operators: views, listing and paging, rollups, retention,
the change-log fold and change detection.

The state table is one row per document. Updates arrive as an append-only
change log ``(document_id, seq, ts, attr, value, set_null)``; ``fold_changes``
turns it into current rows with only decomposable aggregates, so a document
with very many updates is combined map-side.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from doclake.functions import keys as K
from doclake.functions import status as S
from doclake.operators.scan import Scan, plain, ranged, scanned, written


def status_view(docs: DataFrame) -> DataFrame:
    """The status columns plus progress, processing time and display date."""
    c = F.col
    return docs.select(
        "*",
        S.progress_percent(c("step_function_execution_arn"), c("has_textract_jobs"), c("ocr_all_complete"),
                           c("combined_key"), c("result_key"), c("status"), c("n_moved_files")).alias("progress"),
        S.processing_seconds(c("created_at"), c("updated_at")).alias("processing_time"),
        S.format_date(c("created_at")).alias("created_display"))


def _sort_key(sort_by: str):
    return F.coalesce(F.col(sort_by).cast("string"), F.lit(""))


def list_page(docs: DataFrame, status: str | None = None, sort_by: str = "created_at",
              descending: bool = True, limit: int = 50, after: tuple | None = None) -> DataFrame:
    """Filter -> sort -> limit over the whole table (missing sort values sort as '').

    ``after`` is a continuation key (sort value, document_id) from
    ``continuation_key``; the page starts right after it. The plan is a
    filtered scan feeding TakeOrderedAndProject (a per-task top-k, then a
    merge), so no full sort of the table.
    """
    d = docs if status is None else docs.where(F.col("status") == status)
    key = _sort_key(sort_by)
    if after is not None:
        v, i = after
        later = (key < F.lit(v)) if descending else (key > F.lit(v))
        d = d.where(later | ((key == F.lit(v)) & (F.col("document_id") > F.lit(i))))
    return d.orderBy(key.desc() if descending else key.asc(), F.col("document_id").asc()).limit(limit)


def continuation_key(page: DataFrame, sort_by: str = "created_at", descending: bool = True) -> tuple | None:
    """(sort value, document_id) of the last row of a page: one row to the client."""
    key = _sort_key(sort_by)
    last = (page.select(key.alias("k"), "document_id")
            .orderBy(F.col("k").asc() if descending else F.col("k").desc(), F.col("document_id").desc())
            .take(1))
    return (last[0]["k"], last[0]["document_id"]) if last else None


def newest_per_status(docs: DataFrame, k: int = 3, time_col: str = "created_at") -> DataFrame:
    """Top-k newest per status. The ``rank <= k`` filter over row_number lets the
    planner insert a per-task group limit before the shuffle, so a status holding
    most rows still ships only k rows per task."""
    w = Window.partitionBy("status").orderBy(F.col(time_col).desc(), F.col("document_id").asc())
    return docs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def files_view(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Files view: original, moved and text files of each document as lists in page order, joined by ','
    ('' where there are none), and the single keys. One row per document by the view's definition."""
    key, doc = F.col("page_key"), F.col("document_id")
    row = F.struct("page_ordinal", "page_key", K.complete_key(key, doc).alias("moved"), F.when(
        F.col("job_status").isin(*S.OCR_DONE), K.text_page_key(doc, F.col("page_ordinal"))).alias("text"))
    lists = pages.groupBy("document_id").agg(F.array_sort(F.collect_list(row)).alias("_p"))

    def joined(field):  # array_join leaves nulls out
        return F.coalesce(F.array_join(F.transform("_p", lambda x: x[field]), ","), F.lit(""))
    return docs.join(lists, "document_id", "left").select(
        "document_id", joined("page_key").alias("original_files"),
        F.when(F.col("status") == "COMPLETE", joined("moved")).otherwise(F.lit("")).alias("moved_files"),
        joined("text").alias("ocr_text_files"), F.col("combined_key").alias("combined_text_file"),
        F.col("result_key").alias("result_file"))


def status_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n_documents"))


def failure_rates(docs: DataFrame, unit: str = "day", time_col: str = "created_at") -> DataFrame:
    """Runs, failures and failure rate per time period."""
    failed = F.col("status") == "FAILED"
    return (docs.groupBy(F.date_format(F.date_trunc(unit, F.col(time_col)), "yyyy-MM-dd").alias("period"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_runs"),
                 F.count_if(failed).cast("bigint").alias("n_failed"))
            .withColumn("failure_rate", F.round(F.col("n_failed") / F.col("n_runs"), 6)))


def all_pages_complete(pages: DataFrame, jobs: DataFrame) -> DataFrame:
    """Completion gate: every page of the document has a finished OCR job."""
    done = jobs.where(F.col("job_status").isin(*S.OCR_DONE)).select("document_id", "page_key").distinct()
    marked = pages.select("document_id", "page_key").distinct().join(
        done.withColumn("_done", F.lit(1)), ["document_id", "page_key"], "left")
    return marked.groupBy("document_id").agg(
        (F.count(F.lit(1)) == F.count("_done")).alias("all_pages_complete"))


def unexpired(docs: DataFrame, as_of: str, ttl_col: str = "ttl") -> DataFrame:
    """Rows not yet expired at ``as_of`` (epoch-seconds ttl; null never expires)."""
    now = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    return docs.where(F.col(ttl_col).isNull() | (F.col(ttl_col) > now))


def lookup_by(docs: DataFrame, wanted: DataFrame, col: str) -> DataFrame:
    """Batch point lookup: records whose ``col`` is in ``wanted`` (semi join)."""
    return docs.join(wanted.select(col).distinct(), col, "left_semi")


# ------------------------------------------------------------- change log

def fold_changes(changes: DataFrame, attrs: list[str], key: str = "document_id") -> DataFrame:
    """Current value of every attribute: the latest write by (ts, seq).

    A write with ``set_null`` stores an explicit null (it wins over older
    values); rows with a null value and no flag are ignored. Also returns the
    last change time as ``updated_at``.
    """
    order = F.struct("ts", "seq")
    valid = F.col("value").isNotNull() | F.coalesce(F.col("set_null"), F.lit(False))
    aggs = [F.max_by(F.when(F.col("attr") == a, F.col("value")),
                     F.when((F.col("attr") == a) & valid, order)).alias(a) for a in attrs]
    return changes.groupBy(key).agg(*aggs, F.max("ts").alias("updated_at"))


def _folded(changes: DataFrame, attrs: list[str], key: str) -> DataFrame:
    """Per key and attribute the latest write with its place: ``attr`` is struct<ts, seq, value> (null: never written)."""
    valid = F.col("value").isNotNull() | F.coalesce(F.col("set_null"), F.lit(False))
    write = F.struct("ts", "seq", "value")
    return changes.groupBy(key).agg(*[F.max(F.when((F.col("attr") == a) & valid, write)).alias(a) for a in attrs],
                                    F.max("ts").alias("updated_at"))


def upsert_state(delta: DataFrame, path: str, attrs: list[str], batch_id: int, key: str = "document_id",
                 buckets: int = 256) -> bool:
    """Fold a batch of change rows into the state table at ``path``; False if the batch was applied before.

    The table is partitioned into hash buckets of the key. Only the buckets that the batch touches are read, merged
    and replaced (dynamic partition overwrite), so a run costs its delta and those buckets, not the whole log. A
    finished batch leaves its id behind as a fence; one that was lost half-way is simply applied again, since the
    latest write of an attribute stays the latest.
    """
    spark = delta.sparkSession
    try:
        if spark.read.parquet(f"{path}_applied").where(F.col("batch_id") == batch_id).limit(1).count():
            return False
    except AnalysisException:  # nothing was applied yet
        pass
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    new = written(_folded(delta, attrs, key).select("*", bucket), "delta")
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    both = new
    try:
        both = new.unionByName(spark.read.schema(new.schema).parquet(path).where(F.col("bucket").isin(touched)))
    except AnalysisException:  # the table does not exist yet
        pass
    merged = both.groupBy("bucket", key).agg(*[F.max(a).alias(a) for a in attrs], F.max("updated_at").alias("updated_at"))
    ready = written(merged.repartition("bucket"), "merged")  # a table can't be replaced while it is read
    ready.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "bucket").parquet(path)
    spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("append").parquet(f"{path}_applied")
    return True


def read_state(spark: SparkSession, path: str, attrs: list[str], key: str = "document_id") -> DataFrame:
    """The state table of ``upsert_state``: one row per key with its current values."""
    return spark.read.parquet(path).select(key, *[F.col(a)["value"].alias(a) for a in attrs], "updated_at")


def change_flags(polls: DataFrame, value_col: str, key: str = "document_id",
                 time_col: str = "ts", seq_col: str = "seq") -> DataFrame:
    """``changed`` = the polled value differs (null-safe) from the previous poll
    of the same document; the first poll counts as a change."""
    previous = Scan("_prev", "last", F.struct(F.col(value_col).alias("v")), before=True)
    lagged = scanned(ranged(polls, [key], [time_col, seq_col]), [key], [previous])
    return plain(lagged).withColumn("changed", F.col("_prev").isNull() | ~F.col(value_col).eqNullSafe(F.col("_prev.v"))).drop(
        "_prev")


def by_filename_prefix(docs: DataFrame, prefix: str, col: str = "original_filename") -> DataFrame:
    """Documents whose file name starts with ``prefix`` (a range-friendly filter
    the scan can prune with row-group statistics)."""
    return docs.where(F.col(col).startswith(prefix))


def append_if_absent(arr, value):
    """List append that keeps a single copy (re-running a page is idempotent)."""
    return F.array_union(F.coalesce(arr, F.array().cast("array<string>")), F.array(value))
