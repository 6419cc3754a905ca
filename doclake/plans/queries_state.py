"""Registered read-side queries over the document state table (STATE, ERR,
HIST bindings): views, listing, timelines, summaries, rollups and history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import status as S
from doclake.operators import clustered as CL
from doclake.operators import state as ST
from doclake.operators import timeline as TL
from doclake.plans import bindings as B
from doclake.session import checkpoint_path

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DTS = "'%Y-%m-%d %H:%M:%S'"


# ----------------------------------------------------------------- SQL helpers

def _truthy(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR) <> '', false)"


def _categorize(x: str, form: str = "api") -> str:
    rules = S.ERROR_RULES if form != "guide" else [r for r in S.ERROR_RULES if r[0] != "timeout"]
    whens = " ".join(f"WHEN contains({x}, '{n}') THEN '{c}'" for n, c in rules)
    other = x if form == "text" else f"'{S.UNKNOWN_ERROR}'"
    return f"CASE {whens} ELSE {other} END"


def _ocr_details(form: str) -> str:
    so = ("'Synchronous processing: ' || CAST(ocr_n_sync AS VARCHAR) || ' page(s)'" if form == "api"
          else "'Synchronous method'")
    ao = ("'Asynchronous processing: ' || CAST(ocr_n_async AS VARCHAR) || ' page(s)'" if form == "api"
          else "'Asynchronous method'")
    return (f"CASE WHEN ocr_n_sync > 0 AND ocr_n_async > 0 THEN 'Mixed processing: ' || CAST(ocr_n_sync AS VARCHAR)"
            f" || ' synchronous, ' || CAST(ocr_n_async AS VARCHAR) || ' asynchronous'"
            f" WHEN ocr_n_sync > 0 THEN {so} WHEN ocr_n_async > 0 THEN {ao} ELSE 'OCR processing' END")


_OCR_STATUS = "CASE WHEN ocr_has_failures THEN 'failed' WHEN ocr_all_complete THEN 'completed' ELSE 'in_progress' END"
_LLM_STATUS = "CASE WHEN status = 'COMPLETE' THEN 'completed' WHEN status = 'FAILED' THEN 'failed' ELSE 'in_progress' END"
_LLM_DETAILS = (f"CASE WHEN {_truthy('document_type')} THEN 'Classified as: ' || document_type "
                "ELSE 'Classification in progress' END")


def _fmt(x: str) -> str:
    return f"coalesce(strftime({x}, {DTS}), '{S.UNKNOWN_DATE}')"


DOCS_SQL = f"""
    WITH d AS ({B.STATE_DOCS_SQL}),
    j AS ({B.JOBS_SQL}),
    r AS (SELECT document_id, bool_or(job_status = 'FAILED') AS ocr_has_failures,
                 bool_and(job_status IN ('SYNC_COMPLETE', 'ASYNC_COMPLETE')) AS ocr_all_complete,
                 CAST(count(*) FILTER (WHERE job_status = 'SYNC_COMPLETE') AS INT) AS ocr_n_sync,
                 CAST(count(*) FILTER (WHERE job_status IN ('ASYNC_STARTED', 'ASYNC_COMPLETE')) AS INT) AS ocr_n_async,
                 arg_min(job_status, (page_ordinal, page_key)) AS ocr_first_status
          FROM j GROUP BY document_id)
    SELECT d.*, coalesce(r.ocr_has_failures, false) AS ocr_has_failures,
           coalesce(r.ocr_all_complete, true) AS ocr_all_complete,
           coalesce(r.ocr_n_sync, 0) AS ocr_n_sync, coalesce(r.ocr_n_async, 0) AS ocr_n_async,
           r.ocr_first_status, r.document_id IS NOT NULL OR d.has_empty_job_map AS has_textract_jobs
    FROM d LEFT JOIN r USING (document_id)"""


def _docs(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    d = TL.with_ocr_rollup(B.state_documents(spark, sf_dir, only), B.state_jobs(spark, sf_dir, only))
    return d.withColumn("has_textract_jobs", F.col("ocr_first_status").isNotNull() | F.col("has_empty_job_map"))


# ----------------------------------------------------------------- queries

def doc_status_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status view with progress and processing time for every document."""
    d = _docs(spark, sf_dir)
    return ST.status_view(d).select(
        "document_id", "status", "original_filename", "document_type",
        F.date_format("created_at", TS_FMT).alias("created_at"),
        F.date_format("updated_at", TS_FMT).alias("updated_at"),
        "last_error", "progress", "processing_time", "created_display")


_PROGRESS = (f"CAST(floor((1 + CAST({_truthy('step_function_execution_arn')} AS INT)"
             f" + CAST(has_textract_jobs AND ocr_all_complete AS INT)"
             f" + CAST({_truthy('combined_key')} AS INT)"
             f" + CAST({_truthy('result_key')} OR coalesce(status = 'COMPLETE', false) AS INT)"
             f" + CAST(n_moved_files > 0 AS INT)) * 100.0 / 6 + 0.5) AS BIGINT)")


def doc_status_view_sql() -> str:
    return f"""
    SELECT document_id, status, original_filename, document_type,
           strftime(created_at, {DTS}) AS created_at, strftime(updated_at, {DTS}) AS updated_at,
           last_error, {_PROGRESS} AS progress,
           CAST(floor(date_diff('millisecond', created_at, updated_at) / 1000.0 + 0.5) AS BIGINT) AS processing_time,
           {_fmt('created_at')} AS created_display
    FROM ({DOCS_SQL})"""


def doc_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of the list: status filter, then sort, then limit 50, globally, with progress.

    The page is chosen from the columns it is filtered and sorted by; only its 50 documents meet their events, pages
    and jobs."""
    page = ST.list_page(B.state_keys(spark, sf_dir), status="COMPLETE", sort_by="created_at", descending=True, limit=50)
    return ST.status_view(_docs(spark, sf_dir, page.select("o_orderkey"))).select("document_id", "status", "original_filename", "document_type",
                       F.date_format("created_at", TS_FMT).alias("created_at"),
                       F.date_format("updated_at", TS_FMT).alias("updated_at"), "last_error", "progress")


def doc_list_page_sql() -> str:
    return f"""
    SELECT document_id, status, original_filename, document_type, strftime(created_at, {DTS}) AS created_at,
           strftime(updated_at, {DTS}) AS updated_at, last_error, {_PROGRESS} AS progress
    FROM ({DOCS_SQL}) WHERE status = 'COMPLETE'
    ORDER BY coalesce(strftime(created_at, '%Y-%m-%dT%H:%M:%S'), '') DESC, document_id ASC LIMIT 50"""


def doc_list_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page via the continuation key of the first (keyset paging, F3)."""
    d = B.state_documents(spark, sf_dir).where(F.col("status") == "FAILED")
    first = ST.list_page(d, sort_by="original_filename", descending=False, limit=25)
    last = ST.continuation_key(first, sort_by="original_filename")
    nxt = ST.list_page(d, sort_by="original_filename", descending=False, limit=25, after=last)
    return nxt.select("document_id", "status", "original_filename")


def doc_list_next_sql() -> str:
    return f"""
    WITH d AS (SELECT * FROM ({B.STATE_DOCS_SQL}) WHERE status = 'FAILED'),
    o AS (SELECT document_id, status, original_filename,
                 row_number() OVER (ORDER BY coalesce(original_filename, ''), document_id) AS rn FROM d)
    SELECT document_id, status, original_filename FROM o WHERE rn BETWEEN 26 AND 50"""


def doc_list_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third page of the completed documents from the state table in list order: two continuation keys, and only the
    files that the pages' rows are in (F3, A8)."""
    path = checkpoint_path(spark, f"state-list-{uuid.uuid4().hex}")
    keys = B.state_keys(spark, sf_dir).select("document_id", "status", F.date_format("created_at", TS_FMT).alias("created_at"))
    CL.write_clustered(keys, path, ["created_at", "document_id"], "status", descending=True, files=16, bloom=("document_id",))
    after = None
    for _ in range(2):
        last = CL.page(spark, path, ["created_at", "document_id"], "status", "COMPLETE", True, 40, after)
        end = last.orderBy("created_at", F.desc("document_id")).first()
        after = (end["created_at"], end["document_id"]) if end else after
    return CL.page(spark, path, ["created_at", "document_id"], "status", "COMPLETE", True, 40, after)


def doc_list_third_sql() -> str:
    return f"""
    SELECT document_id, status, created_at FROM (
      SELECT document_id, status, strftime(created_at, {DTS}) AS created_at,
             row_number() OVER (ORDER BY strftime(created_at, {DTS}) DESC, document_id) AS rn
      FROM ({B.STATE_DOCS_SQL}) WHERE status = 'COMPLETE') WHERE rn BETWEEN 81 AND 120"""


def newest_per_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three newest documents of every status (F4, a top-k report)."""
    return ST.newest_per_status(B.state_documents(spark, sf_dir), k=3).select(
        "status", "document_id", F.date_format("created_at", TS_FMT).alias("created_at"), "rank")


def newest_per_status_sql() -> str:
    return f"""
    SELECT status, document_id, strftime(created_at, {DTS}) AS created_at, rank FROM (
      SELECT status, document_id, created_at,
             CAST(row_number() OVER (PARTITION BY status ORDER BY created_at DESC, document_id) AS INT) AS rank
      FROM ({B.STATE_DOCS_SQL})) WHERE rank <= 3"""


def doc_files_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files view (B18): original, moved and text files as lists in page order, joined by ','; '' where none."""
    return ST.files_view(B.state_documents(spark, sf_dir), B.state_jobs(spark, sf_dir))


def doc_files_view_sql() -> str:
    moved = "replace(page_key, 'incoming/', 'complete/' || document_id || '/')"
    text = "'staging/' || document_id || '/text_page_' || CAST(page_ordinal AS VARCHAR) || '.txt'"
    return f"""
    WITH j AS (
      SELECT document_id, string_agg(page_key, ',' ORDER BY page_ordinal, page_key) AS original_files,
             string_agg({moved}, ',' ORDER BY page_ordinal, page_key) AS moved_files,
             string_agg({text}, ',' ORDER BY page_ordinal, page_key)
               FILTER (WHERE job_status IN ('SYNC_COMPLETE', 'ASYNC_COMPLETE')) AS ocr_text_files
      FROM ({B.JOBS_SQL}) GROUP BY 1)
    SELECT d.document_id, coalesce(j.original_files, '') AS original_files,
           CASE WHEN d.status = 'COMPLETE' THEN coalesce(j.moved_files, '') ELSE '' END AS moved_files,
           coalesce(j.ocr_text_files, '') AS ocr_text_files,
           d.combined_key AS combined_text_file, d.result_key AS result_file
    FROM ({B.STATE_DOCS_SQL}) d LEFT JOIN j USING (document_id)"""


def doc_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record, timeline and summary of every document in one row (B25): the timeline as 'step:status' joined by ','."""
    d = TL.with_timeline(_docs(spark, sf_dir))
    steps = F.array_join(F.transform("timeline", lambda s: F.concat(s["step"], F.lit(":"), s["status"])), ",")
    full = TL.timeline_summary(d.withColumn("steps", steps), "original_filename", "last_error", "steps")
    return full


def doc_full_sql() -> str:
    return f"""
    WITH docs AS ({DOCS_SQL}), s AS ({_timeline_steps_sql()}),
    c AS (SELECT document_id, count(*) AS total, count(*) FILTER (WHERE sstatus = 'completed') AS done,
                 count(*) FILTER (WHERE sstatus = 'failed') AS failed,
                 string_agg(step || ':' || sstatus, ',' ORDER BY k) AS steps FROM s GROUP BY 1)
    SELECT d.document_id, d.original_filename, d.last_error, c.steps,
           CAST(c.total AS BIGINT) AS total_steps, CAST(c.done AS BIGINT) AS completed_steps,
           CAST(c.failed AS BIGINT) AS failed_steps,
           CAST(CASE WHEN c.total > 0 THEN floor(c.done * 100.0 / c.total + 0.5) ELSE 0 END AS BIGINT) AS progress,
           d.status AS overall_status, d.document_type,
           CAST(floor(date_diff('millisecond', d.created_at, d.updated_at) / 1000.0 + 0.5) AS BIGINT) AS processing_time
    FROM docs d JOIN c USING (document_id)"""


def _timeline_steps_sql(variant: str = "api") -> str:
    if variant == "guide":
        upload = "'File: ' || coalesce(original_filename, 'undefined')"
    else:
        upload = f"'File: ' || CASE WHEN {_truthy('original_filename')} THEN original_filename ELSE 'Unknown' END"
    parts = [f"SELECT document_id, 1 AS k, 'File Upload' AS step, 'completed' AS sstatus, created_at AS ts, {upload} AS details FROM docs"]
    if variant != "guide":
        parts.append("SELECT document_id, 2, 'ZIP Extraction', 'completed', NULL, 'Extracted ' || "
                     "CAST(coalesce(zip_extracted_count, 0) AS VARCHAR) || ' files' FROM docs WHERE has_zip_extraction")
    parts.append(f"SELECT document_id, 3, 'Workflow Triggered', 'completed', created_at, 'Step Functions execution started' "
                 f"FROM docs WHERE {_truthy('step_function_execution_arn')}")
    if variant == "guide":
        parts.append("SELECT document_id, 4, 'OCR Processing', CASE WHEN ocr_first_status IN ('SYNC_COMPLETE', 'ASYNC_COMPLETE') "
                     "THEN 'completed' WHEN ocr_first_status = 'FAILED' THEN 'failed' ELSE 'in_progress' END, NULL, "
                     "'OCR method: ' || CASE WHEN contains(ocr_first_status, 'SYNC') THEN 'Synchronous' ELSE 'Asynchronous' END "
                     "FROM docs WHERE has_textract_jobs AND ocr_first_status IS NOT NULL")
    else:
        parts.append(f"SELECT document_id, 4, 'OCR Processing', {_OCR_STATUS}, NULL, {_ocr_details('api')} "
                     "FROM docs WHERE has_textract_jobs")
    parts.append(f"SELECT document_id, 5, 'Text Aggregation', 'completed', NULL, 'Text from all pages combined' "
                 f"FROM docs WHERE {_truthy('combined_key')}")
    llm_cond = (_truthy("result_key") if variant == "guide"
                else f"({_truthy('result_key')} OR coalesce(status = 'LLM_RUNNING', false))")
    parts.append(f"SELECT document_id, 6, 'LLM Processing', {_LLM_STATUS}, NULL, {_LLM_DETAILS} FROM docs WHERE {llm_cond}")
    parts.append("SELECT document_id, 7, 'File Movement', 'completed', NULL, 'Moved ' || CAST(n_moved_files AS VARCHAR) "
                 "|| ' file(s) to complete folder' FROM docs WHERE n_moved_files > 0")
    return "\nUNION ALL\n".join(parts)


def _timeline_sql(variant: str = "api", error_form: str = "api") -> str:
    return f"""
    WITH docs AS ({DOCS_SQL}),
    s AS ({_timeline_steps_sql(variant)}),
    t AS (SELECT s.*, min(k) FILTER (WHERE sstatus = 'failed') OVER (PARTITION BY s.document_id) AS ff,
                 CAST(row_number() OVER (PARTITION BY s.document_id ORDER BY k) - 1 AS BIGINT) AS step_idx
          FROM s)
    SELECT t.document_id, t.step_idx, t.step, t.sstatus AS status, strftime(t.ts, {DTS}) AS ts, t.details,
           CASE WHEN d.status = 'FAILED' AND {_truthy('d.last_error')} AND t.k = t.ff THEN d.last_error END AS error,
           CASE WHEN d.status = 'FAILED' AND {_truthy('d.last_error')} AND t.k = t.ff
                THEN {_categorize('d.last_error', error_form)} END AS error_type
    FROM t JOIN docs d USING (document_id)"""


def _timeline_rows(spark, sf_dir, variant="api", error_form="api"):
    d = TL.with_timeline(_docs(spark, sf_dir), variant, error_form)
    return TL.explode_timeline(d).select(
        "document_id", "step_idx", "step", "status", F.date_format("ts", TS_FMT).alias("ts"),
        "details", "error", "error_type")


def doc_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured timeline of every document, error on the first failed step."""
    return _timeline_rows(spark, sf_dir)


def doc_timeline_sql() -> str:
    return _timeline_sql()


def timeline_guide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guide-form timeline: first job status only, LLM step only with a result."""
    return _timeline_rows(spark, sf_dir, "guide", "guide")


def timeline_guide_sql() -> str:
    return _timeline_sql("guide", "guide")


def timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline totals, rounded progress and processing time per document."""
    return TL.timeline_summary(TL.with_timeline(_docs(spark, sf_dir)))


def timeline_summary_sql() -> str:
    return f"""
    WITH docs AS ({DOCS_SQL}), s AS ({_timeline_steps_sql()}),
    c AS (SELECT document_id, count(*) AS total, count(*) FILTER (WHERE sstatus = 'completed') AS done,
                 count(*) FILTER (WHERE sstatus = 'failed') AS failed FROM s GROUP BY 1)
    SELECT d.document_id, CAST(c.total AS BIGINT) AS total_steps, CAST(c.done AS BIGINT) AS completed_steps,
           CAST(c.failed AS BIGINT) AS failed_steps,
           CAST(CASE WHEN c.total > 0 THEN floor(c.done * 100.0 / c.total + 0.5) ELSE 0 END AS BIGINT) AS progress,
           d.status AS overall_status, d.document_type,
           CAST(floor(date_diff('millisecond', d.created_at, d.updated_at) / 1000.0 + 0.5) AS BIGINT) AS processing_time
    FROM docs d JOIN c USING (document_id)"""


def timeline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain-text timeline with PII and error lines."""
    return TL.timeline_text(_docs(spark, sf_dir))


def timeline_text_sql() -> str:
    pii_details = (f"CASE WHEN {_truthy('pii_error')} THEN 'Error: ' || {_categorize('pii_error', 'text')} "
                   "ELSE 'PII analysis completed' END")
    lines = [
        f"'- File Upload: completed (' || {_fmt('created_at')} || ')'",
        "CASE WHEN has_zip_extraction THEN '- ZIP Extraction: completed (Extracted ' || "
        "CAST(coalesce(zip_extracted_count, 0) AS VARCHAR) || ' files)' END",
        f"CASE WHEN {_truthy('step_function_execution_arn')} THEN '- Workflow Triggered: completed (' || "
        f"{_fmt('created_at')} || ')' END",
        f"CASE WHEN has_textract_jobs THEN '- OCR Processing: ' || {_OCR_STATUS} || ' (' || {_ocr_details('text')} || ')' END",
        "CASE WHEN pii_processing_complete IS NOT NULL THEN '- PII Processing: ' || "
        f"CASE WHEN pii_processing_complete THEN 'completed' ELSE 'in_progress' END || ' (' || {pii_details} || ')' END",
        f"CASE WHEN {_truthy('combined_key')} THEN '- Text Aggregation: completed' END",
        f"CASE WHEN {_truthy('result_key')} OR coalesce(status = 'LLM_RUNNING', false) THEN '- LLM Processing: ' || "
        f"{_LLM_STATUS} || ' (' || {_LLM_DETAILS} || ')' END",
        "CASE WHEN n_moved_files > 0 THEN '- File Movement: completed (Moved ' || CAST(n_moved_files AS VARCHAR) || "
        "' file(s) to complete folder)' END",
        f"CASE WHEN status = 'FAILED' AND {_truthy('last_error')} THEN '- Error: ' || {_categorize('last_error', 'text')} END",
    ]
    arr = "list_filter([" + ", ".join(lines) + "], lambda x: x IS NOT NULL)"
    return f"""
    SELECT document_id, 'Document ID: ' || document_id || chr(10) || array_to_string({arr}, chr(10)) AS timeline_text
    FROM ({DOCS_SQL})"""


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per status."""
    return ST.status_counts(B.state_documents(spark, sf_dir))


def status_counts_sql() -> str:
    return f"SELECT status, CAST(count(*) AS BIGINT) AS n_documents FROM ({B.STATE_DOCS_SQL}) GROUP BY status"


def failure_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and failure rate per creation month."""
    return ST.failure_rates(B.state_documents(spark, sf_dir), unit="month")


def failure_rates_sql() -> str:
    return f"""
    SELECT strftime(date_trunc('month', created_at), '%Y-%m-%d') AS period, CAST(count(*) AS BIGINT) AS n_runs,
           CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS n_failed,
           round(count(*) FILTER (WHERE status = 'FAILED') * 1.0 / count(*), 6) AS failure_rate
    FROM ({B.STATE_DOCS_SQL}) GROUP BY 1"""


def ocr_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR rollup per document: status, sync/async counts and the all-pages gate."""
    d = _docs(spark, sf_dir)
    from doclake.sources.tables import table
    pages = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                  "l_linestatus").select(F.col("l_orderkey").cast("string").alias("document_id"),
                                         B.object_key_col().alias("page_key"))
    gate = ST.all_pages_complete(pages, B.state_jobs(spark, sf_dir))
    return (d.join(gate, "document_id", "left")
            .select("document_id", "has_textract_jobs",
                    S.ocr_step_status(F.col("ocr_has_failures"), F.col("ocr_all_complete")).alias("ocr_status"),
                    F.col("ocr_n_sync").cast("bigint").alias("n_sync"),
                    F.col("ocr_n_async").cast("bigint").alias("n_async"),
                    F.coalesce("all_pages_complete", F.lit(False)).alias("all_pages_complete")))


def ocr_rollup_sql() -> str:
    return f"""
    WITH docs AS ({DOCS_SQL}),
    p AS (SELECT document_id, count(DISTINCT page_key) AS n_pages
          FROM (SELECT CAST(l_orderkey AS VARCHAR) AS document_id, {B._KEY_SQL} AS page_key FROM lineitem) GROUP BY 1),
    g AS (SELECT document_id, count(DISTINCT page_key) FILTER (WHERE job_status IN ('SYNC_COMPLETE', 'ASYNC_COMPLETE')) AS n_done
          FROM ({B.JOBS_SQL}) GROUP BY 1)
    SELECT d.document_id, d.has_textract_jobs, {_OCR_STATUS} AS ocr_status,
           CAST(ocr_n_sync AS BIGINT) AS n_sync, CAST(ocr_n_async AS BIGINT) AS n_async,
           coalesce(g.n_done = p.n_pages, false) AS all_pages_complete
    FROM docs d LEFT JOIN p USING (document_id) LEFT JOIN g USING (document_id)"""


RETENTION_AS_OF = "1997-01-01 00:00:00"


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows still alive at a fixed as-of time under the ttl attribute."""
    d = B.state_documents(spark, sf_dir)
    return ST.unexpired(d, RETENTION_AS_OF).select("document_id", "ttl")


def retention_sql() -> str:
    return f"""SELECT document_id, ttl FROM ({B.STATE_DOCS_SQL})
    WHERE ttl IS NULL OR ttl > CAST(epoch(TIMESTAMP '{RETENTION_AS_OF}') AS BIGINT)"""


def error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three error-category forms on every failed document's error (H13a-c)."""
    d = B.state_documents(spark, sf_dir).where(F.col("last_error").isNotNull())
    e = F.col("last_error")
    return d.select("document_id", S.categorize_error(e, "api").alias("category_api"),
                    S.categorize_error(e, "text").alias("category_text"),
                    S.categorize_error(e, "guide").alias("category_guide"))


def error_categories_sql() -> str:
    return f"""
    SELECT document_id, {_categorize('last_error', 'api')} AS category_api,
           {_categorize('last_error', 'text')} AS category_text,
           {_categorize('last_error', 'guide')} AS category_guide
    FROM ({B.STATE_DOCS_SQL}) WHERE last_error IS NOT NULL"""


def doc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch point lookup: the records named by returned line items."""
    from doclake.sources.tables import table
    wanted = (table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
              .where(F.col("l_returnflag") == "R")
              .select(F.concat(F.lit("ORD"), F.col("l_orderkey").cast("string")).alias("original_filename")))
    d = B.state_documents(spark, sf_dir)
    return ST.lookup_by(d, wanted, "original_filename").select("document_id", "original_filename", "status")


def doc_lookup_sql() -> str:
    return f"""
    SELECT document_id, original_filename, status FROM ({B.STATE_DOCS_SQL})
    WHERE original_filename IN (SELECT 'ORD' || CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')"""


# ----------------------------------------------------------------- history

def workflow_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State entries with the first later terminal event, status and duration."""
    s = TL.workflow_steps(B.history(spark, sf_dir))
    return s.select("execution_id", "event_id", "state", "status", "terminal_event_id",
                    F.round("duration_s", 3).alias("duration_s"))


_STEPS_SQL = f"""
    WITH h AS ({B.HISTORY_SQL}),
    e AS (SELECT * FROM h WHERE type = 'TaskStateEntered'),
    t AS (SELECT * FROM h WHERE type IN ('TaskSucceeded', 'TaskFailed')),
    m AS (SELECT e.execution_id, e.event_id, e.state, e.ts,
                 arg_min(t.type, (t.ts, t.event_id)) AS ttype, arg_min(t.event_id, (t.ts, t.event_id)) AS tid,
                 min(t.ts) AS tts
          FROM e LEFT JOIN t ON t.execution_id = e.execution_id AND t.ts > e.ts
          GROUP BY e.execution_id, e.event_id, e.state, e.ts)"""


def workflow_steps_sql() -> str:
    return f"""{_STEPS_SQL}
    SELECT execution_id, event_id, state,
           CASE WHEN tid IS NULL THEN 'in_progress' WHEN ttype = 'TaskSucceeded' THEN 'completed' ELSE 'failed' END AS status,
           tid AS terminal_event_id,
           round(date_diff('microsecond', ts, tts) / 1e6, 3) AS duration_s
    FROM m"""


def document_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workflow steps of every document, counted per step and status; none -> not_started."""
    return TL.document_workflow(B.state_documents(spark, sf_dir), TL.workflow_steps(B.history(spark, sf_dir)))


_STEP_STATUS = ("CASE WHEN tid IS NULL THEN 'in_progress' WHEN ttype = 'TaskSucceeded' THEN 'completed' "
                "ELSE 'failed' END")


def document_workflow_sql() -> str:
    return f"""{_STEPS_SQL},
    d AS (SELECT document_id, step_function_execution_arn AS execution_id FROM ({B.STATE_DOCS_SQL}))
    SELECT document_id, state AS step, {_STEP_STATUS} AS status, CAST(count(*) AS BIGINT) AS n_steps
    FROM d JOIN m USING (execution_id) GROUP BY 1, 2, 3
    UNION ALL SELECT document_id, 'No workflow', 'not_started', 1 FROM d WHERE NOT {_truthy('execution_id')}"""


def doc_status_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every document with its ordered workflow steps."""
    d = TL.documents_with_workflow(B.state_documents(spark, sf_dir), TL.workflow_steps(B.history(spark, sf_dir)))
    return d.select("document_id", "status", "original_filename", "document_type",
                    F.date_format("created_at", TS_FMT).alias("created_at"),
                    F.date_format("updated_at", TS_FMT).alias("updated_at"), "last_error", "workflow_steps")


def doc_status_steps_sql() -> str:
    return f"""{_STEPS_SQL},
    l AS (SELECT execution_id, string_agg(state || ':' || {_STEP_STATUS}, ',' ORDER BY ts, event_id) AS steps
          FROM m GROUP BY execution_id)
    SELECT document_id, status, original_filename, document_type, strftime(created_at, {DTS}) AS created_at,
           strftime(updated_at, {DTS}) AS updated_at, last_error,
           CASE WHEN {_truthy('step_function_execution_arn')} THEN coalesce(steps, '') ELSE 'No workflow:not_started' END
           AS workflow_steps
    FROM ({B.STATE_DOCS_SQL}) d LEFT JOIN l ON l.execution_id = d.step_function_execution_arn"""


def _history_steps(spark, sf_dir, mode):
    tl = TL.with_timeline(_docs(spark, sf_dir))
    rows = (tl.select("document_id", F.col("step_function_execution_arn").alias("execution_id"),
                      F.posexplode("timeline").alias("step_idx", "s"))
            .select("document_id", "execution_id", F.col("step_idx").cast("bigint").alias("step_idx"), "s.step"))
    out = TL.history_for_steps(rows, None, B.history(spark, sf_dir), mode=mode)
    return out.select("document_id", "step_idx", "step", "sf_state",
                      F.date_format("sf_ts", TS_FMT).alias("sf_ts"))


def timeline_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline steps with the first matching history event by the state map."""
    return _history_steps(spark, sf_dir, "map")


def _timeline_history_sql(cond: str) -> str:
    return f"""
    WITH docs AS ({DOCS_SQL}), s AS ({_timeline_steps_sql()}),
    t AS (SELECT document_id, k, step,
                 CAST(row_number() OVER (PARTITION BY document_id ORDER BY k) - 1 AS BIGINT) AS step_idx FROM s),
    h AS ({B.HISTORY_SQL}),
    x AS (SELECT t.document_id, t.step_idx, t.step, h.state, h.ts, h.event_id
          FROM t JOIN docs d USING (document_id)
          JOIN h ON h.execution_id = d.step_function_execution_arn AND {cond}),
    f AS (SELECT document_id, step_idx, arg_min(state, (ts, event_id)) AS sf_state, min(ts) AS sf_ts
          FROM x GROUP BY 1, 2)
    SELECT t.document_id, t.step_idx, t.step, f.sf_state, strftime(f.sf_ts, {DTS}) AS sf_ts
    FROM t LEFT JOIN f USING (document_id, step_idx)"""


def timeline_history_sql() -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TL.STATE_TO_STEP.items())
    return _timeline_history_sql(f"(CASE h.state {cases} END) = t.step")


def timeline_history_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same by lower-case containment of the state name in the step name."""
    return _history_steps(spark, sf_dir, "contains")


def timeline_history_contains_sql() -> str:
    return _timeline_history_sql("contains(lower(t.step), lower(h.state))")


def input_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required-input guard errors per document and stage (B15): no pages for OCR,
    no finished page texts for aggregation, no combined key for the LLM stage."""
    from doclake.sources.tables import table
    d = B.state_documents(spark, sf_dir)
    pages = (table(spark, sf_dir, "lineitem", "l_orderkey").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_pages"))
             .select(F.col("l_orderkey").cast("string").alias("document_id"), "n_pages"))
    done = (B.state_jobs(spark, sf_dir).where(F.col("job_status").isin(*S.OCR_DONE))
            .groupBy("document_id").agg(F.count(F.lit(1)).alias("n_texts")))
    j = d.join(pages, "document_id", "left").join(done, "document_id", "left")
    st = F.col("status")
    guards = F.array(
        F.struct(F.lit("ocr").alias("stage"),
                 S.input_guard("ocr", F.coalesce(F.col("n_pages"), F.lit(0)) == 0).alias("error")),
        F.struct(F.lit("aggregate").alias("stage"),
                 S.input_guard("aggregate", st.isin("AGGREGATING", "LLM_RUNNING", "COMPLETE")
                               & (F.coalesce(F.col("n_texts"), F.lit(0)) == 0)).alias("error")),
        F.struct(F.lit("llm").alias("stage"),
                 S.input_guard("llm", st.isin("LLM_RUNNING", "COMPLETE") & ~S.truthy(F.col("combined_key")))
                 .alias("error")))
    return (j.select("document_id", F.explode(guards).alias("g"))
            .where(F.col("g.error").isNotNull()).select("document_id", "g.stage", "g.error"))


def input_guards_sql() -> str:
    m = S.INPUT_GUARD_MESSAGES
    return f"""
    WITH d AS ({B.STATE_DOCS_SQL}),
    p AS (SELECT CAST(l_orderkey AS VARCHAR) AS document_id, count(*) AS n_pages FROM lineitem GROUP BY 1),
    t AS (SELECT document_id, count(*) AS n_texts FROM ({B.JOBS_SQL})
          WHERE job_status IN ('SYNC_COMPLETE', 'ASYNC_COMPLETE') GROUP BY 1),
    j AS (SELECT d.document_id, d.status, d.combined_key, coalesce(p.n_pages, 0) AS n_pages,
                 coalesce(t.n_texts, 0) AS n_texts
          FROM d LEFT JOIN p USING (document_id) LEFT JOIN t USING (document_id))
    SELECT document_id, 'ocr' AS stage, '{m["ocr"]}' AS error FROM j WHERE n_pages = 0
    UNION ALL SELECT document_id, 'aggregate', '{m["aggregate"]}' FROM j
      WHERE status IN ('AGGREGATING', 'LLM_RUNNING', 'COMPLETE') AND n_texts = 0
    UNION ALL SELECT document_id, 'llm', '{m["llm"]}' FROM j
      WHERE status IN ('LLM_RUNNING', 'COMPLETE') AND NOT {_truthy('combined_key')}"""
