"""Read-side rules as Column expressions: error categories, progress,
processing time, date display and OCR details."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference rules for equal results.
# (substring, category) checked in this order, case-sensitively.
ERROR_RULES = [
    ("INVALID_IMAGE_TYPE", "Invalid file type - not a valid image or PDF"),
    ("InvalidS3ObjectException", "S3 access issue - file not found or permission denied"),
    ("OpenAI API call failed", "LLM processing failed - API error"),
    ("No pages provided", "No files to process"),
    ("timeout", "Processing timeout"),
]
UNKNOWN_ERROR = "Unknown error"
PROGRESS_STEPS = ["File Upload", "Workflow Triggered", "OCR Processing", "Text Aggregation",
                  "LLM Processing", "File Movement"]
OCR_DONE = ["SYNC_COMPLETE", "ASYNC_COMPLETE"]
OCR_ASYNC = ["ASYNC_STARTED", "ASYNC_COMPLETE"]
OCR_SYNC = "SYNC_COMPLETE"
OCR_FAILED = "FAILED"
DATE_DISPLAY = "yyyy-MM-dd HH:mm:ss"
UNKNOWN_DATE = "Unknown date"
# ---------------------------------------------------------------------------


def truthy(c: Column) -> Column:
    """Script truthiness of a string: null and '' are false."""
    return F.coalesce(c.cast("string") != "", F.lit(False))


def categorize_error(msg: Column, form: str = "api") -> Column:
    """Error category. ``form``: 'api' (else 'Unknown error'), 'text' (else the
    message itself) or 'guide' (no timeout rule, else 'Unknown error')."""
    rules = ERROR_RULES if form != "guide" else [r for r in ERROR_RULES if r[0] != "timeout"]
    out = None
    for needle, cat in rules:
        cond = F.coalesce(msg.contains(needle), F.lit(False))
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return out.otherwise(msg if form == "text" else F.lit(UNKNOWN_ERROR))


def js_round(x: Column) -> Column:
    """Half-up rounding (ties toward +infinity)."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def processing_seconds(created: Column, updated: Column) -> Column:
    """Whole seconds between creation and last update; null if either is missing."""
    return js_round((epoch_millis(updated) - epoch_millis(created)) / F.lit(1000.0))


def format_date(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, DATE_DISPLAY), F.lit(UNKNOWN_DATE))


def ocr_details(n_sync: Column, n_async: Column, form: str = "api") -> Column:
    """OCR step details from the sync/async page counts ('api' or short 'text' form)."""
    sync_only = (F.format_string("Synchronous processing: %d page(s)", n_sync) if form == "api"
                 else F.lit("Synchronous method"))
    async_only = (F.format_string("Asynchronous processing: %d page(s)", n_async) if form == "api"
                  else F.lit("Asynchronous method"))
    return (F.when((n_sync > 0) & (n_async > 0),
                   F.format_string("Mixed processing: %d synchronous, %d asynchronous", n_sync, n_async))
             .when(n_sync > 0, sync_only)
             .when(n_async > 0, async_only)
             .otherwise(F.lit("OCR processing")))


def ocr_step_status(has_failures: Column, all_complete: Column) -> Column:
    return (F.when(has_failures, F.lit("failed"))
             .when(all_complete, F.lit("completed")).otherwise(F.lit("in_progress")))


def llm_step_status(status: Column) -> Column:
    return (F.when(status == "COMPLETE", F.lit("completed"))
             .when(status == "FAILED", F.lit("failed")).otherwise(F.lit("in_progress")))


def llm_details(document_type: Column) -> Column:
    return F.when(truthy(document_type), F.concat(F.lit("Classified as: "), document_type)) \
            .otherwise(F.lit("Classification in progress"))


def progress_percent(arn: Column, has_jobs: Column, ocr_all_complete: Column, combined: Column,
                     result: Column, status: Column, n_moved: Column) -> Column:
    """Share of the six fixed steps that are done, as a rounded percent."""
    done = (F.lit(1)
            + truthy(arn).cast("int")
            + (F.coalesce(has_jobs, F.lit(False)) & F.coalesce(ocr_all_complete, F.lit(True))).cast("int")
            + truthy(combined).cast("int")
            + (truthy(result) | F.coalesce(status == "COMPLETE", F.lit(False))).cast("int")
            + (F.coalesce(n_moved, F.lit(0)) > 0).cast("int"))
    return js_round(done * F.lit(100.0) / F.lit(len(PROGRESS_STEPS)))


def ocr_rollup_from_map(jobs: Column) -> Column:
    """(has_failures, all_complete, n_sync, n_async, first_status) of a page->status map."""
    vals = F.map_values(jobs)
    return F.struct(
        F.exists(vals, lambda v: v == OCR_FAILED).alias("has_failures"),
        F.forall(vals, lambda v: v.isin(*OCR_DONE)).alias("all_complete"),
        F.size(F.filter(vals, lambda v: v == OCR_SYNC)).alias("n_sync"),
        F.size(F.filter(vals, lambda v: v.isin(*OCR_ASYNC))).alias("n_async"),
        F.try_element_at(vals, F.lit(1)).alias("first_status"))


# ---------------------------------------------------------------------------
# Messages of the required-input guards, by stage.
INPUT_GUARD_MESSAGES = {
    "ocr": "No pages provided for OCR processing",
    "aggregate": "No OCR text keys provided for aggregation",
    "llm": "No combined text key provided for LLM processing",
    "pii": "No OCR text keys provided for PII processing",
}
# ---------------------------------------------------------------------------


def input_guard(stage: str, missing: Column) -> Column:
    """The stage's error message when its required input is missing, else null."""
    return F.when(missing, F.lit(INPUT_GUARD_MESSAGES[stage]))


def pages_complete_in_map(pages: Column, jobs: Column) -> Column:
    """Map form of the completion gate: every listed page has a finished job."""
    return F.forall(pages, lambda p: F.coalesce(
        F.map_contains_key(jobs, p) & F.try_element_at(jobs, p).isin(*OCR_DONE), F.lit(False)))


def map_job_entries(jobs: Column) -> Column:
    """(page, status) pairs of a job map, for exploding into the job table."""
    return F.map_entries(jobs)
