"""Timeline operators: per-document processing timelines, their summaries
and text rendering, and workflow steps from execution history.

A timeline is at most seven steps per document, built in one narrow pass
with ``array_compact(array(when(..)))`` over all documents; only the history
joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.functions import status as S
from doclake.operators.scan import Scan, ranged, scanned

STEP_DDL = "struct<step:string,status:string,ts:timestamp_ntz,details:string>"

# ---------------------------------------------------------------------------
# Step names and texts of the timeline.
STEP_UPLOAD, STEP_ZIP, STEP_TRIGGER = "File Upload", "ZIP Extraction", "Workflow Triggered"
STEP_OCR, STEP_AGG, STEP_LLM, STEP_MOVE = "OCR Processing", "Text Aggregation", "LLM Processing", "File Movement"
STEP_PII = "PII Processing"
STEPS = [STEP_UPLOAD, STEP_ZIP, STEP_TRIGGER, STEP_OCR, STEP_AGG, STEP_LLM, STEP_MOVE]
TRIGGER_DETAILS = "Step Functions execution started"
AGG_DETAILS = "Text from all pages combined"
# history state name -> timeline step
STATE_TO_STEP = {"OCR": STEP_OCR, "AggregateText": STEP_AGG, "LLM": STEP_LLM}
ENTERED, SUCCEEDED, FAILED = "TaskStateEntered", "TaskSucceeded", "TaskFailed"
# ---------------------------------------------------------------------------

ROLLUP_COLUMNS = ["ocr_has_failures", "ocr_all_complete", "ocr_n_sync", "ocr_n_async", "ocr_first_status"]


def ocr_rollup(jobs: DataFrame, doc_col: str = "document_id", status_col: str = "job_status",
               order_col: str = "page_ordinal") -> DataFrame:
    """Per document, from the exploded page->job-status table: any failure, all
    complete, sync / async counts and the first job's status. Decomposable
    aggregates only (min_by is combined map-side too)."""
    st = F.col(status_col)
    return jobs.groupBy(doc_col).agg(
        F.bool_or(st == S.OCR_FAILED).alias("ocr_has_failures"),
        F.bool_and(st.isin(*S.OCR_DONE)).alias("ocr_all_complete"),
        F.count_if(st == S.OCR_SYNC).cast("int").alias("ocr_n_sync"),
        F.count_if(st.isin(*S.OCR_ASYNC)).cast("int").alias("ocr_n_async"),
        F.min_by(st, F.struct(F.col(order_col), F.col("page_key"))).alias("ocr_first_status"))


def with_ocr_rollup(docs: DataFrame, jobs: DataFrame, doc_col: str = "document_id",
                    order_col: str = "page_ordinal") -> DataFrame:
    """Attach the rollup; documents without job rows get the empty-map values
    (no failure, all complete, zero counts)."""
    r = ocr_rollup(jobs, doc_col, order_col=order_col)
    out = docs.join(r, doc_col, "left")
    return (out.withColumn("ocr_has_failures", F.coalesce("ocr_has_failures", F.lit(False)))
               .withColumn("ocr_all_complete", F.coalesce("ocr_all_complete", F.lit(True)))
               .withColumn("ocr_n_sync", F.coalesce("ocr_n_sync", F.lit(0)))
               .withColumn("ocr_n_async", F.coalesce("ocr_n_async", F.lit(0))))


def _step(name: str, status: Column, ts: Column | None, details: Column) -> Column:
    return F.struct(F.lit(name).alias("step"), status.alias("status"),
                    (ts if ts is not None else F.lit(None)).cast("timestamp_ntz").alias("ts"),
                    details.alias("details"))


def timeline_steps(variant: str = "api") -> Column:
    """The ordered step array of one document row.

    ``variant``: 'api' (the structured form) or 'guide' (first job status only,
    LLM step only with a result key, no ZIP step).
    """
    c = F.col
    has_map = F.coalesce(c("has_textract_jobs"), F.lit(False))
    steps = []
    if variant == "guide":
        steps.append(F.when(F.lit(True), _step(
            STEP_UPLOAD, F.lit("completed"), c("created_at"),
            F.concat(F.lit("File: "), F.coalesce(c("original_filename"), F.lit("undefined"))))))
    else:
        steps.append(F.when(F.lit(True), _step(
            STEP_UPLOAD, F.lit("completed"), c("created_at"),
            F.concat(F.lit("File: "), F.when(S.truthy(c("original_filename")), c("original_filename"))
                     .otherwise(F.lit("Unknown"))))))
        steps.append(F.when(c("has_zip_extraction"), _step(
            STEP_ZIP, F.lit("completed"), None,
            F.format_string("Extracted %d files", F.coalesce(c("zip_extracted_count"), F.lit(0))))))
    steps.append(F.when(S.truthy(c("step_function_execution_arn")), _step(
        STEP_TRIGGER, F.lit("completed"), c("created_at"), F.lit(TRIGGER_DETAILS))))
    if variant == "guide":
        first = c("ocr_first_status")
        steps.append(F.when(has_map & first.isNotNull(), _step(
            STEP_OCR,
            F.when(first.isin(*S.OCR_DONE), F.lit("completed")).when(first == S.OCR_FAILED, F.lit("failed"))
             .otherwise(F.lit("in_progress")), None,
            F.concat(F.lit("OCR method: "), F.when(first.contains("SYNC"), F.lit("Synchronous"))
                     .otherwise(F.lit("Asynchronous"))))))
    else:
        steps.append(F.when(has_map, _step(
            STEP_OCR, S.ocr_step_status(c("ocr_has_failures"), c("ocr_all_complete")), None,
            S.ocr_details(c("ocr_n_sync"), c("ocr_n_async"), "api"))))
    steps.append(F.when(S.truthy(c("combined_key")), _step(
        STEP_AGG, F.lit("completed"), None, F.lit(AGG_DETAILS))))
    llm_shown = (S.truthy(c("result_key")) if variant == "guide"
                 else S.truthy(c("result_key")) | F.coalesce(c("status") == "LLM_RUNNING", F.lit(False)))
    steps.append(F.when(llm_shown, _step(
        STEP_LLM, S.llm_step_status(c("status")), None, S.llm_details(c("document_type")))))
    steps.append(F.when(F.coalesce(c("n_moved_files"), F.lit(0)) > 0, _step(
        STEP_MOVE, F.lit("completed"), None,
        F.format_string("Moved %d file(s) to complete folder", c("n_moved_files")))))
    return F.array_compact(F.array(*[s.cast(STEP_DDL) for s in steps]))


def with_timeline(docs: DataFrame, variant: str = "api", error_form: str = "api") -> DataFrame:
    """Add ``timeline``: steps plus the error attached to the first failed step
    of a failed document with a non-empty error."""
    steps = timeline_steps(variant)
    staged = docs.withColumn("_steps", steps)
    first_failed = F.array_position(F.transform("_steps", lambda s: s["status"]), "failed")
    attach = (F.col("status") == "FAILED") & S.truthy(F.col("last_error"))
    tl = F.transform("_steps", lambda s, i: F.struct(
        s["step"].alias("step"), s["status"].alias("status"), s["ts"].alias("ts"),
        s["details"].alias("details"),
        F.when(attach & (i + 1 == first_failed), F.col("last_error")).alias("error"),
        F.when(attach & (i + 1 == first_failed),
               S.categorize_error(F.col("last_error"), error_form)).alias("error_type")))
    return staged.withColumn("timeline", tl).drop("_steps")


def explode_timeline(docs: DataFrame, doc_col: str = "document_id") -> DataFrame:
    return (docs.select(doc_col, F.posexplode("timeline").alias("step_idx", "s"))
            .select(doc_col, F.col("step_idx").cast("bigint").alias("step_idx"), "s.*"))


def timeline_summary(docs: DataFrame, *keep: str) -> DataFrame:
    """Totals, completed / failed counts and rounded progress of the timeline (and the columns ``keep``)."""
    tl = F.col("timeline")
    total = F.size(tl)
    done = F.size(F.filter(tl, lambda s: s["status"] == "completed"))
    failed = F.size(F.filter(tl, lambda s: s["status"] == "failed"))
    return docs.select(
        "document_id", *keep, total.cast("bigint").alias("total_steps"),
        done.cast("bigint").alias("completed_steps"), failed.cast("bigint").alias("failed_steps"),
        F.when(total > 0, S.js_round(done * F.lit(100.0) / total)).otherwise(F.lit(0)).cast("bigint")
        .alias("progress"),
        F.col("status").alias("overall_status"), "document_type",
        S.processing_seconds(F.col("created_at"), F.col("updated_at")).alias("processing_time"))


def timeline_text(docs: DataFrame) -> DataFrame:
    """The plain-text timeline: one line per step, PII and error lines included."""
    c = F.col
    has_map = F.coalesce(c("has_textract_jobs"), F.lit(False))
    lines = [
        F.concat(F.lit(f"- {STEP_UPLOAD}: completed ("), S.format_date(c("created_at")), F.lit(")")),
        F.when(c("has_zip_extraction"), F.format_string(
            f"- {STEP_ZIP}: completed (Extracted %d files)", F.coalesce(c("zip_extracted_count"), F.lit(0)))),
        F.when(S.truthy(c("step_function_execution_arn")), F.concat(
            F.lit(f"- {STEP_TRIGGER}: completed ("), S.format_date(c("created_at")), F.lit(")"))),
        F.when(has_map, F.concat(
            F.lit(f"- {STEP_OCR}: "), S.ocr_step_status(c("ocr_has_failures"), c("ocr_all_complete")),
            F.lit(" ("), S.ocr_details(c("ocr_n_sync"), c("ocr_n_async"), "text"), F.lit(")"))),
        F.when(c("pii_processing_complete").isNotNull(), F.concat(
            F.lit(f"- {STEP_PII}: "),
            F.when(c("pii_processing_complete"), F.lit("completed")).otherwise(F.lit("in_progress")),
            F.lit(" ("),
            F.when(S.truthy(c("pii_error")),
                   F.concat(F.lit("Error: "), S.categorize_error(c("pii_error"), "text")))
             .otherwise(F.lit("PII analysis completed")),
            F.lit(")"))),
        F.when(S.truthy(c("combined_key")), F.lit(f"- {STEP_AGG}: completed")),
        F.when(S.truthy(c("result_key")) | F.coalesce(c("status") == "LLM_RUNNING", F.lit(False)), F.concat(
            F.lit(f"- {STEP_LLM}: "), S.llm_step_status(c("status")), F.lit(" ("),
            S.llm_details(c("document_type")), F.lit(")"))),
        F.when(F.coalesce(c("n_moved_files"), F.lit(0)) > 0, F.format_string(
            f"- {STEP_MOVE}: completed (Moved %d file(s) to complete folder)", c("n_moved_files"))),
        F.when((c("status") == "FAILED") & S.truthy(c("last_error")),
               F.concat(F.lit("- Error: "), S.categorize_error(c("last_error"), "text"))),
    ]
    body = F.array_join(F.array_compact(F.array(*lines)), "\n")
    return docs.select("document_id", F.concat(F.lit("Document ID: "), c("document_id"), F.lit("\n"), body)
                       .alias("timeline_text"))


# ----------------------------------------------------------- execution history

def workflow_steps(history: DataFrame, exec_col: str = "execution_id") -> DataFrame:
    """Each state entry with the first later terminal event of the same
    execution (any state, strictly later time, ties by event id): status
    completed / failed / in_progress and the step duration.

    One segmented scan from the latest event to the earliest, which remembers
    the last terminal event it passed. Entries come before the terminal events
    of their own moment, so only strictly later ones count. An execution with
    any share of the events spreads over range partitions of its time.
    """
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    events = history.select(exec_col, "event_id", "ts", "type", "state", t.alias("_t"))
    ends = F.col("type").isin(SUCCEEDED, FAILED) & F.col("_t").isNotNull()
    rows = ranged(events.withColumn("_ends", F.coalesce(ends, F.lit(False))).where(
        F.col("_ends") | (F.col("type") == ENTERED)), [exec_col], [F.col("_t").desc(), "_ends", F.col("event_id").desc()])
    later = Scan("_next", "last", F.when(F.col("_ends"), F.struct(
        F.col("_t").alias("t"), F.col("event_id").alias("id"), F.col("type").alias("type"))))
    marked = scanned(rows, [exec_col], [later]).where(F.col("type") == ENTERED).withColumn(
        "_next", F.when(F.col("_t").isNotNull(), F.col("_next")))
    return marked.select(
        exec_col, "event_id", F.col("state").alias("state"), "ts",
        F.when(F.col("_next").isNull(), F.lit("in_progress"))
         .when(F.col("_next.type") == SUCCEEDED, F.lit("completed")).otherwise(F.lit("failed")).alias("status"),
        F.col("_next.id").alias("terminal_event_id"),
        ((F.col("_next.t") - F.col("_t")) / F.lit(1e6)).alias("duration_s"))


def _with_execution_key(rows: DataFrame, exec_col: str, own: str) -> DataFrame:
    """Add ``_run``, the key to join executions by; rows without an execution get keys of their own that match
    nothing, so that they do not meet in one task."""
    return rows.withColumn("_run", F.when(S.truthy(F.col(exec_col)), F.concat(F.lit("="), F.col(exec_col)))
                           .otherwise(F.concat(F.lit("none "), F.col(own))))


def execution_steps(steps: DataFrame, exec_col: str = "execution_id") -> DataFrame:
    """Per execution, what its documents share: the steps' counts per (state, status) and the ordered list
    ``state:status`` joined by ','. Computed before any document is joined."""
    return steps.groupBy(exec_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "state", "status"))),
                                 lambda x: F.concat(x["state"], F.lit(":"), x["status"])), ",").alias("workflow_steps"))


def document_workflow(docs: DataFrame, steps: DataFrame, exec_col: str = "execution_id") -> DataFrame:
    """Workflow steps per document as (document_id, step, status, n_steps): no execution -> one 'No workflow' /
    'not_started' row; an execution without any entry -> no row. Steps are counted per execution first."""
    counted = (steps.groupBy(exec_col, F.col("state").alias("step"), "status").agg(F.count(F.lit(1)).alias("n_steps"))
               .select(F.concat(F.lit("="), F.col(exec_col)).alias("_run"), "step", "status", "n_steps"))
    d = _with_execution_key(docs.select("document_id", "step_function_execution_arn"), "step_function_execution_arn",
                            "document_id")
    found = d.join(counted, "_run", "left")
    without = ~S.truthy(F.col("step_function_execution_arn"))
    return found.where(without | F.col("step").isNotNull()).select(
        "document_id", F.when(without, F.lit("No workflow")).otherwise(F.col("step")).alias("step"),
        F.when(without, F.lit("not_started")).otherwise(F.col("status")).alias("status"),
        F.when(without, F.lit(1)).otherwise(F.col("n_steps")).cast("bigint").alias("n_steps"))


def documents_with_workflow(docs: DataFrame, steps: DataFrame, exec_col: str = "execution_id") -> DataFrame:
    """Documents with ``workflow_steps``, the ordered list of their execution's steps (B24): 'No workflow:not_started'
    without an execution, '' for one without entries."""
    listed = execution_steps(steps, exec_col).select(F.concat(F.lit("="), F.col(exec_col)).alias("_run"), "workflow_steps")
    d = _with_execution_key(docs, "step_function_execution_arn", "document_id")
    return d.join(listed, "_run", "left").drop("_run").withColumn("workflow_steps", F.when(
        ~S.truthy(F.col("step_function_execution_arn")), F.lit("No workflow:not_started")).otherwise(
        F.coalesce("workflow_steps", F.lit(""))))


def history_for_steps(timeline_rows: DataFrame, docs: DataFrame | None, history: DataFrame,
                      exec_col: str = "execution_id", mode: str = "map") -> DataFrame:
    """Attach to each timeline step the first history event (by time, then id)
    of the document's execution that maps to it.

    ``mode='map'`` uses the fixed state -> step map; ``'contains'`` matches when
    the lower-case step name contains the lower-case state name. The first
    event per (execution, state) is found once; the step names are constants,
    so its steps follow without a join.
    """
    firsts = (history.where(F.col("type").isin(ENTERED, SUCCEEDED, FAILED) & F.col("state").isNotNull())
              .groupBy(exec_col, "state").agg(F.min(F.struct(F.col("ts").alias("sf_ts"), F.col("event_id").alias("sf_id"),
                                                             F.col("state").alias("sf_state"))).alias("m")))
    if mode == "map":
        m = F.create_map(*[x for k, v in STATE_TO_STEP.items() for x in (F.lit(k), F.lit(v))])
        steps = F.array_compact(F.array(m[F.col("state")]))
    else:
        steps = F.array_compact(F.array(*[F.when(F.instr(F.lit(s.lower()), F.lower("state")) > 0, F.lit(s))
                                          for s in STEPS]))
    first = (firsts.select(F.concat(F.lit("="), F.col(exec_col)).alias("_run"), "m", F.explode(steps).alias("step"))
             .groupBy("_run", "step").agg(F.min("m").alias("m")))
    rows = timeline_rows
    if docs is not None:  # else the rows already carry their execution id
        d = docs.select("document_id", F.col("step_function_execution_arn").alias(exec_col))
        rows = timeline_rows.join(d, "document_id", "left")
    out = _with_execution_key(rows, exec_col, "document_id").join(first, ["_run", "step"], "left")
    return out.select(*[c for c in timeline_rows.columns if c != exec_col],
                      F.col("m.sf_state").alias("sf_state"), F.col("m.sf_ts").alias("sf_ts"))
