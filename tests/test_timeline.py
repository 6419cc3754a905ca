import datetime as dt

from pyspark.sql import functions as F

from doclake.functions import status as S
from doclake.operators import state as ST
from doclake.operators import timeline as TL

DOC_DDL = ("document_id string, status string, original_filename string, created_at timestamp_ntz, "
           "updated_at timestamp_ntz, step_function_execution_arn string, has_zip_extraction boolean, "
           "zip_extracted_count int, has_textract_jobs boolean, combined_key string, result_key string, "
           "document_type string, n_moved_files int, last_error string, pii_processing_complete boolean, "
           "pii_error string")
T0 = dt.datetime(2026, 1, 5, 18, 0, 0)
T1 = dt.datetime(2026, 1, 5, 18, 5, 0)


def _docs(spark):
    rows = [
        # complete, two sync pages
        ("ok", "COMPLETE", "inv", T0, T1, "arn", False, None, True, "c", "r", "invoice", 2, None, True, None),
        # failed OCR job: error attached to the OCR step
        ("bad", "FAILED", "x", T0, None, "arn", False, None, True, None, None, None, 0,
         "Textract error: INVALID_IMAGE_TYPE", None, None),
        # failed, no failed step -> error attached to nothing (text form still shows it)
        ("lost", "FAILED", "", T0, T1, None, True, None, False, None, "", None, 0, "boom", False, "timeout!"),
        # empty job map is present and counts as complete
        ("empty", "OCR_RUNNING", "e", T0, T1, "arn", False, None, True, None, None, None, 0, None, None, None),
    ]
    docs = spark.createDataFrame(rows, DOC_DDL)
    jobs = spark.createDataFrame([("ok", "p1", 1, "SYNC_COMPLETE"), ("ok", "p2", 2, "SYNC_COMPLETE"),
                                  ("bad", "p1", 1, "FAILED"), ("bad", "p2", 2, "job-123")],
                                 "document_id string, page_key string, page_ordinal long, job_status string")
    return TL.with_ocr_rollup(docs, jobs)


def test_timeline_steps_and_errors(spark):
    t = {r.document_id: r.timeline for r in TL.with_timeline(_docs(spark)).collect()}
    assert [s.step for s in t["ok"]] == ["File Upload", "Workflow Triggered", "OCR Processing",
                                         "Text Aggregation", "LLM Processing", "File Movement"]
    ocr = t["ok"][2]
    assert ocr.status == "completed" and ocr.details == "Synchronous processing: 2 page(s)"
    bad = {s.step: s for s in t["bad"]}
    assert bad["OCR Processing"].status == "failed"
    assert bad["OCR Processing"].error_type == "Invalid file type - not a valid image or PDF"
    assert all(s.error is None for s in t["lost"])
    assert t["lost"][0].details == "File: Unknown"
    assert [s.step for s in t["lost"]] == ["File Upload", "ZIP Extraction"]
    assert t["empty"][2].status == "completed" and t["empty"][2].details == "OCR processing"


def test_summary_text_and_progress(spark):
    d = _docs(spark)
    s = {r.document_id: r for r in TL.timeline_summary(TL.with_timeline(d)).collect()}
    assert s["ok"].progress == 100 and s["ok"].processing_time == 300
    assert s["bad"].processing_time is None
    txt = {r.document_id: r.timeline_text for r in TL.timeline_text(d).collect()}
    assert txt["lost"].splitlines()[-1] == "- Error: boom"
    assert "- PII Processing: in_progress (Error: Processing timeout)" in txt["lost"]
    v = {r.document_id: r.progress for r in ST.status_view(d).collect()}
    assert v["ok"] == 100 and v["bad"] == 33


def test_error_forms(spark):
    msgs = ["INVALID_IMAGE_TYPE", "InvalidS3ObjectException", "OpenAI API call failed", "No pages provided",
            "timeout", "No pages provided + OpenAI API call failed", "TIMEOUT", "", "other"]
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    rows = df.select("m", S.categorize_error(F.col("m"), "api").alias("a"),
                     S.categorize_error(F.col("m"), "text").alias("t"),
                     S.categorize_error(F.col("m"), "guide").alias("g")).collect()
    r = {x.m: x for x in rows}
    assert r["timeout"].a == "Processing timeout" and r["timeout"].g == "Unknown error"
    assert r["No pages provided + OpenAI API call failed"].a == "LLM processing failed - API error"
    assert r["TIMEOUT"].a == "Unknown error" and r["other"].t == "other"


def test_workflow_steps_first_later_terminal(spark):
    ts = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    hist = spark.createDataFrame([
        ("e1", 1, ts(0), "TaskStateEntered", "OCR"), ("e1", 2, ts(5), "TaskSucceeded", "OCR"),
        ("e1", 3, ts(5), "TaskStateEntered", "LLM"), ("e1", 4, ts(5), "TaskFailed", "LLM"),
        ("e1", 5, ts(9), "TaskStateEntered", "AggregateText"),
        ("e2", 1, ts(0), "TaskStateEntered", "OCR"), ("e2", 2, ts(1), "TaskStateEntered", "LLM"),
        ("e2", 3, ts(4), "TaskFailed", "LLM"),
    ], "execution_id string, event_id long, ts timestamp_ntz, type string, state string")
    s = {(r.execution_id, r.event_id): r for r in TL.workflow_steps(hist).collect()}
    assert s[("e1", 1)].status == "completed" and s[("e1", 1)].terminal_event_id == 2
    assert s[("e1", 3)].status == "in_progress"     # same-time terminal is not later
    assert s[("e1", 5)].status == "in_progress"
    assert s[("e2", 1)].status == "failed" and s[("e2", 2)].status == "failed"
    assert s[("e1", 1)].duration_s == 5.0


def test_fold_and_change_flags(spark):
    ts = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    ch = spark.createDataFrame([
        ("d", 1, ts(0), "status", "OCR_RUNNING", False), ("d", 2, ts(1), "status", "COMPLETE", False),
        ("d", 3, ts(2), "pii_error", "x", False), ("d", 4, ts(3), "pii_error", None, True),
        ("d", 5, ts(4), "document_type", None, False),
    ], "document_id string, seq long, ts timestamp_ntz, attr string, value string, set_null boolean")
    f = ST.fold_changes(ch, ["status", "pii_error", "document_type"]).collect()[0]
    assert f.status == "COMPLETE" and f.pii_error is None and f.document_type is None
    polls = spark.createDataFrame([("d", 1, dt.datetime(2026, 1, 1), "a"), ("d", 2, dt.datetime(2026, 1, 1, 1), "a"),
                                   ("d", 3, dt.datetime(2026, 1, 3), "a"), ("d", 4, dt.datetime(2026, 1, 3, 1), "b")],
                                  "document_id string, seq long, ts timestamp_ntz, v string")
    flags = [r.changed for r in ST.change_flags(polls, "v").orderBy("seq").collect()]
    assert flags == [True, False, False, True]


def test_list_paging(spark):
    docs = spark.createDataFrame([(str(i), "COMPLETE", f"f{i % 7}") for i in range(30)],
                                 "document_id string, status string, original_filename string")
    p1 = ST.list_page(docs, sort_by="original_filename", descending=False, limit=10)
    key = ST.continuation_key(p1, sort_by="original_filename", descending=False)
    p2 = ST.list_page(docs, sort_by="original_filename", descending=False, limit=10, after=key)
    allrows = [(r.original_filename, r.document_id) for r in
               docs.orderBy("original_filename", "document_id").collect()]
    assert [(r.original_filename, r.document_id) for r in p1.collect()] == allrows[:10]
    assert [(r.original_filename, r.document_id) for r in p2.collect()] == allrows[10:20]


def test_map_forms(spark):
    df = spark.createDataFrame([
        ("a", ["p1", "p2"], {"p1": "SYNC_COMPLETE", "p2": "job-9"}),
        ("b", ["p1"], {"p1": "ASYNC_COMPLETE"}),
        ("c", ["p1", "p2"], {"p1": "ASYNC_COMPLETE"}),
        ("d", ["p1"], {}),
        ("e", ["p1"], {"p1": "FAILED"}),
    ], "document_id string, pages array<string>, jobs map<string,string>")
    rows = {r.document_id: r for r in df.select(
        "document_id", S.ocr_rollup_from_map(F.col("jobs")).alias("r"),
        S.pages_complete_in_map(F.col("pages"), F.col("jobs")).alias("gate"),
        F.size(S.map_job_entries(F.col("jobs"))).alias("n")).collect()}
    assert rows["a"].r.all_complete is False and rows["a"].r.n_sync == 1 and rows["a"].gate is False
    assert rows["b"].gate is True and rows["b"].r.n_async == 1
    assert rows["c"].gate is False                      # a page without a job entry
    assert rows["d"].r.all_complete is True and rows["d"].n == 0   # every() on an empty map is true
    assert rows["e"].r.has_failures is True
