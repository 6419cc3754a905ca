import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from doclake.operators import extract as X
from doclake.operators.pages import OCR_RESPONSE
from doclake.plans import runs as R


def _blocks(lines):
    return {"Blocks": [{"BlockType": "PAGE", "Text": None, "Geometry": {"BoundingBox": None}}]
            + [{"BlockType": "LINE", "Text": t, "Geometry": {"BoundingBox": {"Left": 0.1, "Top": 0.1 * i,
                                                                              "Width": 0.5, "Height": 0.05}}}
               for i, t in enumerate(lines)]}


def _responses(spark, rows):
    return spark.createDataFrame([(k, p, json.dumps(_blocks(lines)) if lines is not None else None, e)
                                  for k, p, lines, e in rows], "object_key string, part_no int, body string, error string").select(
        "object_key", "part_no", F.from_json("body", OCR_RESPONSE)["Blocks"].alias("Blocks"), "error")


def _answers(spark, req, content):
    body = json.dumps({"choices": [{"message": {"content": content}}]})
    return req.select("request_id", F.lit(200).alias("http_status"), F.lit(body).alias("body")).distinct()


def _start(spark, responses):
    t = R.default_root(spark, f"test-{uuid.uuid4().hex}")
    ts = dt.datetime(2026, 1, 5, 18, 0)
    names = [("incoming/INV-1.jpg", "image/jpeg"), ("incoming/INV-2.jpg", "image/jpeg"), ("incoming/LTR_1.png", "image/png"),
             ("incoming/OLD-1.jpg", "image/jpeg"), ("incoming/BAD-1.pdf", "application/pdf"),
             ("incoming/WAIT-1.jpg", "image/jpeg"), ("incoming/WAIT-2.jpg", "image/jpeg"),
             ("incoming/ERR-1.jpg", "image/jpeg"), ("incoming/NIL-1.jpg", "image/jpeg")]
    manifest = spark.createDataFrame([(k, c, ts, "b") for k, c in names],
                                     "object_key string, content_type string, event_time timestamp_ntz, bucket string")
    R.ingest_stage(spark, manifest, spark.createDataFrame([("OLD",)], "original_filename string"), t)
    R.text_stage(spark, _responses(spark, responses), t)
    return t


RESPONSES = [("incoming/INV-1.jpg", 1, ["Customer: Mary Poole"], None), ("incoming/INV-1.jpg", 0, ["zwei", "one"], None),
             ("incoming/INV-2.jpg", 0, ["Total 90210"], None), ("incoming/LTR_1.png", 0, ["Dear team"], None),
             ("incoming/WAIT-1.jpg", 0, ["first page"], None), ("incoming/ERR-1.jpg", 0, None, "INVALID_IMAGE_TYPE"),
             ("incoming/NIL-1.jpg", 0, [], None)]


def test_document_run_end_to_end_and_again(spark):
    t = _start(spark, RESPONSES)
    assert sorted(r.original_filename for r in spark.read.parquet(t.path("documents")).collect()) == [
        "ERR", "INV", "LTR", "NIL", "WAIT"]
    assert spark.read.parquet(t.path("rejected")).count() == 1
    pages = spark.read.parquet(t.path("page_text"))
    assert pages.count() == 7
    # the parts of a paginated result are one page, in part order
    assert pages.where("object_key = 'incoming/INV-1.jpg'").first().text == "zwei\none\nCustomer: Mary Poole"
    combined = {r.document_id: r for r in spark.read.parquet(t.path("combined")).collect()}
    assert sorted(r.n_pages for r in combined.values()) == [1, 2]  # no document with a page missing
    R.pii_stage(spark, t)
    assert {r.pii_type for r in spark.read.parquet(t.path("detections")).collect()} == {"personal_name", "zip_code"}
    results = [json.loads(r.result_json) for r in spark.read.parquet(t.path("pii_results")).collect()]
    assert sum(len(r["pii_detections"]) for r in results) == 2

    cat = X.bundled_catalog()

    def extraction():
        R.extraction_requests_stage(spark, cat, t)
        req = spark.read.parquet(t.path("requests"))
        first = _answers(spark, req, '{"document_type": "invoice", "confidence": 0.9}')
        R.extraction_results_stage(spark, first, cat, t)
        second = _answers(spark, spark.read.parquet(t.path("second_requests")), '{"vendor_name": "V"}')
        R.results_stage(spark, second, "2026-01-06T00:00:00", t)

    extraction()
    state = {r.original_filename: r for r in R.state_stage(spark, t).collect()}
    inv = state["INV"]
    assert (inv.status, inv.document_type, inv.last_error) == ("COMPLETE", "invoice", None)
    assert inv.result_key == f"results/{inv.document_id}_response.json"
    assert inv.moved_files == ",".join(f"complete/{inv.document_id}/INV-{n}.jpg" for n in (1, 2))
    assert json.loads(inv.llm_results)["document_analysis"]["specific_extraction"]["data"] == {"vendor_name": "V"}
    assert inv.pii_result_key.startswith("pii-results/") and inv.pii_error is None
    assert (state["WAIT"].status, state["WAIT"].combined_key) == ("OCR_RUNNING", None)
    assert (state["ERR"].status, state["ERR"].last_error) == ("FAILED", "INVALID_IMAGE_TYPE")
    assert (state["NIL"].status, state["NIL"].last_error) == ("FAILED", "No OCR text keys provided for aggregation")
    # re-running any stage, in any order, leaves the state as it is
    for again in (lambda: R.text_stage(spark, _responses(spark, RESPONSES), t), lambda: R.pii_stage(spark, t), extraction):
        again()
        assert {r.original_filename: r for r in R.state_stage(spark, t).collect()} == state


def test_run_without_a_classification_schema(spark):
    t = _start(spark, RESPONSES)
    for cat in ({}, X.DEFAULT_CATALOG):
        R.extraction_requests_stage(spark, cat, t)
        assert spark.read.parquet(t.path("requests")).count() == 0
        R.extraction_results_stage(spark, spark.createDataFrame([], X.RESPONSE_SCHEMA), cat, t)
        state = {r.original_filename: r for r in R.state_stage(spark, t).collect()}
        assert (state["INV"].status, state["INV"].last_error) == ("FAILED", "OpenAI API call failed: Unknown error")


def test_flag_limits_the_pii_stage(spark):
    t = _start(spark, RESPONSES)
    R.pii_stage(spark, t, {"enabled": True, "s3_buckets": ["other"]})
    assert spark.read.parquet(t.path("pii_summary")).count() == 0
    R.pii_stage(spark, t, {"enabled": True, "s3_buckets": ["b"]})
    assert spark.read.parquet(t.path("pii_summary")).count() == 4
