"""Plan checks over every registered query: no pairwise joins, no row-at-a-time
Python, and filters / column pruning reach the parquet scans."""

import __spark_entry__ as E
from conftest import SF_SMALL
from doclake.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pairwise_joins_or_row_udfs(spark):
    bad = {}
    for name, (fn, _) in registry.QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            if op in plan:
                bad.setdefault(name, []).append(op)
    assert not bad, bad


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(E.queries()["retention"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    docs = _plan(E.queries()["doc_lookup"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in docs
    det = _plan(E.queries()["pii_detections"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in det


# shuffles per query: the rows of a table travel once per key they are brought together by
SHUFFLES = {"ingest_pages": 5, "ingest_pages_lexical": 5, "timeline_history": 5, "timeline_history_contains": 5,
            "llm_pending": 2, "llm_outcomes": 1, "extraction_check": 1, "workflow_steps": 4, "page_batches": 4,
            "masked_text": 0, "pii_boxes": 0, "pii_detections": 0}


def test_number_of_shuffles(spark):
    found = {n: _plan(E.queries()[n](spark, SF_SMALL)).count("Exchange hashpartitioning") for n in SHUFFLES}
    assert all(found[n] <= most for n, most in SHUFFLES.items()), found


def test_building_a_detection_runs_no_job(spark):
    from doclake.operators import pii

    grouped = spark.range(100).selectExpr("id % 7 AS k", "cast(id as string) AS text").groupBy("k").agg({"text": "max"})
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    pii.with_detections(grouped.withColumnRenamed("max(text)", "text"))
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_whole_tables_are_read(spark):
    """Every execution that has history meets documents, and every line item is a page of its document."""
    from doclake.plans import bindings as B

    jobs = B.state_jobs(spark, SF_SMALL).select("document_id").distinct().count()
    assert jobs == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey").distinct().count()
    used = B.state_documents(spark, SF_SMALL).selectExpr("step_function_execution_arn AS e").distinct()
    runs = B.history(spark, SF_SMALL).selectExpr("execution_id AS e").distinct()
    assert runs.join(used, "e", "left_anti").count() == 0
    outcomes = E.queries()["llm_outcomes"](spark, SF_SMALL)
    assert outcomes.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_a_list_page_is_chosen_before_its_joins(spark):
    """Only the page's documents meet events, line items and jobs."""
    plan = E.queries()["doc_list_page"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 4 and "GlobalLimit 50" in plan
    physical = _plan(E.queries()["doc_list_page"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=50" in physical


def test_an_answer_is_parsed_once(spark):
    for name in ("extraction_check", "extraction_typed_all"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        rules = next(line for line in plan.splitlines() if "violations" in line)
        assert "parse_json" not in rules.lower() and "parseJson" not in rules, name
