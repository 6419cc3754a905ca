"""The document lifecycle as batch Spark jobs that hand over written tables.

    manifest -> documents + pages                       (ingest)
    OCR responses -> page texts -> combined texts       (text)
    page texts -> detections + summaries                (pii, parallel to extraction)
    combined texts x schema catalog -> requests         (extraction requests)
    responses -> outcomes, second-pass requests         (extraction results)
    both passes -> result documents + change rows       (results)
    change log -> current document state                (state)

Every stage reads its inputs from tables and writes its outputs as parquet
under ``root`` (by default a folder of the shared ``spark.checkpoint.dir``),
so a lost executor only re-runs the stage it was in, and the next stage
starts from stored rows instead of a long lineage. Writes overwrite the
stage's own folder, and change rows are ordered by their document's arrival
and the stage, not by a clock: re-running any stage leaves the state as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import status as S
from doclake.operators import extract as X
from doclake.operators import flags as FL
from doclake.operators import ingest as I
from doclake.operators import pages as PG
from doclake.operators import pii
from doclake.operators import state as ST
from doclake.session import checkpoint_path

STATE_ATTRS = ["status", "original_filename", "combined_key", "document_type", "last_error",
               "pii_result_key", "pii_error", "result_key", "moved_files", "llm_results"]
STAGES = ["ingest", "text", "pii", "extract", "results"]


@dataclass
class RunTables:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _write(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's table and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _changes(df: DataFrame, t: RunTables, stage: str, attrs: dict) -> None:
    """Write a stage's change-log rows (document_id, seq, ts, attr, value, set_null) from one row per document with
    ``created_at``. ``attrs``: attribute -> value; a null value writes nothing, ``None`` writes an explicit null."""
    items = []
    for a, v in attrs.items():
        val = F.lit(None).cast("string") if v is None else v.cast("string")
        items.append(F.struct(F.lit(a).alias("attr"), val.alias("value"), F.lit(v is None).alias("set_null")))
    rows = (df.select("document_id", F.col("created_at").cast("timestamp_ntz").alias("ts"), F.explode(F.array(*items)).alias("c"))
            .select("document_id", F.lit(STAGES.index(stage)).cast("bigint").alias("seq"), "ts", "c.attr", "c.value", "c.set_null"))
    _write(rows, t.path(f"changes/stage={stage}"))


def _arrivals(spark: SparkSession, t: RunTables) -> DataFrame:
    return spark.read.parquet(t.path("documents")).select("document_id", "created_at")


def ingest_stage(spark: SparkSession, manifest: DataFrame, existing: DataFrame, t: RunTables) -> None:
    """New documents and their page table; rejected objects are kept aside with their reason."""
    parsed = _write(I.parse_keys(manifest), t.path("parsed"))
    accepted = _write(I.skip_existing(I.accepted_pages(parsed), existing), t.path("accepted"))
    _write(I.page_table(accepted), t.path("pages"))
    docs = _write(I.document_records(accepted), t.path("documents"))
    _write(I.rejected_objects(parsed), t.path("rejected"))
    _changes(docs, t, "ingest", {"status": F.col("status"), "original_filename": F.col("original_filename")})


def text_stage(spark: SparkSession, responses: DataFrame, t: RunTables) -> None:
    """Page texts from OCR responses (``object_key, part_no, Blocks`` and optionally ``error``), and combined texts
    of the documents whose pages all have one.

    A document with a page that has no response yet stays as it is; one with a failed page fails with that page's
    error; one whose pages all came back without any text fails with the aggregation guard's message.
    """
    pages = spark.read.parquet(t.path("pages"))
    if "part_no" not in responses.columns:
        responses = responses.withColumn("part_no", F.lit(0))
    if "error" not in responses.columns:
        responses = responses.withColumn("error", F.lit(None).cast("string"))
    text = PG.page_text_from_parts(responses.where(F.col("error").isNull()), ["object_key"])
    errors = responses.where(F.col("error").isNotNull()).groupBy("object_key").agg(F.min_by("error", "part_no").alias("error"))
    joined = pages.join(text, "object_key", "left").join(errors, "object_key", "left")
    page_text = _write(PG.page_text_sink(joined).select(
        "document_id", "page_ordinal", "object_key", "text_key", "text", "n_lines", "error"), t.path("page_text"))
    done = page_text.groupBy("document_id").agg(
        F.bool_and(F.col("text").isNotNull() & F.col("error").isNull()).alias("complete"),
        F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
        F.min(F.when(F.col("error").isNotNull(), F.struct("page_ordinal", "error"))).alias("failed"))
    none = F.col("complete") & (F.col("n_lines") == 0)
    gate = _write(done.select("document_id", (F.col("complete") & ~none).alias("complete"), F.coalesce(
        F.col("failed.error"), S.input_guard("aggregate", none)).alias("last_error")), t.path("gate"))
    ready = page_text.join(gate.where("complete").select("document_id"), "document_id", "left_semi")
    combined = _write(PG.combined_text(ready), t.path("combined"))
    state = gate.join(combined.select("document_id", "combined_key"), "document_id", "left").join(_arrivals(spark, t), "document_id")
    _changes(state, t, "text", {
        "combined_key": F.col("combined_key"), "last_error": F.col("last_error"),
        "status": F.when(F.col("last_error").isNotNull(), F.lit(X.FAILED)).when(F.col("complete"), F.lit(X.PENDING))})


def pii_stage(spark: SparkSession, t: RunTables, flag: dict | None = None, min_confidence: str | None = None) -> None:
    """Detections per page (stored once) and the per-document summary, for the documents whose bucket the flag names
    (no ``flag``: all documents)."""
    docs = spark.read.parquet(t.path("documents"))
    on = docs.where(FL.pii_enabled(F.col("bucket_name"), flag)) if flag is not None else docs
    pages = spark.read.parquet(t.path("page_text")).where(F.col("text").isNotNull()).join(
        on.select("document_id"), "document_id", "left_semi")
    found = _write(pii.with_detections(pages, min_confidence=min_confidence).select(
        "document_id", "page_ordinal", "object_key", "detections"), t.path("page_detections"))
    _write(pii.explode_detections(found, ["document_id", "page_ordinal"]), t.path("detections"))
    summary = pii.result_record(pii.document_summary(found, "document_id"), "document_id")
    stored = _write(summary.withColumn("pii_types_detected", F.array_join("pii_types_detected", ",")), t.path("pii_summary"))
    _write(pii.result_json(found, "document_id", "page_ordinal"), t.path("pii_results"))
    _changes(stored.join(_arrivals(spark, t), "document_id"), t, "pii",
             {"pii_result_key": F.col("pii_result_key"), "pii_error": None})


def extraction_requests_stage(spark: SparkSession, catalog: dict, t: RunTables) -> None:
    """Classification requests from the combined texts; the provider fills them. Without a classification schema
    there is nothing to ask, and the results stage fails the documents."""
    combined = spark.read.parquet(t.path("combined")).withColumnRenamed("combined_text", "text")
    if X.CLASSIFICATION not in catalog:
        combined = combined.limit(0)
    _write(X.build_requests(combined, X.CLASSIFICATION, catalog.get(X.CLASSIFICATION, {})), t.path("requests"))


def extraction_results_stage(spark: SparkSession, responses: DataFrame, catalog: dict, t: RunTables) -> None:
    """Decoded first-pass outcome of every document with a combined text, and the second-pass requests."""
    combined = spark.read.parquet(t.path("combined"))
    req = combined.select("document_id").join(
        spark.read.parquet(t.path("requests")).select("document_id", "request_id"), "document_id", "left")
    decoded = _write(X.decoded_for(req, responses), t.path("classified"))
    out = _write(X.classification_outcome(decoded, sorted(catalog)), t.path("outcomes"))
    texts = combined.select("document_id", F.col("combined_text").alias("text"))
    _write(X.second_pass_requests(texts, out, catalog), t.path("second_requests"))
    failed = out.where(F.col("status") == X.FAILED).join(_arrivals(spark, t), "document_id")
    _changes(failed, t, "extract", {"status": F.col("status"), "last_error": F.col("last_error")})


def results_stage(spark: SparkSession, responses: DataFrame, timestamp: str, t: RunTables) -> None:
    """Result documents of the documents whose passes are all answered, their moved files and final state.

    ``responses`` answer the second-pass requests; a document whose second answer is missing keeps running, one whose
    second call failed completes with the error in its result, as the first pass decides the outcome.
    """
    req = spark.read.parquet(t.path("second_requests"))
    second = X.decoded_for(req, responses)
    waiting = second.where(F.col("success").isNull()).select("document_id")
    out = spark.read.parquet(t.path("outcomes")).join(waiting, "document_id", "left_anti")
    results = _write(X.result_documents(out, spark.read.parquet(t.path("classified")), second, timestamp), t.path("results"))
    moves = _write(I.file_moves(spark.read.parquet(t.path("pages"))).join(
        results.select("document_id"), "document_id", "left_semi"), t.path("moves"))
    moved = moves.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_list("new_key")), ",").alias("moved_files"))
    done = results.join(out.select("document_id", "document_type"), "document_id").join(moved, "document_id").join(
        _arrivals(spark, t), "document_id")
    _changes(done, t, "results", {
        "status": F.lit(X.COMPLETE), "result_key": F.col("result_key"), "moved_files": F.col("moved_files"),
        "document_type": F.col("document_type"), "llm_results": F.col("result_json"), "last_error": None})


def state_stage(spark: SparkSession, t: RunTables) -> DataFrame:
    """Fold every stage's change rows into the current document state."""
    return _write(ST.fold_changes(spark.read.parquet(t.path("changes")), STATE_ATTRS), t.path("state"))


def default_root(spark: SparkSession, run_id: str) -> RunTables:
    """Run tables in the shared checkpoint folder the cluster names."""
    return RunTables(checkpoint_path(spark, f"runs/{run_id}"))
