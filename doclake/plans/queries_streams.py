"""Registered streaming queries: the streaming jobs over rows that arrive in parts.

A table's rows are written in parts to a folder of the shared checkpoint
folder, in order of their time. After each part the query is started again
from its checkpoint and runs over what is new (``availableNow``), so every
part after the first goes through a restart. The result is what its sink holds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import keys as K
from doclake.operators import extract as X
from doclake.operators import flags as FL
from doclake.operators import pages as PG
from doclake.plans import bindings as B
from doclake.plans import queries_changes as QC
from doclake.plans.oracle_pii import detections_sql
from doclake.plans.queries_extract import llm_requests_sql
from doclake.plans.queries_ingest import envelope_decode_sql
from doclake.session import checkpoint_path
from doclake.sources import envelope as V
from doclake.sources import files as FS
from doclake.streaming import calls as C
from doclake.streaming import jobs as J
from doclake.streaming.stateful import PROVIDER, PROVIDER_KEY

PARTS = 3


class Place:
    """Folders of one run: the source, and a checkpoint and a sink per name."""

    def __init__(self, spark: SparkSession):
        self.root = checkpoint_path(spark, f"stream-{uuid.uuid4().hex}")

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


@contextmanager
def map_state(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB (a query keeps the store it began with)."""
    before = spark.conf.get(PROVIDER_KEY)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER_KEY, before)


def parts_in_time(df: DataFrame, time_col: str, n: int = PARTS) -> Iterator[DataFrame]:
    """The rows in ``n`` parts of equal time spans."""
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    first, last = df.agg(F.min(t), F.max(t)).first()
    if first is None:
        return
    part = F.floor((t - F.lit(first)) * n / F.lit(last - first + 1)).cast("int")
    for k in range(n):
        yield df.where(part == k)


def drain(stream: DataFrame, checkpoint: str, sink: str | Callable, mode: str = "append") -> None:
    """Run the query over all that is new; the sink is a folder or a ``foreachBatch`` function."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = (w.foreachBatch(sink) if callable(sink) else w.format("parquet").option("path", sink)).start()
    q.awaitTermination()


def replayed(rows: Iterator[DataFrame], place: Place, query: Callable[[DataFrame], None]) -> None:
    """Write each part to the source and run the query on the stream of it."""
    for part in rows:
        part.write.mode("append").parquet(place.source)
        spark = part.sparkSession
        query(J.object_arrivals(spark, place.source, fmt="parquet", schema=part.schema, max_files_per_trigger=None))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = B.table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    return ev.selectExpr("concat('incoming/u', user_id, '-', event_id, '.png') AS object_key", "'image/png' AS content_type",
                         "CAST(ts AS TIMESTAMP) AS event_time", f"'{B.BUCKET}' AS bucket")


def _later(arrivals: DataFrame) -> DataFrame:
    """An arrival long after all others, which moves the watermark on."""
    return arrivals.groupBy("content_type", "bucket").agg(F.max("event_time").alias("t")).select(
        F.lit("incoming/zz-1.png").alias("object_key"), "content_type", (F.col("t") + F.expr("INTERVAL 30 DAYS")).alias("event_time"), "bucket")


def _shown(batches: DataFrame) -> DataFrame:
    return batches.select("base_name", F.date_format("batch_start", QC.US_FMT).alias("batch_start"),
                          F.date_format("batch_end", QC.US_FMT).alias("batch_end"), "n_pages")


def stream_page_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page batches of arriving objects with a six-hour gap, as the stream emits them."""
    arrivals, place = _arrivals(spark, sf_dir), Place(spark)
    parts = [*parts_in_time(arrivals, "event_time"), _later(arrivals)]
    replayed(parts, place, lambda s: drain(J.batch_pages(s, "6 hours", "0 seconds"), place.checkpoint, place.out))
    return _shown(spark.read.parquet(place.out))


def stream_page_batches_sql() -> str:
    return f"SELECT 'u' || base_name AS base_name, batch_start, batch_end, n_pages FROM ({QC.page_batches_6h_sql()})"


def stream_first_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base names of arriving objects, each let through once (I4)."""
    place = Place(spark)
    replayed(parts_in_time(_arrivals(spark, sf_dir), "event_time"), place,
             lambda s: drain(J.dedupe_bases(s, "3650 days").select("base_name"), place.checkpoint, place.out))
    return spark.read.parquet(place.out)


def stream_first_bases_sql() -> str:
    return "SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) AS base_name FROM events"


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that pass the completion gate once all their pages have text, page by page over restarts."""
    c = B.table(spark, sf_dir, "conversations", "conv_id", "turn").where("conv_id is not null and turn is not null").distinct()
    n = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_pages"))
    texts = c.join(n, "conv_id").where("not (turn = 1 and conv_id % 5 = 0)").select(
        F.col("conv_id").cast("string").alias("document_id"), F.col("turn").cast("long").alias("page_ordinal"), "n_pages",
        (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("turn").cast("int"))).alias("ts"))
    place = Place(spark)
    with map_state(spark):
        replayed(parts_in_time(texts, "ts"), place, lambda s: drain(J.completion_gate(s), place.checkpoint, place.out))
    return spark.read.schema(J.GATE_OUT).parquet(place.out).select("document_id", "n_pages", F.date_format(
        "completed_at", QC.US_FMT).alias("completed_at"))


def stream_gate_sql() -> str:
    return f"""
    WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
    SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(count(*) AS BIGINT) AS n_pages,
           strftime(TIMESTAMP '2026-01-01' + to_minutes(CAST(max(turn) AS INTEGER)), {QC.DUS}) AS completed_at
    FROM c GROUP BY conv_id HAVING count(*) FILTER (turn = 1 AND conv_id % 5 = 0) = 0"""


def _by_batch(folder: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, i: batch.write.mode("overwrite").parquet(f"{folder}/batch_id={i}")


def stream_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per document from the stream of changes: the last row that it emitted."""
    place = Place(spark)
    replayed(parts_in_time(B.changes(spark, sf_dir), "ts"), place, lambda s: drain(
        J.fold_state(s, QC.ATTRS), place.checkpoint, _by_batch(place.out), "update"))
    rows = spark.read.parquet(place.out)
    last = rows.groupBy("document_id").agg(F.max_by(F.struct(*QC.ATTRS, "updated_at"), "batch_id").alias("r"))
    return last.select("document_id", *[F.col("r")[a].alias(a) for a in QC.ATTRS])


def stream_state_fold_sql() -> str:
    return f"SELECT * EXCLUDE (updated_at) FROM ({QC.state_fold_sql()})"


def stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls whose value changed since the last poll of their document, as a stream (I8)."""
    place = Place(spark)
    replayed(parts_in_time(QC._polls(spark, sf_dir), "ts"), place,
             lambda s: drain(J.change_feed(s), place.checkpoint, place.out))
    return spark.read.schema(J.FEED_OUT).parquet(place.out).select(
        "document_id", "seq", F.col("polled").cast("bigint").alias("polled"), "changed")


def _flag_versions(documents: DataFrame) -> DataFrame:
    """Every bucket's flag turns once: on and then off, or off and then on, by the length of its name."""
    sources = documents.where("source is not null").select("source").distinct()
    on = F.length("source") % 2 == 0
    start = F.lit("2026-01-01").cast("timestamp")
    return sources.select(F.col("source").alias("bucket"), F.explode(F.array(
        F.struct(start.alias("valid_from"), on.alias("enabled")),
        F.struct((start + F.expr("INTERVAL 300 SECONDS")).alias("valid_from"), (~on).alias("enabled")))).alias("v")).select("bucket", "v.*")


def stream_pii_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of the pages whose bucket had the flag on when they came: a query of its own behind the flag's
    history (I9, A25, B14, C3)."""
    docs = B.table(spark, sf_dir, "documents", "doc_id", "text", "source")
    pages = docs.select("doc_id", "text", F.col("source").alias("bucket"), (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(
        secs=(F.col("doc_id") % 900).cast("decimal(18,6)"))).alias("ts"))
    place = Place(spark)
    _flag_versions(docs).write.parquet(place.flags)
    replayed(parts_in_time(pages, "ts", 2), place, lambda s: drain(
        s, place.checkpoint, J.pii_batches(lambda session: session.read.parquet(place.flags), place.out, ["doc_id"])))
    return spark.read.parquet(place.out).drop("batch_id")


def stream_pii_branch_sql() -> str:
    on = "source IS NOT NULL AND ((length(source) % 2 = 0) = (doc_id % 900 < 300))"
    return detections_sql(f"(SELECT doc_id, text FROM documents WHERE {on})", "doc_id")


def stream_late_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages behind the watermark, out of the running stream, with the emitted batch that covers them (I5): every
    fiftieth event arrives after all others."""
    arrivals = _arrivals(spark, sf_dir)
    late = F.regexp_extract("object_key", r"-(\d+)\.png$", 1).cast("long") % 50 == 0
    place, gap = Place(spark), "6 hours"

    def both(stream: DataFrame) -> None:
        drain(J.batch_pages(stream, gap, "0 seconds"), place.batching, place.batches)
        drain(stream, place.routing, J.late_router(lambda s: s.read.parquet(place.batches), place.late, gap, "0 seconds"))
    on_time = arrivals.where(~late)
    # the second late arrival lets the first run's batches be complete before the late pages come
    replayed([on_time, _later(on_time), arrivals.where(late)], place, both)
    return spark.read.parquet(f"{place.late}/late").select("base_name", "object_key", F.date_format(
        "batch_start", QC.US_FMT).alias("batch_start"))


def stream_late_pages_sql() -> str:
    batches = QC.page_batches_6h_sql().replace("FROM events)", "FROM events WHERE event_id % 50 <> 0)")
    return f"""
    SELECT 'u' || l.base_name AS base_name, 'incoming/u' || l.base_name || '-' || CAST(event_id AS VARCHAR) || '.png' AS object_key,
           min(batch_start) AS batch_start
    FROM (SELECT CAST(user_id AS VARCHAR) AS base_name, event_id, strftime(ts, {QC.DUS}) AS t FROM events WHERE event_id % 50 = 0) l
    LEFT JOIN ({batches}) b ON b.base_name = l.base_name AND l.t >= batch_start AND l.t < batch_end
    GROUP BY l.base_name, event_id"""


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and quarantined rows of the decoded queue messages, as counted while their batches were written, beside
    the rows that the sinks hold (D11, A26)."""
    messages = B.queue_messages(spark, sf_dir)
    place = Place(spark)

    def run(stream: DataFrame) -> None:
        decoded = V.decode_storage_events(stream, ["message_id"], prefix="incoming/")
        drain(decoded, place.checkpoint, J.write_batches(J.quarantine_outputs(lambda b: b.select("message_id", "object_key")), place.out))
    replayed((messages.where(F.col("message_id") % 2 == k) for k in range(2)), place, run)
    names = ["n_rows", "n_quarantined", "main_rows", "quarantine_rows"]
    rows = J.batch_counts(spark, place.out).select("n_rows", "n_quarantined")
    for name in ("main", "quarantine"):
        rows = rows.unionByName(spark.read.parquet(f"{place.out}/{name}").select(F.lit(1).cast("long").alias(f"{name}_rows")),
                                allowMissingColumns=True)
    return rows.agg(*[F.sum(n).alias(n) for n in names])


def stream_counts_sql() -> str:
    return f"""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(error_reason) AS BIGINT) AS n_quarantined,
           CAST(count(*) - count(error_reason) AS BIGINT) AS main_rows, CAST(count(error_reason) AS BIGINT) AS quarantine_rows
    FROM ({envelope_decode_sql()})"""


def _stand_in(request: str, payload: str) -> tuple[int, str]:
    """A provider for the check: answers with the payload's digest and never answers some payloads."""
    digest = hashlib.md5(payload.encode()).hexdigest()
    if digest.startswith("f"):
        raise TimeoutError("no answer")
    return 200, f"answer {digest}"


def llm_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every classification request answered or a dead letter: called from a stream, attempt by attempt."""
    requests = X.build_requests(B.llm_documents(spark, sf_dir), X.CLASSIFICATION, X.bundled_catalog()[X.CLASSIFICATION])
    place = Place(spark)
    parts = (requests.where(F.col("document_id").cast("long") % 2 == k).select("request_id", "payload") for k in range(2))
    replayed(parts, place, lambda s: drain(s, place.checkpoint, C.answer_batches(_stand_in, place.out, 2)))
    good = C.answers(spark, place.out).select("request_id", F.col("body").alias("outcome"), F.lit(False).alias("dead"))
    return good.unionByName(C.dead_letters(spark, place.out, 2).select("request_id", F.col("error").alias("outcome"), F.lit(True).alias("dead")))


def llm_answers_sql() -> str:
    return f"""
    SELECT DISTINCT request_id, CASE WHEN payload_md5 LIKE 'f%' THEN 'TimeoutError: no answer' ELSE 'answer ' || payload_md5 END AS outcome,
           payload_md5 LIKE 'f%' AS dead FROM ({llm_requests_sql()})"""


# ------------------------------------------------------------ stored objects

def page_text_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page text of OCR results that come in several parts, five blocks each, none left out."""
    r = B.ocr_responses(spark, sf_dir)
    n = F.ceil(F.size("Blocks") / F.lit(5)).cast("int")
    parts = r.select("doc_id", F.col("Blocks").alias("all"), F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).alias("part_no")).select(
        "doc_id", "part_no", F.slice("all", F.col("part_no") * 5 + 1, 5).alias("Blocks"))
    t = PG.page_text_from_parts(parts, ["doc_id"])
    return t.select("doc_id", "n_lines", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


def pii_gate_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature-flag gate with the flag read from the stored config table."""
    place = Place(spark)
    others = [B.PII_FLAG | {"config_key": "other", "enabled": False}, B.PII_FLAG | {"config_type": "limit", "s3_buckets": []}]
    FL.flag_table(spark, [*others, B.PII_FLAG]).write.json(place.config)
    stored = FS.read_config(spark, place.config, "pii_processing", "feature_flag")
    flag = FL.read_flag(stored, "pii_processing", "feature_flag")
    d = B.table(spark, sf_dir, "documents", "doc_id", "source")
    return d.select("doc_id", "source", FL.pii_enabled(F.col("source"), flag).alias("pii_enabled"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result text per conversation; every fourth conversation has none."""
    c = B.table(spark, sf_dir, "conversations", "conv_id", "text").where("conv_id is not null")
    return c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"))


def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result objects written under their keys and read back for the documents that name them."""
    r = _results(spark, sf_dir)
    place = Place(spark)
    objects = r.where("conv_id % 4 <> 3").select(F.concat(F.col("conv_id").cast("string"), F.lit("_response.json")).alias("name"),
                                                 F.to_json(F.struct("n_turns", "n_chars")).alias("body"))
    FS.write_objects(objects, place.bucket, "results/", "name", "body")
    docs = r.select(F.col("conv_id").cast("string").alias("document_id"), K.result_key(F.col("conv_id").cast("string")).alias("result_key"))
    stored = FS.read_results(spark, place.bucket, schema="n_turns long, n_chars long").select("result_key", "n_turns", "n_chars")
    return FS.results_for_documents(docs, stored).select("document_id", "result_key", "n_turns", "n_chars")


def stored_results_sql() -> str:
    return """
    SELECT CAST(conv_id AS VARCHAR) AS document_id, 'results/' || CAST(conv_id AS VARCHAR) || '_response.json' AS result_key,
           CASE WHEN conv_id % 4 <> 3 THEN CAST(count(*) AS BIGINT) END AS n_turns,
           CASE WHEN conv_id % 4 <> 3 THEN CAST(sum(coalesce(length(text), 0)) AS BIGINT) END AS n_chars
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id"""


def stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turns written as one text object per document, listed below their prefix and read back for the keys that
    are wanted; a key without an object reads as '' (A4, A5)."""
    c = B.table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    texts = c.where("conv_id is not null and turn = 0").groupBy(F.col("conv_id").cast("string").alias("document_id")).agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"))
    place = Place(spark)
    FS.write_objects(texts.withColumn("name", F.concat("document_id", F.lit(".txt"))), place.bucket, "staging/", "name", "text")
    wanted = c.where("conv_id is not null").select(F.col("conv_id").cast("string").alias("document_id")).distinct().select(
        "document_id", F.explode(F.array(F.concat(F.lit("staging/"), "document_id", F.lit(".txt")),
                                         F.concat(F.lit("staging/"), "document_id", F.lit("-none.txt")))).alias("text_key"))
    read = FS.texts_for_keys(wanted, FS.read_texts(spark, place.bucket))
    return read.select("document_id", "text_key", F.md5("text").alias("text_md5"))


def stored_texts_sql() -> str:
    return """
    WITH t AS (SELECT conv_id, min(coalesce(text, '')) || chr(10) AS text FROM conversations WHERE turn = 0 GROUP BY 1),
    d AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    SELECT CAST(conv_id AS VARCHAR) AS document_id, 'staging/' || CAST(conv_id AS VARCHAR) || '.txt' AS text_key,
           md5(coalesce(text, '')) AS text_md5 FROM d LEFT JOIN t USING (conv_id)
    UNION ALL SELECT CAST(conv_id AS VARCHAR), 'staging/' || CAST(conv_id AS VARCHAR) || '-none.txt', md5('') FROM d"""
