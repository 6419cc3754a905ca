"""Structured Streaming jobs.

* ``object_arrivals``       file source of arriving objects (micro-batch size)
* ``batch_pages``           gap-window page batching with a watermark
* ``eager_batches``         single page at once, otherwise wait for the gap
                            (map state per page, event-time timer)
* ``dedupe_bases``          one document per base name within the horizon
* ``split_late_pages``      pages of bases that already have a document
* ``late_arrivals``         logged pages that no emitted batch covers (those the
                            watermark made the stream skip)
* ``completion_gate``       emit a document once every page has text
* ``fold_state``            current document state from the change stream
* ``change_feed``           polls whose value changed since the last poll
* ``pii_branch``            detections on the page-text stream (second query)
* ``write_batches``         idempotent multi-sink writes per micro-batch

State is keyed by base name or document id and bounded by a timeout or a
watermark; everything else is plain DataFrame code shared with batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from doclake.operators import ingest as I
from doclake.operators import pii
from doclake.streaming.batching import DEFAULT_GAP, page_batches
from doclake.streaming.stateful import EAGER_OUT, GATE_OUT, CompletionGate, EagerBatches, transformed


def _rows(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """All rows of a group's batches (empty frames skipped)."""
    frames = [b for b in batches if len(b)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


def _ms(t) -> int:
    """Epoch milliseconds of a (session-zone, here UTC) naive timestamp."""
    return int(pd.Timestamp(t).value // 1_000_000)


def _until(state: GroupState, ms: int) -> None:
    """Set an event-time timeout, which must lie behind the watermark: after a quiet time the watermark may already
    have passed ``ms``, and the group then times out with the next batch."""
    state.setTimeoutTimestamp(max(ms, state.getCurrentWatermarkMs() + 1))


MANIFEST_DDL = "object_key string, content_type string, event_time timestamp, bucket string"


def object_arrivals(spark: SparkSession, folder: str, fmt: str = "json", schema: str = MANIFEST_DDL,
                    max_files_per_trigger: int | None = 10, glob: str | None = None,
                    archive: str | None = None) -> DataFrame:
    """Arriving objects as a stream. ``fmt='json'``/``'parquet'`` reads manifest
    records; ``'binaryFile'`` lists stored files (path, modificationTime, length,
    content). ``max_files_per_trigger`` is the micro-batch size (10 for
    documents, 5 for archives and PII messages). With ``archive`` the source
    moves the files of finished batches there (``moved_files`` lists them)."""
    r = spark.readStream.format(fmt)
    if fmt != "binaryFile":
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.load(folder)


def moved_files(spark: SparkSession, folder: str, archive: str) -> DataFrame:
    """The ledger of a source's clean-up: (old_path, new_path) of every file moved below ``archive``, which keeps the
    path the file had."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archive).select("path")
    new = F.regexp_replace("path", "^file:/*", "/")
    return files.select(F.replace(new, F.lit(archive.rstrip("/")), F.lit("")).alias("old_path"), new.alias("new_path"))


def binary_to_manifest(files: DataFrame, bucket: str) -> DataFrame:
    """``binaryFile`` rows of one bucket -> manifest rows (content type from the extension). The bucket is part of a
    document's id, so both ways of reading the same file give the same document."""
    from doclake.functions import keys as K
    key = F.regexp_extract(F.col("path"), r"(incoming/.*)$", 1)
    return files.select(key.alias("object_key"),
                        K.content_type_for(K.extension(K.basename(key))).alias("content_type"),
                        F.col("modificationTime").alias("event_time"), F.lit(bucket).alias("bucket"))


def batch_pages(arrivals: DataFrame, gap: str = DEFAULT_GAP, watermark: str = "10 seconds") -> DataFrame:
    """Gap-window batching of routed, accepted pages. In append mode a batch is
    emitted once the watermark passes its end; the watermark also drops its state."""
    parsed = I.accepted_pages(I.parse_keys(arrivals))
    return page_batches(parsed.withWatermark("event_time", watermark), gap,
                        time_col="event_time", id_col="object_key")


def dedupe_bases(arrivals: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """First arrival per base name within the horizon (older bases are caught by
    the anti join against the document table)."""
    parsed = I.parse_keys(arrivals)
    return parsed.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark(["base_name"])


def split_late_pages(batch: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new pages, late pages): late pages belong to a base that already has a
    document; they are kept visible instead of being dropped."""
    existing = documents.select(F.col("original_filename").alias("base_name")).distinct()
    return (batch.join(existing, "base_name", "left_anti"),
            batch.join(existing, "base_name", "left_semi"))


def late_arrivals(log: DataFrame, batches: DataFrame, gap: str = DEFAULT_GAP) -> DataFrame:
    """Accepted pages of the arrival log that lie in no emitted batch of their base name.

    A stream skips rows behind its watermark without a trace. The log (every arrival, written by ``write_batches``
    before any watermark) still has them: once the batches up to a time are out, these are the pages to hand in again.
    """
    pages = I.accepted_pages(I.parse_keys(log)).withColumn("_t", F.col("event_time").cast("timestamp"))
    spans = batches.select(F.col("base_name").alias("_base"), F.col("batch_start").cast("timestamp").alias("_from"),
                           F.col("batch_end").cast("timestamp").alias("_to"))
    covered = (F.col("base_name") == F.col("_base")) & (F.col("_t") >= F.col("_from")) & (F.col("_t") < F.col("_to"))
    return pages.join(spans, covered, "left_anti").drop("_t")


# ------------------------------------------------------------ eager batching

def eager_batches(arrivals: DataFrame, gap_ms: int = 3000, watermark: str = "10 seconds",
                  horizon_ms: int = 3_600_000) -> DataFrame:
    """Reference-style batching: a base name seen alone is processed at once;
    several pages wait until ``gap_ms`` passes without a new page (event-time
    timeout); pages arriving after a document was emitted come out as 'late'.
    An emitted base keeps a marker for ``horizon_ms``; after that its state is
    dropped and later pages are caught by ``split_late_pages`` against the
    document table."""
    parsed = I.accepted_pages(I.parse_keys(arrivals)).select(
        "base_name", "object_key", F.col("event_time").cast("timestamp").alias("event_time"))
    return transformed(parsed.withWatermark("event_time", watermark).groupBy("base_name"),
                       EagerBatches(gap_ms, horizon_ms), EAGER_OUT)


# ------------------------------------------------------------ completion gate

def completion_gate(page_texts: DataFrame, timeout_ms: int = 3_600_000, watermark: str = "10 minutes") -> DataFrame:
    """Emit each document once when text rows exist for all its pages.

    Input: (document_id, page_ordinal, n_pages, ts) per finished page text.
    Gating on text rows (not on job status) means a document never moves on
    with a page missing. State: the done ordinals of one open document; it is
    dropped ``timeout_ms`` of event time after the document's last page text.
    """
    src = page_texts.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return transformed(src.groupBy("document_id"), CompletionGate(timeout_ms), GATE_OUT)


# ------------------------------------------------------------ state fold

# a document's record lives this long after its last change
TTL_MS = 90 * 86_400_000


def _fold(attrs: list[str], ttl_ms: int):
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        names = ["ts", "seq"] + attrs + [f"{a}__at" for a in attrs]
        cur = dict(zip(names, state.get)) if state.exists else dict.fromkeys(names)
        rows = _rows(batches).sort_values(["ts", "seq"])
        rows_end = rows["ts"].iloc[-1]
        rows = rows[rows["value"].notna() | rows["set_null"]]
        # the last write of each attribute in this batch, against the stored one
        for attr, last in rows.groupby("attr", sort=False).tail(1).set_index("attr").iterrows():
            at = (last["ts"], last["seq"])
            if attr in attrs and (cur[f"{attr}__at"] is None or tuple(cur[f"{attr}__at"]) <= at):
                cur[attr], cur[f"{attr}__at"] = last["value"], list(at)
        if len(rows):
            newest = (rows["ts"].iloc[-1], rows["seq"].iloc[-1])
            if cur["ts"] is None or (cur["ts"], cur["seq"]) <= newest:
                cur["ts"], cur["seq"] = newest
        state.update(tuple(cur[n] for n in names))
        _until(state, _ms(rows_end) + ttl_ms)
        yield pd.DataFrame([{"document_id": key[0], **{a: cur[a] for a in attrs}, "updated_at": cur["ts"]}])
    return fn


def fold_state(changes: DataFrame, attrs: list[str], ttl_ms: int = TTL_MS) -> DataFrame:
    """Current row of every document touched in a micro-batch (update mode).
    Per-attribute latest write by (ts, seq); explicit-null writes win. The watermark stays ``ttl_ms`` behind, and a
    document's state is dropped when it has passed the last change by ``ttl_ms``."""
    out = "document_id string, " + ", ".join(f"{a} string" for a in attrs) + ", updated_at timestamp"
    st = ("ts timestamp, seq long, " + ", ".join(f"{a} string" for a in attrs) + ", "
          + ", ".join(f"{a}__at struct<ts:timestamp,seq:long>" for a in attrs))
    src = changes.select("document_id", F.col("ts").cast("timestamp").alias("ts"), "seq", "attr", "value",
                         F.coalesce("set_null", F.lit(False)).alias("set_null"))
    return src.withWatermark("ts", f"{ttl_ms} milliseconds").groupBy("document_id").applyInPandasWithState(
        _fold(attrs, ttl_ms), out, st, "update", GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------------------ change feed

FEED_OUT = "document_id string, seq long, polled string, changed boolean"


def _feed(ttl_ms: int):
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _rows(batches).sort_values(["ts", "seq"])
        now = rows["polled"].astype(object)
        before = now.shift(1)
        if state.exists:
            before.iloc[0] = state.get[0]
        changed = ~((now == before) | (now.isna() & before.isna()))
        if not state.exists:
            changed.iloc[0] = True
        state.update((now.iloc[-1],))
        _until(state, _ms(rows["ts"].iloc[-1]) + ttl_ms)
        yield pd.DataFrame({"document_id": key[0], "seq": rows["seq"], "polled": now, "changed": changed})
    return fn


def change_feed(polls: DataFrame, value_col: str = "polled", ttl_ms: int = TTL_MS) -> DataFrame:
    """Flag each poll whose value differs from the previous poll of the document
    (state: the last value per document, dropped when the watermark, ``ttl_ms`` behind,
    has passed its last poll by ``ttl_ms``)."""
    src = polls.select("document_id", F.col("ts").cast("timestamp").alias("ts"), "seq",
                       F.col(value_col).cast("string").alias("polled"))
    return src.withWatermark("ts", f"{ttl_ms} milliseconds").groupBy("document_id").applyInPandasWithState(
        _feed(ttl_ms), FEED_OUT, "last string", "append", GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------------------ PII branch

def pii_branch(page_texts: DataFrame, keys: list[str], min_confidence: str | None = None) -> DataFrame:
    """Detections from the page-text stream: the same narrow operator as in
    batch, so this second query never blocks the main branch."""
    return pii.explode_detections(pii.with_detections(page_texts, min_confidence=min_confidence), keys)


def as_of(rows: DataFrame, versions: DataFrame, key: str, time_col: str, value: str) -> DataFrame:
    """``rows`` with ``value`` of the version of their key that was valid at their time (null before the first).

    ``versions`` (key, valid_from, value) is a history of settings: each row meets at most one version, by an equi-join
    on the key and the version's span."""
    at = F.col("valid_from").cast("timestamp")
    spans = versions.select(F.col(key).alias("_key"), at.alias("_from"), F.lead(at).over(
        Window.partitionBy(key).orderBy(at)).alias("_to"), F.col(value))
    t = F.col(time_col).cast("timestamp")
    held = (F.col(key) == F.col("_key")) & (t >= F.col("_from")) & (F.col("_to").isNull() | (t < F.col("_to")))
    return rows.join(spans, held, "left").drop("_key", "_from", "_to")


def pii_batches(flags: Callable[[SparkSession], DataFrame], out: str, keys: list[str], bucket_col: str = "bucket",
                time_col: str = "ts", min_confidence: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the PII branch, a query of its own beside the main one (so that its failures stay
    its own): detections of the pages whose bucket had the flag on at the page's time.

    ``flags`` reads the flag's versions (bucket, valid_from, enabled) anew for every batch, so a change between
    batches counts from its ``valid_from`` on. Rows of a replayed batch replace themselves.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        on = as_of(batch, flags(batch.sparkSession), bucket_col, time_col, "enabled").where(F.coalesce("enabled", F.lit(False)))
        pii_branch(on, keys, min_confidence).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return run


# ------------------------------------------------------------ late pages

CELL_SECONDS = 3600


def covering_batches(pages: DataFrame, batches: DataFrame, cell_seconds: int = CELL_SECONDS) -> DataFrame:
    """``pages`` with ``batch_start`` of the emitted batch of their base name that covers their time (null: none).

    An interval index: every batch's span is listed under the time cells it touches, and a page looks under its base
    name and cell. A base name with most of the pages spreads over its cells.
    """
    def cell(t):
        return F.floor(F.unix_micros(t.cast("timestamp")) / (cell_seconds * 1_000_000))
    spans = batches.select(F.col("base_name"), F.col("batch_start").cast("timestamp").alias("batch_start"),
                           F.col("batch_end").cast("timestamp").alias("_to")).withColumn(
        "_cell", F.explode(F.sequence(cell(F.col("batch_start")), cell(F.col("_to")))))
    t = F.col("event_time").cast("timestamp")
    found = pages.withColumn("_cell", cell(F.col("event_time"))).join(spans, ["base_name", "_cell"], "left")
    covers = (t >= F.col("batch_start")) & (t < F.col("_to"))
    return found.groupBy(*pages.columns).agg(F.min(F.when(covers, F.col("batch_start"))).alias("batch_start"))


def late_router(batches: Callable[[SparkSession], DataFrame], out: str, gap: str = DEFAULT_GAP,
                watermark: str = "10 seconds") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that emits the pages which ``batch_pages`` skips because they are behind its
    watermark: once, with the emitted batch they belong to, if any.

    The watermark is the latest event time of earlier micro-batches less ``watermark``, kept as one row per batch, so
    a replayed batch sees the same one and replaces its rows.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = I.accepted_pages(I.parse_keys(batch)).select("base_name", "object_key", F.col("event_time").cast("timestamp").alias("event_time"))
        try:
            seen = spark.read.parquet(f"{out}/seen").where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]
        except AnalysisException:  # the first batch
            seen = None
        if seen is not None:
            behind = F.col("event_time") + F.expr(f"INTERVAL {gap}") < F.lit(seen) - F.expr(f"INTERVAL {watermark}")
            covering_batches(pages.where(behind).distinct(), batches(spark)).write.mode("overwrite").parquet(
                f"{out}/late/batch_id={batch_id}")
        pages.agg(F.max("event_time").alias("latest")).write.mode("overwrite").parquet(f"{out}/seen/batch_id={batch_id}")
    return run


# ------------------------------------------------------------ sinks

def write_batches(outputs: dict[str, Callable[[DataFrame], DataFrame]], base: str,
                  fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing several outputs of one micro-batch.

    Each output goes to ``{base}/{name}/batch_id={id}`` with overwrite, so a
    replayed batch (after a failure) rewrites the same files instead of
    duplicating rows; the batch is persisted once and shared by all outputs.
    A failing side output is recorded and does not fail the main output. The
    batch's counts (rows, quarantined) are observed while it is written and
    stored below ``{base}/counts`` (``batch_counts``).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        counts = Observation(f"batch {batch_id}")
        counted = with_batch_metrics(batch, counts)
        try:
            for k, (name, make) in enumerate(outputs.items()):
                try:
                    make(batch if k else counted).write.mode("overwrite").format(fmt).save(f"{base}/{name}/batch_id={batch_id}")
                except Exception as e:  # side outputs must not fail the main branch
                    if name == "main":
                        raise
                    spark.createDataFrame([(name, batch_id, str(e))], "output string, batch_id long, error string"
                                          ).write.mode("append").format(fmt).save(f"{base}/_errors")
            got = counts.get
            spark.createDataFrame([(got["rows"], got.get("quarantined", 0))], "n_rows long, n_quarantined long").write.mode(
                "overwrite").format(fmt).save(f"{base}/counts/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return run


def batch_counts(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """``batch_id, n_rows, n_quarantined`` of every micro-batch that ``write_batches`` wrote."""
    return spark.read.format(fmt).load(f"{base}/counts").select(F.col("batch_id").cast("long").alias("batch_id"), "n_rows", "n_quarantined")


def with_batch_metrics(df: DataFrame, name: str | Observation) -> DataFrame:
    """Row and quarantine counts of a (micro-)batch as observed metrics: they
    are computed by the job that consumes ``df``, not by an extra pass."""
    cols = [F.count(F.lit(1)).alias("rows")]
    if "error_reason" in df.columns:
        cols.append(F.count("error_reason").alias("quarantined"))
    return df.observe(name, *cols)


class BatchMetrics(StreamingQueryListener):
    """Keeps the observed counts of every micro-batch of the session's streams (``with_batch_metrics`` on a stream)."""

    def __init__(self):
        self.rows: list[tuple[str, int, str, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for metric, row in p.observedMetrics.items():
            found = row.asDict()
            self.rows.append((str(p.id), p.batchId, metric, found["rows"], found.get("quarantined", 0)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "query_id string, batch_id long, metric string, n_rows long, n_quarantined long")


def quarantine_outputs(good: Callable[[DataFrame], DataFrame]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Outputs for rows with an ``error_reason``: good rows to main, the rest to quarantine."""
    return {"main": lambda b: good(b.where(F.col("error_reason").isNull())),
            "quarantine": lambda b: b.where(F.col("error_reason").isNotNull())}
