"""Queue-message decoding: the two-level event envelope and the two message
shapes of the PII branch. Rows that cannot be processed are kept with an
``error_reason`` (the quarantine side) instead of failing the batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.functions import keys as K

# ---------------------------------------------------------------------------
# Fixed values of the event format.
TEST_EVENT = "s3:TestEvent"
QUEUE_SOURCE = "aws:sqs"
STORAGE_SOURCE = "aws:s3"
# ---------------------------------------------------------------------------

STORAGE_RECORD = T.StructType([
    T.StructField("eventSource", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("eventName", T.StringType()),
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([
            T.StructField("key", T.StringType()), T.StructField("size", T.LongType())])),
    ])),
])
STORAGE_EVENT = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Records", T.ArrayType(STORAGE_RECORD)),
])
QUEUE_BATCH = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("eventSource", T.StringType()), T.StructField("body", T.StringType())])))])
PII_MESSAGE = T.StructType([
    T.StructField("document_id", T.StringType()),
    T.StructField("pages", T.ArrayType(T.StringType())),
    T.StructField("ocr_text_keys", T.ArrayType(T.StringType())),
    T.StructField("bucket_name", T.StringType()),
])


def _one_json(body: Column) -> Column:
    """Exactly one JSON value, no trailing text (the one-element array and the
    object wrapper each reject a different kind of trailing text)."""
    return (F.coalesce(F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1, F.lit(False))
            & F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}"))).isNotNull())


def explode_queue_batch(batches: DataFrame, col: str = "payload", id_col: str = "batch_id") -> DataFrame:
    """A delivered batch ``{"Records": [{eventSource, body}, ...]}`` -> one row per
    queue record (all of them)."""
    parsed = F.from_json(F.col(col), QUEUE_BATCH)
    return (batches.select(id_col, F.posexplode_outer(parsed["Records"]).alias("msg_idx", "r"))
            .select(id_col, "msg_idx", F.col("r.eventSource").alias("event_source"),
                    F.col("r.body").alias("body")))


def decode_storage_events(messages: DataFrame, id_cols: list[str], body_col: str = "body",
                          source_col: str | None = None, require_sources: bool = False,
                          prefix: str | None = None) -> DataFrame:
    """Queue records -> one row per storage record with the decoded object key.

    Output columns: ``id_cols``, record_idx, bucket, object_key, event_time,
    error_reason. ``error_reason`` is null on good rows. Nothing is dropped: a
    bad message (body not JSON, a test event, no records, not from the queue)
    gives one row with the reason, and a record that is not from the store
    (with ``require_sources``, which the archive and PII readers check and the
    ingest reader does not) or whose key is outside ``prefix`` keeps its row
    with the reason.
    """
    body = F.col(body_col)
    valid = _one_json(body)
    ev = F.when(valid, F.from_json(body, STORAGE_EVENT))
    base = messages.select(*id_cols, valid.alias("_valid"), ev.alias("_ev"),
                           *([F.col(source_col).alias("_src")] if source_col else []))
    reason = (F.when(~F.col("_valid"), F.lit("malformed_json"))
               .when(F.col("_ev.Event") == TEST_EVENT, F.lit("test_event"))
               .when(F.coalesce(F.size("_ev.Records"), F.lit(0)) == 0, F.lit("no_records")))
    if require_sources and source_col:
        reason = F.when(~F.coalesce(F.col("_src") == QUEUE_SOURCE, F.lit(False)),
                        F.lit("not_a_queue_record")).otherwise(reason)
    row_ddl = "struct<record_idx:int,bucket:string,object_key:string,event_time:string,error_reason:string>"
    bad = F.array(F.struct(F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string"),
                           F.lit(None).cast("string"), reason).cast(row_ddl))
    recs = F.transform("_ev.Records", lambda r, i: F.struct(
        i.alias("record_idx"), r["s3"]["bucket"]["name"].alias("bucket"),
        K.decode_key(r["s3"]["object"]["key"]).alias("object_key"), r["eventTime"].alias("event_time"),
        F.lit(None).cast("string").alias("error_reason"), r["eventSource"].alias("src")))
    wrong = F.lit(None).cast("string")

    def judged(x):
        why = wrong
        if prefix:
            why = F.when(~F.coalesce(x["object_key"].startswith(prefix), F.lit(False)), F.lit("outside_prefix"))
        if require_sources:
            why = F.when(~F.coalesce(x["src"] == STORAGE_SOURCE, F.lit(False)),
                         F.lit("not_a_storage_record")).otherwise(why)
        return F.struct(x["record_idx"], x["bucket"], x["object_key"], x["event_time"],
                        why.alias("error_reason")).cast(row_ddl)
    good = F.transform(recs, judged)
    # one pass: each message becomes its output rows, exploded once
    out = base.select(*id_cols, F.explode(F.when(reason.isNotNull(), bad).otherwise(good)).alias("o"))
    return out.select(*id_cols, "o.*")


def quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded rows into (good, quarantined)."""
    return (decoded.where(F.col("error_reason").isNull()),
            decoded.where(F.col("error_reason").isNotNull()))


def decode_pii_messages(messages: DataFrame, id_col: str, col: str = "payload",
                        default_bucket: str = "") -> DataFrame:
    """PII-branch messages in either shape -> (document_id, pages, ocr_text_keys,
    bucket_name, error_reason).

    A queue shape ``{"Records": [{eventSource, body}]}`` gives one message per
    record (every record, not only the last); a direct shape carries the
    fields at top level. A missing bucket falls back to ``default_bucket``.
    Nothing is dropped: a body that is not one JSON value, a record that is
    not from the queue and a message without text keys each keep a row with
    the reason.
    """
    raw = F.col(col)
    valid = _one_json(raw)
    queue = F.when(valid, F.from_json(raw, QUEUE_BATCH))
    in_queue = F.coalesce(F.size(queue["Records"]), F.lit(0)) > 0
    # a direct message is one body that needs no source
    bodies = F.when(in_queue, F.transform(queue["Records"], lambda r: F.struct(
        r["body"].alias("body"), F.coalesce(r["eventSource"] == QUEUE_SOURCE, F.lit(False)).alias("trusted")))).otherwise(
        F.array(F.struct(raw.alias("body"), F.lit(True).alias("trusted"))))
    one = messages.select(id_col, F.posexplode(bodies).alias("msg_idx", "r")).select(
        id_col, "msg_idx", F.col("r.trusted").alias("_trusted"), _one_json(F.col("r.body")).alias("_valid"),
        F.from_json("r.body", PII_MESSAGE).alias("m"))
    keys = F.coalesce("m.ocr_text_keys", F.array().cast("array<string>"))
    return one.select(
        id_col, "msg_idx", F.col("m.document_id").alias("document_id"),
        F.coalesce("m.pages", F.array().cast("array<string>")).alias("pages"), keys.alias("ocr_text_keys"),
        F.coalesce("m.bucket_name", F.lit(default_bucket)).alias("bucket_name"),
        F.when(~F.col("_trusted"), F.lit("not_a_queue_record"))
         .when(~F.col("_valid"), F.lit("malformed_json"))
         .when(F.size(keys) == 0, F.lit("No OCR text keys provided for PII processing")).alias("error_reason"))
