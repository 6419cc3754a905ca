"""Bindings: the document model derived from the driver tables.

Each binding has a Spark form and the SQL text of the same derivation, so the
DuckDB check reads the same tables. All derivations are row-wise or
aggregations over whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.sources.tables import table

# ------------------------------------------------------------------ CONV
# conversation = document, turn = page (page numbers are 1-based)


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    doc = F.col("conv_id").cast("string")
    page_no = (F.col("turn") + 1).cast("bigint")
    return c.select(doc.alias("document_id"), page_no.alias("page_no"),
                    F.concat_ws(":", doc, page_no.cast("string")).alias("page_key"), "text")


CONVERSATION_PAGES_SQL = """
    SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(turn + 1 AS BIGINT) AS page_no,
           CAST(conv_id AS VARCHAR) || ':' || CAST(turn + 1 AS VARCHAR) AS page_key, text
    FROM conversations"""


# ------------------------------------------------------------------ KEYS
# lineitem row -> one stored object 'incoming/ORD<orderkey><-|_><linenumber><suffix>'
BUCKET = "lake-bucket"


def _suffix() -> F.Column:
    c = F.col
    return (F.when(c("l_partkey") % 10 == 0, F.lit(".tiff"))
             .when(c("l_partkey") % 10 == 1, F.lit(".JPG"))
             .when(c("l_returnflag") == "N", F.lit(".jpg"))
             .when(c("l_returnflag") == "R", F.lit(".png"))
             .when(c("l_linestatus") == "O", F.lit(".zip"))
             .otherwise(F.lit(".pdf")))


def object_key_col() -> F.Column:
    c = F.col
    sep = F.when(c("l_linenumber") % 2 == 0, F.lit("-")).otherwise(F.lit("_"))
    return F.concat(F.lit("incoming/ORD"), c("l_orderkey").cast("string"), sep,
                    c("l_linenumber").cast("string"), _suffix())


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored objects; the uploader sets the content type from the suffix."""
    from doclake.functions import keys as K
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
               "l_returnflag", "l_linestatus", "l_shipdate")
    suffix = _suffix()
    ctype = F.when(F.lower(suffix).isin(".tif", ".tiff"), F.lit("image/tiff")).otherwise(K.content_type_for(suffix))
    return li.select(object_key_col().alias("object_key"), ctype.alias("content_type"),
                     F.col("l_shipdate").alias("event_time"), F.lit(BUCKET).alias("bucket"),
                     "l_orderkey", "l_linenumber")


_KEY_SQL = """'incoming/ORD' || CAST(l_orderkey AS STRING) || CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '_' END
        || CAST(l_linenumber AS STRING)
        || CASE WHEN l_partkey % 10 = 0 THEN '.tiff' WHEN l_partkey % 10 = 1 THEN '.JPG'
                WHEN l_returnflag = 'N' THEN '.jpg' WHEN l_returnflag = 'R' THEN '.png'
                WHEN l_linestatus = 'O' THEN '.zip' ELSE '.pdf' END"""


def _ctype_sql(ext: str) -> str:
    from doclake.functions.keys import CONTENT_TYPES, DEFAULT_CONTENT_TYPE
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CONTENT_TYPES.items())
    return f"CASE lower({ext}) {whens} ELSE '{DEFAULT_CONTENT_TYPE}' END"


MANIFEST_SQL = f"""
    SELECT object_key,
           CASE WHEN lower(ext) IN ('.tif', '.tiff') THEN 'image/tiff' ELSE {_ctype_sql('ext')} END AS content_type,
           event_time, '{BUCKET}' AS bucket, l_orderkey, l_linenumber
    FROM (SELECT object_key, regexp_extract(string_split(object_key, '/')[-1], '^(\\.*[^.].*)(\\.[^.]*)$', 2) AS ext,
                 l_shipdate AS event_time, l_orderkey, l_linenumber
          FROM (SELECT {_KEY_SQL} AS object_key, * FROM lineitem))"""


def existing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents already recorded: finished orders, named like the objects."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return (o.where(F.col("o_orderstatus") == "F")
            .select(F.concat(F.lit("ORD"), F.col("o_orderkey").cast("string")).alias("original_filename")))


EXISTING_SQL = "SELECT 'ORD' || CAST(o_orderkey AS VARCHAR) AS original_filename FROM orders WHERE o_orderstatus = 'F'"

# ------------------------------------------------------------------ ENV
# one queue record per lineitem row; some malformed, some test events, some
# with two storage records, some keys URL-encoded


def _record_sql(key: str) -> str:
    return ("'{\"eventSource\":\"aws:s3\",\"s3\":{\"bucket\":{\"name\":\"" + BUCKET
            + "\"},\"object\":{\"key\":\"' || " + key + " || '\"}}}'")


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
               "l_returnflag", "l_linestatus")
    # the same SQL expression text builds the body in both engines
    return li.selectExpr("l_orderkey * 10 + l_linenumber AS message_id", f"{QUEUE_BODY_SQL} AS body")


_ENC_KEY_SQL = f"""CASE WHEN l_linenumber = 3 THEN replace({_KEY_SQL}, 'ORD', 'ORD+')
        WHEN l_linenumber = 5 THEN replace({_KEY_SQL}, '_', '%5F') ELSE {_KEY_SQL} END"""

QUEUE_BODY_SQL = f"""CASE WHEN (l_orderkey * 10 + l_linenumber) % 50 = 0 THEN '{{"Records": ['
        WHEN (l_orderkey * 10 + l_linenumber) % 47 = 0 THEN '{{"Event":"s3:TestEvent"}}'
        WHEN l_linenumber = 7 THEN '{{"Records":[' || {_record_sql(_ENC_KEY_SQL)} || ',' ||
             {_record_sql("replace(" + _ENC_KEY_SQL + ", 'incoming/', 'other/')")} || ']}}'
        ELSE '{{"Records":[' || {_record_sql(_ENC_KEY_SQL)} || ']}}' END"""

QUEUE_MESSAGES_SQL = f"SELECT l_orderkey * 10 + l_linenumber AS message_id, {QUEUE_BODY_SQL} AS body FROM lineitem"


# conversation -> one message of the PII branch, in either shape, some of them bad
_PII_BODY = """'{"document_id":"' || CAST(conv_id AS STRING) || '","pages":["incoming/' || CAST(conv_id AS STRING)
        || '-1.png"],"ocr_text_keys":[' || CASE WHEN conv_id % 7 = 0 THEN '' ELSE
           '"staging/' || CAST(conv_id AS STRING) || '/text_page_1.txt"' END || ']'
        || CASE WHEN conv_id % 3 = 0 THEN ',"bucket_name":"other"' ELSE '' END || '}'"""


def _queue_record(source: str, body: str) -> str:
    return f"'{{\"eventSource\":\"{source}\",\"body\":\"' || replace({body}, '\"', '\\\\\"') || '\"}}'"


PII_PAYLOAD_SQL = f"""CASE conv_id % 5 WHEN 0 THEN {_PII_BODY}
        WHEN 1 THEN '{{"Records":[' || {_queue_record('aws:sqs', _PII_BODY)} || ']}}'
        WHEN 2 THEN '{{"Records":[' || {_queue_record('aws:sqs', _PII_BODY)} || ',' || {_queue_record('aws:sns', _PII_BODY)} || ']}}'
        WHEN 3 THEN '{{"Records":[' || {_queue_record('aws:sqs', "'{bad'")} || ']}}'
        ELSE {_PII_BODY} || ' trailing' END"""

# ------------------------------------------------------------------ STATE
# orders row -> one document record; lineitem rows -> its page -> job-status map
# ---------------------------------------------------------------------------
# Fixed test messages for the error rules (cycled by order key).
ERROR_MESSAGES = [
    "Textract error: INVALID_IMAGE_TYPE for page",
    "An error occurred (InvalidS3ObjectException) when calling the operation",
    "OpenAI API call failed: HTTP error: 429 - rate limited",
    "No pages provided for OCR processing",
    "Task timed out: timeout after 300 seconds",
    "Lambda TIMEOUT reached",
    "No pages provided; OpenAI API call failed",
    "",
]
# ---------------------------------------------------------------------------
TYPE_BY_PRIORITY = {"1-URGENT": "invoice", "2-HIGH": "promotion", "3-MEDIUM": "receipt",
                    "4-NOT SPECIFIED": "letter"}


def _status_sql() -> str:
    return ("CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'P' THEN 'FAILED' ELSE "
            "CASE o_orderkey % 4 WHEN 0 THEN 'OCR_RUNNING' WHEN 1 THEN 'AGGREGATING' "
            "WHEN 2 THEN 'LLM_RUNNING' ELSE 'AWAITING_PAGES' END END")


def _errmsg_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(ERROR_MESSAGES))
    return f"CASE o_orderkey % {len(ERROR_MESSAGES)} {whens} END"


def _doctype_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_BY_PRIORITY.items())
    return f"CASE o_orderpriority {whens} ELSE 'other' END"


# shared SQL (same text in Spark SQL and DuckDB); status is computed first
_STATE_COLS = [
    "document_id", "status",
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'ORD' || CAST(o_orderkey AS STRING) END AS original_filename",
    f"'{BUCKET}' AS bucket_name",
    # an order's execution is that of the user of the event of the same number;
    # some have none, and some one without any history
    """CASE WHEN o_orderkey % 19 = 0 THEN 'exec-without-history-' || CAST(o_orderkey AS STRING)
         WHEN o_orderkey % 7 <> 0 THEN 'exec-' || CAST(user_id AS STRING) END AS step_function_execution_arn""",
    """CASE WHEN status IN ('COMPLETE', 'LLM_RUNNING') OR (status = 'FAILED' AND o_orderkey % 3 = 0)
         THEN 'staging/' || document_id || '/combined.txt' END AS combined_key""",
    """CASE WHEN status = 'COMPLETE' THEN 'results/' || document_id || '_response.json'
         WHEN status = 'FAILED' AND o_orderkey % 3 = 1 THEN '' END AS result_key""",
    f"""CASE WHEN status = 'COMPLETE' OR (status = 'FAILED' AND o_orderkey % 5 = 0)
         THEN {_doctype_sql()} END AS document_type""",
    f"CASE WHEN status = 'FAILED' THEN {_errmsg_sql()} END AS last_error",
    "o_orderkey % 10 = 3 AS has_zip_extraction",
    "CASE WHEN o_orderkey % 10 = 3 AND o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 9 AS INT) END AS zip_extracted_count",
    "CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS pii_processing_complete",
    "CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'PII timeout reading page' END AS pii_error",
    "o_orderkey % 2 = 0 AS has_empty_job_map",
    "o_orderkey", "o_custkey", "o_orderdate",
]
_STATE_COLS_SQL = ",\n    ".join(_STATE_COLS)

STATE_BASE_SQL = f"""
    SELECT {_STATE_COLS_SQL} FROM (
      SELECT CAST(o_orderkey AS STRING) AS document_id, {_status_sql()} AS status, o.*, e.user_id
      FROM orders o LEFT JOIN (SELECT event_id, user_id FROM events) e ON e.event_id = o.o_orderkey)"""

JOB_STATUS_SQL = """CASE WHEN l_partkey % 97 = 0 THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'SYNC_COMPLETE'
        WHEN l_returnflag = 'A' THEN 'ASYNC_COMPLETE'
        WHEN l_returnflag = 'R' THEN 'job-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
        ELSE 'ASYNC_STARTED' END"""

# a page -> status map holds one status per page key: duplicate keys keep the
# greatest status and the smallest line number as their position
JOBS_SQL = f"""
    SELECT document_id, page_key, min(page_ordinal) AS page_ordinal, max(job_status) AS job_status FROM (
      SELECT CAST(l_orderkey AS STRING) AS document_id, {_KEY_SQL} AS page_key,
             CAST(l_linenumber AS BIGINT) AS page_ordinal, {JOB_STATUS_SQL} AS job_status
      FROM lineitem)
    GROUP BY document_id, page_key"""


def state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a list is filtered and sorted by, of every document: no join."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    return o.selectExpr("o_orderkey", "CAST(o_orderkey AS STRING) AS document_id", f"{_status_sql()} AS status",
                        "o_orderdate AS created_at")


def _of(df: DataFrame, column: str, only: DataFrame | None) -> DataFrame:
    """The rows of the documents ``only`` (``o_orderkey``; one list page, so it is small enough to send along)."""
    if only is None:
        return df
    return df.join(F.broadcast(only.select(F.col("o_orderkey").alias(column))), column, "left_semi")


def state_documents(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """The document state table (one row per order) with timestamps and counts."""
    o = _of(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                  "o_orderpriority"), "o_orderkey", only)
    runs = _of(table(spark, sf_dir, "events", "event_id", "user_id"), "event_id", only)
    base = (o.join(runs, F.col("event_id") == F.col("o_orderkey"), "left")
            .selectExpr("CAST(o_orderkey AS STRING) AS document_id", f"{_status_sql()} AS status", "*")
            .selectExpr(*_STATE_COLS))
    moved = (_of(table(spark, sf_dir, "lineitem", "l_orderkey"), "l_orderkey", only).groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).cast("int").alias("n_lines")))
    upd = F.timestamp_add("SECOND", F.col("o_custkey"), F.col("o_orderdate"))
    return (base.join(moved, base.o_orderkey == moved.l_orderkey, "left")
            .withColumn("n_moved_files", F.when(F.col("status") == "COMPLETE",
                                                F.coalesce(F.col("n_lines"), F.lit(0))).otherwise(F.lit(0)))
            .withColumn("created_at", F.col("o_orderdate"))
            .withColumn("updated_at", F.when(F.col("o_custkey") % 11 != 0, upd))
            .withColumn("ttl", (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.lit(90 * 86400)))
            .drop("l_orderkey", "n_lines"))


STATE_DOCS_SQL = f"""
    SELECT s.* EXCLUDE (o_orderdate),
           CASE WHEN s.status = 'COMPLETE' THEN CAST(coalesce(m.n_lines, 0) AS INT) ELSE 0 END AS n_moved_files,
           s.o_orderdate AS created_at,
           CASE WHEN s.o_custkey % 11 <> 0 THEN s.o_orderdate + to_seconds(s.o_custkey) END AS updated_at,
           CAST(epoch(s.o_orderdate) AS BIGINT) + {90 * 86400} AS ttl
    FROM ({STATE_BASE_SQL}) s
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) m ON s.o_orderkey = m.l_orderkey"""


def state_jobs(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    li = _of(table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                   "l_linestatus"), "l_orderkey", only)
    rows = li.select(
        F.col("l_orderkey").cast("string").alias("document_id"), object_key_col().alias("page_key"),
        F.col("l_linenumber").cast("bigint").alias("page_ordinal"),
        F.expr(JOB_STATUS_SQL).alias("job_status"))
    return rows.groupBy("document_id", "page_key").agg(F.min("page_ordinal").alias("page_ordinal"),
                                                       F.max("job_status").alias("job_status"))


# ------------------------------------------------------------------ HIST / CHG
# events: user_id = execution / document; event_type picks the history type
# or the changed attribute
HISTORY_TYPE = {"view": "TaskStateEntered", "purchase": "TaskSucceeded", "error": "TaskFailed"}
HISTORY_STATES = ["OCR", "AggregateText", "LLM"]


def _history_type_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HISTORY_TYPE.items())
    return f"CASE event_type {whens} ELSE 'Other' END"


def _state_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(HISTORY_STATES))
    return f"CASE event_id % {len(HISTORY_STATES)} {whens} END"


HISTORY_SQL = f"""
    SELECT 'exec-' || CAST(user_id AS STRING) AS execution_id, event_id, ts,
           {_history_type_sql()} AS type, CASE WHEN event_type = 'view' THEN {_state_sql()} END AS state
    FROM events WHERE event_type IN ({", ".join(f"'{k}'" for k in HISTORY_TYPE)})"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Execution history rows of the kept event types (A10); only entries name a state."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return ev.where(F.col("event_type").isin(*HISTORY_TYPE)).selectExpr(
        "'exec-' || CAST(user_id AS STRING) AS execution_id", "event_id", "ts",
        f"{_history_type_sql()} AS type", f"CASE WHEN event_type = 'view' THEN {_state_sql()} END AS state")


CHANGE_ATTR = {"view": "status", "click": "document_type", "purchase": "result_key",
               "error": "last_error", "signup": "combined_key"}


def _attr_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CHANGE_ATTR.items())
    return f"CASE event_type {whens} END"


# value: a string for most rows; every 13th change writes an explicit null
_CHANGE_COLS = [
    "CAST(user_id AS STRING) AS document_id", "event_id AS seq", "ts", f"{_attr_sql()} AS attr",
    """CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE event_type || '-' || CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS value""",
    "event_id % 13 = 0 AS set_null",
]
CHANGES_SQL = "SELECT " + ", ".join(_CHANGE_COLS) + " FROM events"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute change log rows (document_id, seq, ts, attr, value, set_null)."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.selectExpr(*_CHANGE_COLS)


# ------------------------------------------------------------------ LINES
# documents.text split on newlines = the LINE blocks of a one-page OCR
# response (a PAGE block first); boxes from the line position and length
IMG_W = IMG_H = 1024


def ocr_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from doclake.operators.pages import BLOCK
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)

    def box(i, ln):
        return F.struct(F.lit(0.0625).alias("Left"), ((i % 64) / F.lit(64.0)).alias("Top"),
                        (F.least(F.length(ln), F.lit(60)) / F.lit(64.0)).alias("Width"),
                        F.lit(1 / 64).alias("Height"))

    page = F.struct(F.lit("PAGE").alias("BlockType"), F.lit(None).cast("string").alias("Text"),
                    F.struct(F.struct(F.lit(0.0).alias("Left"), F.lit(0.0).alias("Top"), F.lit(1.0).alias("Width"),
                                      F.lit(1.0).alias("Height")).alias("BoundingBox")).alias("Geometry"))
    line_blocks = F.transform(lines, lambda ln, i: F.struct(
        F.lit("LINE").alias("BlockType"), ln.alias("Text"), F.struct(box(i, ln).alias("BoundingBox")).alias("Geometry")))
    blocks = F.concat(F.array(page), line_blocks).cast(T.ArrayType(BLOCK))
    return d.select("doc_id", F.lit(1).cast("bigint").alias("page_no"), F.lit(IMG_W).alias("img_width"),
                    F.lit(IMG_H).alias("img_height"), blocks.alias("Blocks"))


# 1-based block index i of each line (the PAGE block is index 0)
LINES_SQL = """
    SELECT doc_id, i AS line_ord, t AS text FROM (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t,
             unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i
      FROM documents)"""


# ------------------------------------------------------------------ PIIX
# orders row -> a filled form (page) of its customer (document), with every
# kind of personal data in some of them; the same SQL text in both engines
PIIX_FIRST, PIIX_LAST = ["Mary", "Vincent", "Anna", "Omar"], ["Poole", "Lopez", "Smith", "Hale"]


def _pick(names: list[str], of: str) -> str:
    return f"CASE {of} % {len(names)} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


_PIIX_NAME = f"{_pick(PIIX_FIRST, 'o_orderkey')} || ' ' || {_pick(PIIX_LAST, 'o_custkey')}"


def _digits(of: str, n: int) -> str:
    return f"lpad(CAST(({of}) % {10 ** n} AS STRING), {n}, '0')"


PIIX_SQL = f"""
    SELECT CAST(o_custkey AS STRING) AS document_id, o_orderkey AS page_no,
           CASE o_orderkey % 8
             WHEN 0 THEN 'Applicant: ' || {_PIIX_NAME} || chr(10) || 'SSN ' || {_digits('o_custkey * 7', 3)} || '-' ||
                         {_digits('o_orderkey', 2)} || '-' || {_digits('o_orderkey * 3', 4)}
             WHEN 1 THEN 'Signed: ' || {_PIIX_NAME} || ', Ford dealership'
             WHEN 2 THEN 'By: ' || {_PIIX_NAME} || chr(10) || {_digits('o_orderkey', 5)} || '-' || {_digits('o_custkey', 4)}
             WHEN 3 THEN 'Dear ' || {_PIIX_NAME} || ', zip ' || {_digits('o_orderkey * 11', 5)}
             WHEN 4 THEN 'Name: ' || {_PIIX_NAME} || chr(10) || {_digits('o_orderkey', 3)} || '.555.' || {_digits('o_custkey', 4)}
             WHEN 5 THEN 'card ' || {_digits('o_orderkey', 4)} || ' 5678 ' || {_digits('o_custkey', 4)} || ' 9012'
             WHEN 6 THEN CAST(o_orderkey % 90 + 1 AS STRING) || ' Oak Street, mail c' || CAST(o_custkey AS STRING) || '@shop.org'
             ELSE '' END AS text
    FROM orders"""


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (document_id, page_no, text) of filled forms."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return o.selectExpr(*_select_list(PIIX_SQL))


def _select_list(sql: str) -> list[str]:
    """The expressions between SELECT and FROM (commas outside brackets separate them)."""
    body = sql[sql.index("SELECT") + 6:sql.rindex("FROM")]
    parts, depth, at = [], 0, 0
    for i, ch in enumerate(body):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0 and body.count("'", 0, i) % 2 == 0:
            parts.append(body[at:i].strip())
            at = i + 1
    return [*parts, body[at:].strip()]


# ------------------------------------------------------------------ LLM
# documents -> recorded model responses of the classification pass, by doc_id
LLM_TYPE_BY_LANG = {"en": "invoice", "fr": "promotion", "de": "credit_card", "es": "insurance"}


def _llm_type_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LLM_TYPE_BY_LANG.items())
    return f"CASE WHEN source = 'src7' THEN 'letter' ELSE CASE lang {whens} ELSE 'memo' END END"


LLM_CONTENT_SQL = f"""CASE WHEN doc_id % 11 = 0 THEN '{{"confidence": 0.7}}'
        WHEN doc_id % 13 = 0 THEN '42'
        WHEN doc_id % 17 = 0 THEN '"just a string"'
        WHEN doc_id % 7 = 0 THEN '{{"document_type": "receipt"}} trailing'
        WHEN doc_id % 5 = 0 THEN '{{"document_type": "' || {_llm_type_sql()} || '", "confidence": 0.9, "industry": "Banking"}}'
        WHEN doc_id % 5 = 1 THEN '{{"document_type": null, "confidence": 1.5}}'
        WHEN doc_id % 5 = 2 THEN '["invoice", "receipt"]'
        WHEN doc_id % 5 = 3 THEN 'This looks like an invoice.'
        ELSE NULL END"""
LLM_STATUS_SQL = ("CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 7 = 0 "
                  "OR doc_id % 5 <> 4 THEN 200 ELSE 429 END")


def llm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return d.select(F.col("doc_id").cast("string").alias("document_id"), "doc_id", "text", "lang", "source")


# what a second pass would answer, by doc_id
LLM_SECOND_SQL = """CASE WHEN doc_id % 9 = 0 THEN 'no answer'
        WHEN doc_id % 4 = 1 THEN '{"vendor_name":"V' || CAST(doc_id AS STRING)
             || '","invoice_number":17,"total_amount":"12.50","line_items":[{"description":"x","quantity":"1"}]}'
        WHEN doc_id % 4 = 2 THEN '{"offer_type":"card","bank_name":"B","fees":{"annual_fee":95,"late_payment_fee":"10"}}'
        ELSE '{"insurance_type":"life","insurance_company":null,"special_offers":"none"}' END"""
LLM_SECOND_STATUS_SQL = "CASE WHEN doc_id % 31 = 0 THEN 503 WHEN doc_id % 29 = 0 THEN 202 ELSE 200 END"


def _response(content: str, status: str) -> list:
    """(http_status, body) of a recorded answer."""
    env = F.to_json(F.struct(F.array(F.struct(F.struct(F.expr(content).alias("content")).alias("message")))
                             .alias("choices")))
    st = F.expr(status).cast("int")
    return [st.alias("http_status"), F.when(st == 200, env).otherwise(F.lit("rate limited")).alias("body")]


def _by_request(rows: DataFrame) -> DataFrame:
    """Documents with identical text share a request: the recorded response is
    the one of the smallest doc_id (explicit, not whichever row comes first)."""
    return (rows.groupBy("request_id").agg(F.min_by(F.struct("http_status", "body"), F.col("doc_id")).alias("r"))
            .select("request_id", "r.http_status", "r.body"))


def llm_recorded(spark: SparkSession, sf_dir: str, schema: dict) -> DataFrame:
    """Recorded responses of the classification pass, for the requests of documents with doc_id % 4 <> 0
    (the rest are pending)."""
    from doclake.operators import extract as X
    d = X.with_request(llm_documents(spark, sf_dir).where(F.col("doc_id") % 4 != 0), X.CLASSIFICATION, schema)
    return _by_request(d.select("request_id", "doc_id", *_response(LLM_CONTENT_SQL, LLM_STATUS_SQL)))


def llm_recorded_second(requests: DataFrame) -> DataFrame:
    """Recorded responses of the given second-pass requests (all of them)."""
    r = requests.select("request_id", F.col("document_id").cast("bigint").alias("doc_id"))
    return _by_request(r.select("request_id", "doc_id", *_response(LLM_SECOND_SQL, LLM_SECOND_STATUS_SQL)))


# ------------------------------------------------------------------ CFG
PII_FLAG = {"config_key": "pii_processing", "config_type": "feature_flag", "enabled": True,
            "s3_buckets": ["src1", "src3", "src5"]}
