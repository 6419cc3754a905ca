"""Registered change-log and batching queries (CHG, SESS bindings)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import lifecycle as LC
from doclake.operators import state as ST
from doclake.plans import bindings as B
from doclake.session import checkpoint_path
from doclake.streaming import batching as BT

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DTS = "'%Y-%m-%d %H:%M:%S'"
US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUS = "'%Y-%m-%d %H:%M:%S.%f'"
ATTRS = list(B.CHANGE_ATTR.values())


def state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per document from the attribute change log (E4, A23, A27, I7 batch)."""
    f = ST.fold_changes(B.changes(spark, sf_dir), ATTRS)
    return f.select("document_id", *ATTRS, F.date_format("updated_at", US_FMT).alias("updated_at"))


def state_fold_sql() -> str:
    cols = ", ".join(
        f"arg_max_null(value, (ts, seq)) FILTER (WHERE attr = '{a}' AND (value IS NOT NULL OR set_null)) AS {a}"
        for a in ATTRS)
    return f"""
    SELECT document_id, {cols}, strftime(max(ts), {DUS}) AS updated_at
    FROM ({B.CHANGES_SQL}) GROUP BY document_id"""


def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state from batches of the change log, each folded into the buckets it touches (A23, E4): three batches
    in no order of time, the last one handed in twice."""
    log = B.changes(spark, sf_dir)
    path = checkpoint_path(spark, f"state-{uuid.uuid4().hex}")
    for batch in (1, 2, 0, 0):
        ST.upsert_state(log.where(F.col("seq") % 3 == batch), path, ATTRS, batch, buckets=16)
    return ST.read_state(spark, path, ATTRS).select("document_id", *ATTRS, F.date_format("updated_at", US_FMT).alias("updated_at"))


# the status that an event asks for: mostly the next one of a run, sometimes any
_ASKED = "CASE WHEN event_id % 23 = 0 THEN NULL ELSE CASE (event_id * 7 + user_id) % 9 " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate([*LC.STATUSES[1:], "OCR_RUNNING"])) + " ELSE 'UNKNOWN' END END"


def state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every status change with the status before it, whether the lifecycle allows it, and the status after."""
    ev = B.table(spark, sf_dir, "events", "event_id", "ts", "user_id").selectExpr(
        "CAST(user_id % 40 AS STRING) AS document_id", "event_id AS seq", "ts", f"{_ASKED} AS status")
    return LC.transitions(ev).select("document_id", "seq", "status", "from_status", "legal", "to_status")


def state_transitions_sql() -> str:
    # the lifecycle applied change by change: its state is folded over the document's list of changes
    allowed = " OR ".join(f"(st = '{a}' AND x IN ({', '.join(repr(t) for t in to)}))" for a, to in LC.STEPS.items())
    return f"""
    WITH RECURSIVE c AS (SELECT CAST(user_id % 40 AS VARCHAR) AS document_id, event_id AS seq, ts, {_ASKED} AS status FROM events),
    l AS (SELECT document_id, list(coalesce(status, '') ORDER BY ts, seq) AS xs, list(seq ORDER BY ts, seq) AS seqs
          FROM c GROUP BY document_id),
    r AS (
      SELECT document_id, xs, seqs, 1 AS i, '{LC.NEW}' AS st FROM l
      UNION ALL
      SELECT document_id, xs, seqs, i + 1, CASE WHEN {allowed} THEN x ELSE st END
      FROM (SELECT *, xs[i] AS x FROM r) WHERE i <= len(xs)),
    s AS (SELECT document_id, seqs[i] AS seq, nullif(xs[i], '') AS x, st FROM r WHERE i <= len(xs))
    SELECT document_id, seq, x AS status, st AS from_status, x IS NULL OR ({allowed}) IS NOT DISTINCT FROM true AS legal,
           CASE WHEN {allowed} THEN x ELSE st END AS to_status FROM s"""


def _polls(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    return ev.select(F.col("user_id").cast("string").alias("document_id"), F.col("event_id").alias("seq"),
                     "ts", F.floor(F.col("value") / 100).cast("bigint").alias("polled"))


def change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each poll saw a different value than the previous poll (E5, I8 batch)."""
    return ST.change_flags(_polls(spark, sf_dir), "polled").select("document_id", "seq", "polled", "changed")


def change_detect_sql() -> str:
    return """
    SELECT document_id, seq, polled,
           (lag(seq) OVER w IS NULL) OR (polled IS DISTINCT FROM lag(polled) OVER w) AS changed
    FROM (SELECT CAST(user_id AS VARCHAR) AS document_id, event_id AS seq, ts,
                 CAST(floor(value / 100) AS BIGINT) AS polled FROM events)
    WINDOW w AS (PARTITION BY document_id ORDER BY ts, seq)"""


def _batches(spark, sf_dir, gap):
    ev = B.table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    arrivals = ev.select(F.col("user_id").cast("string").alias("base_name"),
                         F.col("event_id").alias("object_id"), F.col("ts").alias("event_time"))
    s = BT.page_batches(arrivals, gap)
    return s.select("base_name", F.date_format("batch_start", US_FMT).alias("batch_start"),
                    F.date_format("batch_end", US_FMT).alias("batch_end"), "n_pages")


def _batches_sql(gap_seconds: int) -> str:
    return f"""
    WITH a AS (SELECT CAST(user_id AS VARCHAR) AS base_name, ts FROM events),
    f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                          OR ts >= lag(ts) OVER w + INTERVAL {gap_seconds} SECOND THEN 1 ELSE 0 END AS nb
          FROM a WINDOW w AS (PARTITION BY base_name ORDER BY ts)),
    g AS (SELECT *, sum(nb) OVER (PARTITION BY base_name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
    SELECT base_name, strftime(min(ts), {DUS}) AS batch_start,
           strftime(max(ts) + INTERVAL {gap_seconds} SECOND, {DUS}) AS batch_end,
           CAST(count(*) AS BIGINT) AS n_pages
    FROM g GROUP BY base_name, sid"""


def page_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page batching with the 3-second gap window per base name (I2, batch form)."""
    return _batches(spark, sf_dir, "3 seconds")


def page_batches_sql() -> str:
    return _batches_sql(3)


def page_batches_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with a 6-hour gap, where arrivals do chain into batches."""
    return _batches(spark, sf_dir, "6 hours")


def page_batches_6h_sql() -> str:
    return _batches_sql(6 * 3600)
