"""Model calls that survive a failed call: requests in, answers or dead letters out.

Requests arrive as a stream. Every micro-batch writes the answers of each
attempt as a table of its own before the next attempt starts, keyed by batch,
attempt and request id. A call that fails is a row with its error and is tried
again with the next attempt; after the last one the request is a dead letter.
A batch that is run again reads the attempts it finished and calls only what
is left, and a request that any earlier batch answered is not called again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALLS = "request_id string, http_status int, body string, error string"


def _guarded(call: Callable[[str, str], tuple[int, str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for request, payload in zip(b["request_id"], b["payload"]):
                try:
                    status, body = call(request, payload)
                    out.append((request, int(status), body, None))
                except Exception as e:  # a provider may raise anything; the other calls' answers are kept
                    out.append((request, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["request_id", "http_status", "body", "error"]).astype({"http_status": "Int32"})
    return run


def _calls(spark: SparkSession, root: str) -> DataFrame:
    columns = "batch_id long, attempt int"
    try:
        return spark.read.schema(f"{CALLS}, {columns}").parquet(f"{root}/calls")
    except AnalysisException:  # no call was made yet
        return spark.createDataFrame([], f"{CALLS}, {columns}")


def answers(spark: SparkSession, root: str) -> DataFrame:
    """``request_id, http_status, body, attempt`` of every answered request."""
    return _calls(spark, root).where("error is null").select("request_id", "http_status", "body", "attempt")


def dead_letters(spark: SparkSession, root: str, attempts: int = 3) -> DataFrame:
    """``request_id, error`` of the requests whose last attempt failed."""
    calls = _calls(spark, root)
    failed = calls.where((F.col("attempt") == attempts) & F.col("error").isNotNull())
    return failed.join(calls.where("error is null").select("request_id"), "request_id", "left_anti").groupBy(
        "request_id").agg(F.max_by("error", "batch_id").alias("error"))


def answer_batches(call: Callable[[str, str], tuple[int, str]], root: str, attempts: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream of ``request_id, payload``; ``call`` returns (http_status, body)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wanted = batch.groupBy("request_id").agg(F.min("payload").alias("payload"))  # equal ids have equal payloads
        wanted.persist()
        try:
            finished = {r["attempt"] for r in _calls(spark, root).where(F.col("batch_id") == batch_id).select("attempt").distinct().collect()}
            for attempt in range(1, attempts + 1):
                if attempt in finished:
                    continue
                left = wanted.join(answers(spark, root).select("request_id"), "request_id", "left_anti")
                left.mapInPandas(_guarded(call), CALLS).write.mode("overwrite").parquet(
                    f"{root}/calls/batch_id={batch_id}/attempt={attempt}")
                if not _calls(spark, root).where((F.col("batch_id") == batch_id) & (F.col("attempt") == attempt)
                                                 & F.col("error").isNotNull()).limit(1).count():
                    break
        finally:
            wanted.unpersist()
    return run
