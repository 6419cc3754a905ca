"""Page batching: group page arrivals of one base name into one document.

A batch closes when no page of that base name arrives for ``gap`` (each new
page resets the wait). A stream uses the engine's session window (with a
watermark bounding the state). A static table is scanned in range partitions
of (base name, time), so a base name with any share of the arrivals spreads
over tasks, also where they fall into one moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.operators.scan import Scan, ranged, scanned

DEFAULT_GAP = "3 seconds"


def page_batches(arrivals: DataFrame, gap: str = DEFAULT_GAP, base_col: str = "base_name",
                 time_col: str = "event_time", id_col: str = "object_id") -> DataFrame:
    """One row per batch: base, batch_start (first arrival), batch_end (last
    arrival + gap), n_pages. Works for batch and streaming inputs."""
    # a zone-less column is read as session-zone time; a timestamp column is
    # used as is so a watermark defined on it stays attached
    is_ts = isinstance(arrivals.schema[time_col].dataType, T.TimestampType)
    t = F.col(time_col) if is_ts else F.col(time_col).cast("timestamp")
    if not arrivals.isStreaming:
        return _chained(arrivals.select(F.col(base_col), F.unix_micros(t).alias("_t"), F.col(id_col).alias("_id")),
                        base_col, gap)
    g = arrivals.groupBy(F.col(base_col), F.session_window(t, gap).alias("w")).agg(
        F.count(F.col(id_col)).cast("bigint").alias("n_pages"))
    return g.select(base_col, F.col("w.start").cast("timestamp_ntz").alias("batch_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("batch_end"), "n_pages")


def _chained(rows: DataFrame, base: str, gap: str) -> DataFrame:
    """Two segmented scans: the arrival before tells where a batch opens, the last opening which batch a page is in."""
    wait = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {gap})")
    placed = ranged(rows.where(F.col("_t").isNotNull()), [base], ["_t", "_id"])
    before = scanned(placed, [base], [Scan("_before", "last", F.col("_t"), before=True)])
    opens = F.when(F.col("_before").isNull() | (F.col("_t") - F.col("_before") >= wait), F.col("_t"))
    batch = scanned(before.withColumn("_opens", opens), [base], [Scan("_start", "last", F.col("_opens"))])
    return batch.groupBy(base, "_start").agg(F.max("_t").alias("_last"), F.count("_id").cast("bigint").alias("n_pages")).select(
        base, F.timestamp_micros("_start").cast("timestamp_ntz").alias("batch_start"),
        F.timestamp_micros(F.col("_last") + wait).cast("timestamp_ntz").alias("batch_end"), "n_pages")
