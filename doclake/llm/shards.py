"""Contiguous shards of equal byte size from global prefix sums.

Rows are range-partitioned by the order column (or columns) and sorted inside
their partition. Each partition adds up its own sizes; the per-partition totals (one
row per partition) turn into offsets, so a row's global position in bytes is
the partition's offset plus its own running sum. A row belongs to the shard
in which the middle of its bytes lies: shards are contiguous, and each is
within the size of one row of ``total / n_shards``.

Defined cases: a null text counts as no bytes; a null key sorts first; rows
with equal keys are ordered by a row number of the scan, so that a key with
many rows still spreads over partitions; an empty table gives no rows; all
other columns pass through under their own names, also if they clash with the
output columns (those then get a ``_`` in front); with fewer rows than shards
some shards stay empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fresh, staged

ROW_OVERHEAD = 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus a fixed overhead per row; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def assign_shards(df: DataFrame, size: Column, key: str | list[str] = "doc_id", n_shards: int = 40) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1), ``slot`` (gapless in the shard) and ``shard_bytes_before``."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else key
    bounded_batches(spark)
    shard, slot, before, rid, sz, part, run, row = fresh(
        df, "shard", "slot", "shard_bytes_before", "rid", "sz", "part", "run", "row")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (df.withColumn(sz, size.cast("long")).withColumn(rid, F.monotonically_increasing_id())
              .repartitionByRange(parts, *keys, rid)
              .sortWithinPartitions(*keys, rid))
    schema = T.StructType([f for f in ranged.schema if f.name != rid]
                          + [T.StructField(n, T.LongType()) for n in (part, run, row)])
    kept = [f.name for f in ranged.schema if f.name != rid]

    def running(batches):
        from pyspark import TaskContext

        pid, total, rows = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            if b.num_rows == 0:
                continue
            sizes = b.column(sz).to_numpy(zero_copy_only=False).astype("int64")
            cum = np.cumsum(sizes) + total
            cols = [b.column(c) for c in kept] + [
                pa.array(np.full(b.num_rows, pid, "int64")), pa.array(cum - sizes),
                pa.array(np.arange(rows, rows + b.num_rows, dtype="int64"))]
            total, rows = int(cum[-1]), rows + b.num_rows
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, part, run, row])

    local = staged(ranged.mapInArrow(running, schema), "shard-runs")
    # one row per partition: small whatever the table's size
    totals = local.groupBy(part).agg(F.sum(sz).alias("b"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(part).alias("p"), F.coalesce(F.sum("b").over(w), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"),
        F.sum("b").over(Window.orderBy(F.lit(1)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    placed = (local.join(F.broadcast(offsets), F.col(part) == F.col("p"))
              .withColumn(before, F.col("b0") + F.col(run))
              .withColumn(row, F.col("n0") + F.col(row))
              .withColumn(shard, F.least(
                  F.lit(n_shards - 1),
                  F.floor(F.expr(f"((2 * `{before}` + `{sz}`) * {n_shards}) div greatest(2 * total, 1)"))).cast("int")))
    firsts = placed.groupBy(F.col(shard).alias("s")).agg(F.min(row).alias("r0"), F.min(before).alias("c0"))
    return (placed.join(F.broadcast(firsts), F.col(shard) == F.col("s"))
            .withColumn(slot, F.col(row) - F.col("r0"))
            .withColumn(before, F.col(before) - F.col("c0"))
            .select(*[c for c in kept if c != sz], shard, slot, before))


def write_shards(df: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows in slot order, as Parquet."""
    (df.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot)
     .write.partitionBy(shard).parquet(path))


def shard_table(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Per document: size, checksum and place; the text itself does not move."""
    text = F.col("text")
    slim = docs.select(
        "doc_id", text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    out = assign_shards(slim, F.col("size"), "doc_id", n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
