"""Running values along an order within keys, spread over range partitions.

A window over a key sends all its rows to one task. Here rows are sorted by
(keys, order) into range partitions, which cut a large key wherever its share
ends. Values run inside each (partition, key) segment first. Only the first
segment of a partition can go on from an earlier one, so one summary row per
partition (its first key, its last key and what the last key's segment comes
to) is folded along the partitions into one carry each, which a second pass
applies. A key with any share of the rows spreads over as many tasks, also
where all its rows fall into one moment.

The sorted rows are written to the shared folder of ``spark.checkpoint.dir``
first: range bounds come from a sample, so both passes must read the same
partitions, and so must a task that runs again.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.session import checkpoint_path

PART, SEQ = "_part", "_seq"


class Scan(NamedTuple):
    """A running value: ``op`` is 'sum', 'min' or 'last' (the last non-null one; wrap a nullable value in a struct).

    ``before``: of the rows before this one only.
    """

    name: str
    op: str
    value: Column
    before: bool = False


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once, and lost tasks read it again."""
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, keys: list[str], order: list[Column | str], keep: list[str] | None = None) -> DataFrame:
    """The rows in (keys, order), with their range partition ``_part`` and place ``_seq``; ``keep`` drops the others.

    Rows equal in keys and order stay in one partition: end the order with
    something that tells them apart if there may be many.
    """
    by = [*keys, *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(SEQ, F.monotonically_increasing_id())
    columns = df.columns if keep is None else keep
    return written(placed.select(*columns, F.shiftright(SEQ, 33).cast("long").alias(PART), SEQ), "ranged")


def _added(op: str, a, b):
    if a is None or b is None:
        return a if b is None else b
    return {"sum": lambda: a + b, "min": lambda: min(a, b), "last": lambda: b}[op]()


def _carries(rows: DataFrame, keys: list[str], scans: list[Scan]) -> DataFrame:
    """Per partition its first key (``_head``) and what that key's earlier partitions come to (one row each)."""
    spark = rows.sparkSession
    key = F.struct(*keys)
    found = rows.groupBy(PART).agg(F.min_by(key, SEQ).alias("_head"), F.max_by(key, SEQ).alias("_tail"))
    ends = spark.createDataFrame(found.collect(), found.schema)  # one row per partition
    whole = {"sum": lambda s: F.sum(s.value), "min": lambda s: F.min(s.value),
             "last": lambda s: F.max_by(s.value, F.when(s.value.isNotNull(), F.col(SEQ)))}
    last = rows.withColumn("_key", key).join(
        F.broadcast(ends.select(PART, "_tail")), PART).where(F.col("_key").eqNullSafe(F.col("_tail")))
    totals = last.groupBy(PART).agg(*[whole[s.op](s).alias(f"_c{i}") for i, s in enumerate(scans)])
    known = ends.join(totals, PART).orderBy(PART).collect()  # one row per partition
    out, tail, so_far = [], None, None
    for r in known:
        goes_on = tail is not None and tail == r["_head"]
        carry = so_far if goes_on else [None] * len(scans)
        begin = carry if r["_head"] == r["_tail"] else [None] * len(scans)
        so_far = [_added(s.op, begin[i], r[f"_c{i}"]) for i, s in enumerate(scans)]
        tail = r["_tail"]
        out.append((r[PART], r["_head"], *carry))
    types = dict(zip(totals.columns, totals.schema))
    schema = T.StructType([T.StructField(PART, T.LongType()), T.StructField("_head", ends.schema["_head"].dataType),
                           *[T.StructField(f"_c{i}", types[f"_c{i}"].dataType) for i in range(len(scans))]])
    return spark.createDataFrame(out, schema)


def scanned(rows: DataFrame, keys: list[str], scans: list[Scan]) -> DataFrame:
    """``ranged`` rows with the scans' columns."""
    carries = F.broadcast(_carries(rows, keys, scans))  # one row per range partition
    here = Window.partitionBy(PART, *keys).orderBy(SEQ)
    out = rows
    for i, s in enumerate(scans):
        frame = here.rowsBetween(Window.unboundedPreceding, -1 if s.before else 0)
        run = {"sum": F.sum, "min": F.min, "last": lambda v: F.last(v, ignorenulls=True)}[s.op](s.value)
        out = out.withColumn(f"_l{i}", run.over(frame))
    out = out.join(carries, PART, "left")
    first = F.struct(*keys).eqNullSafe(F.col("_head"))
    for i, s in enumerate(scans):
        local, carry = F.col(f"_l{i}"), F.when(first, F.col(f"_c{i}"))
        both = {"sum": lambda: F.coalesce(local + carry, local, carry), "min": lambda: F.least(local, carry),
                "last": lambda: F.coalesce(local, carry)}[s.op]()
        out = out.withColumn(s.name, both)
    return out.drop("_head", *[f"_{x}{i}" for i in range(len(scans)) for x in "lc"])


def plain(rows: DataFrame) -> DataFrame:
    """Without the helper columns of ``ranged``."""
    return rows.drop(PART, SEQ)


def positions(df: DataFrame, keys: list[str], order: list[Column | str], out: str,
              keep: list[str] | None = None) -> DataFrame:
    """``out``: 1-based place of each row within ``keys``."""
    return plain(scanned(ranged(df, keys, order, keep), keys, [Scan(out, "sum", F.lit(1).cast("long"))]))
