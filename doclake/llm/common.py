"""Helpers the operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from doclake.session import checkpoint_path

# Arrow batches handed to a Python worker are cut at this many bytes, so that a
# batch of very long texts stays as small as one of short texts.
ARROW_BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes (not only the rows) of the batches that Python tasks receive."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    return checkpoint_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage: later jobs read the files and survive the loss of any
    executor. Used where a result is read more than once.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out
