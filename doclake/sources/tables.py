"""Parquet table access for the driver-provided test tables (and any folder
laid out the same way: one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# A session setting of the caller, unset by default: deal the rows of every table
# read here over this many partitions. For tables written as one row group,
# which a scan cannot split.
SCAN_PARTITIONS = "spark.doclake.scanPartitions"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; selecting ``columns`` here keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df
