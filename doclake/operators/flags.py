"""Configuration flags: a small (config_key, config_type) dimension table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLAG_SCHEMA = ("config_key string, config_type string, enabled boolean, "
               "s3_buckets array<string>, document_types array<string>, "
               "confidence_threshold string, redaction_method string")


def flag_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    cols = [c.split()[0] for c in FLAG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], FLAG_SCHEMA)


def read_flag(flags: DataFrame, key: str, kind: str):
    """The one row of a (key, type) pair, or None. The pair is the table's key,
    so at most one row reaches the driver."""
    rows = flags.where((F.col("config_key") == key) & (F.col("config_type") == kind)).take(1)
    return rows[0].asDict() if rows else None


def pii_enabled(bucket: Column, flag: dict | None) -> Column:
    """enabled AND (no bucket list OR bucket listed); a missing flag or a
    missing ``enabled`` is off. The flag becomes literals: no join."""
    if not flag or not flag.get("enabled"):
        return F.lit(False)
    buckets = flag.get("s3_buckets") or []
    if not buckets:
        return F.lit(True)
    return F.coalesce(bucket.isin(*buckets), F.lit(False))
