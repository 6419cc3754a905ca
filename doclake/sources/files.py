"""Readers for stored objects: text objects, OCR responses, result objects,
execution history, object listings and config tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import keys as K
from doclake.operators.pages import OCR_RESPONSE


def stored_key(root: str) -> Column:
    """A read file's key in its bucket: its path below ``root``, as the sinks and records write it."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # the same folder may be written with or without its scheme
    folder = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    # an object that ``write_objects`` wrote is a folder of one file
    return F.regexp_replace(F.substring_index(path, folder, -1), "object=([^/]+)/part-[^/]+$", "$1")


def write_objects(rows: DataFrame, root: str, prefix: str, name_col: str, value_col: str) -> None:
    """Write every row as an object of its own below ``prefix``: text ``value_col`` (a line end follows it) under the
    name ``name_col``. Spark names the files it writes, so an object is a folder ``object=<name>`` with one file;
    the readers of this module give it the key ``<prefix><name>``. The cost is one file per object, whatever its size,
    so the tasks are given in number: AQE would merge small rows into one task that writes all files."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows.select(F.col(value_col).alias("value"), F.col(name_col).alias("object")).repartition(parts, "object").write.mode(
        "overwrite").partitionBy("object").text(f"{root.rstrip('/')}/{prefix}")


def read_texts(spark: SparkSession, root: str, prefix: str = "staging/", glob: str = "*.txt") -> DataFrame:
    """Whole text objects of the bucket folder ``root`` as (text_key, text): one row per file."""
    df = (spark.read.option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).text(f"{root.rstrip('/')}/{prefix}", wholetext=True))
    return df.select(stored_key(root).alias("text_key"), F.col("value").alias("text"))


def texts_for_keys(keys: DataFrame, texts: DataFrame, key_col: str = "text_key",
                   missing_as_empty: bool = True) -> DataFrame:
    """Attach stored text to wanted keys; a missing object reads as '' (the PII
    reader's behaviour) or stays null."""
    j = keys.join(texts, key_col, "left")
    return j.withColumn("text", F.coalesce(F.col("text"), F.lit(""))) if missing_as_empty else j


def read_ocr_responses(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Stored OCR responses (JSON with ``Blocks``), schema given, no inference.
    Every part of a paginated result is a file; ``part_no`` is the number at
    the end of its name (0 without one), which orders the parts."""
    df = spark.read.schema(OCR_RESPONSE).option("recursiveFileLookup", "true").json(f"{root.rstrip('/')}/{prefix}")
    key = stored_key(root)
    part = F.regexp_extract(key, r"(\d+)\.[^./]*$", 1)
    return df.select(key.alias("response_key"), F.coalesce(part.try_cast("int"), F.lit(0)).alias("part_no"), "Blocks")


def read_results(spark: SparkSession, root: str, prefix: str = "results/", schema: str | None = None) -> DataFrame:
    """Result objects with their key, joinable on a record's ``result_key``."""
    r = spark.read.option("recursiveFileLookup", "true")
    if schema:
        r = r.schema(schema)
    df = r.option("multiLine", True).json(f"{root.rstrip('/')}/{prefix}")
    return df.withColumn("result_key", stored_key(root))


def results_for_documents(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Documents with the stored result of their ``result_key`` (null columns without one)."""
    return docs.join(results, "result_key", "left")


HISTORY_TYPES = ("TaskStateEntered", "TaskSucceeded", "TaskFailed")


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Execution history rows of the kept event types (the filter reaches the scan)."""
    return spark.read.format(fmt).load(path).where(F.col("type").isin(*HISTORY_TYPES))


def list_objects(spark: SparkSession, root: str, prefix: str = K.INCOMING_PREFIX) -> DataFrame:
    """Object listing of one folder level under ``prefix``; nothing outside the prefix is listed and no contents are
    read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/{prefix}")
             .select("path", "modificationTime", "length"))
    key = F.regexp_extract(F.col("path"), "(" + prefix + ".*)$", 1)
    return (files.select(key.alias("object_key"), F.col("modificationTime").alias("event_time"),
                         F.col("length").alias("size"))
            .where(K.in_listing_folder(F.col("object_key"), prefix)))


def read_config(spark: SparkSession, path: str, key: str, kind: str, fmt: str = "json") -> DataFrame:
    """Config rows of one (config_key, config_type); a small dimension table."""
    return (spark.read.format(fmt).load(path)
            .where((F.col("config_key") == key) & (F.col("config_type") == kind)))
