"""The corpus pipeline: every stage works on what its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``; the last adds the shard and the
place in it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import decontaminate, mixing, repetition, shards, simhash
from doclake.llm.common import fresh, staged, table

N_SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return repetition.drop_repetitive(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays (3-word shingles, 3 bits)."""
    return simhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair schedule; a source that runs out leaves it."""
    return mixing.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of equal bytes in the order of the mix, with the place of every document.

    The places are worked out on narrow rows; a row is its file and its number there, and each text moves once.
    Documents that are not read from Parquet files are written first."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = staged(docs, "unplaced")
    file, row, size = fresh(docs, "file", "row", "size")
    read = docs.metadataColumn("_metadata")
    keyed = docs.withColumns({file: F.xxhash64(read["file_path"]), row: read["row_index"]})
    narrow = keyed.select("doc_id", "source", file, row, shards.text_size(F.col("text")).alias(size))
    placed = mixing.interleave(narrow)  # all rows are there, so these are the slots of the stage before
    places = shards.assign_shards(placed, F.col(size), [placed.columns[-1], "doc_id"], N_SHARDS)
    names = fresh(docs, "shard", "slot", "shard_bytes_before")
    places = places.select(file, row, *[F.col(c).alias(n) for c, n in zip(places.columns[-3:], names)])
    # never broadcast: there is a row per document
    return keyed.join(places.hint("merge"), [file, row]).select(*[F.col(f"`{c}`") for c in docs.columns], *names)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# XXH64 fingerprints and their components have no SQL form; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None
