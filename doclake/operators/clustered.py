"""A table laid out for pages and lookups: range-sorted files with an index of what each holds.

Files are range-partitioned and sorted by the columns that pages follow, so
every file covers one span of them. The index has one row per file and group
(first and last key, number of rows). A page, wherever it starts, reads the
index and the few files its rows are in; a lookup by key reads the files whose
span holds it. Bloom filters let a lookup by another column skip row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _order(by: list[str], descending: bool) -> list[Column]:
    """The first column in the given direction, the others rising (ties)."""
    return [F.col(by[0]).desc() if descending else F.col(by[0]).asc(), *[F.col(c).asc() for c in by[1:]]]


def write_clustered(df: DataFrame, path: str, by: list[str], group: str | None = None, descending: bool = False,
                    files: int | None = None, bloom: tuple[str, ...] = ()) -> None:
    """Write ``df`` sorted by ``by`` (missing values first as '', like the list's order), and its index beside it.

    ``group``: a column that pages are filtered by; rows are counted per value of it. ``files``: how many files (by
    default as many as the shuffle has partitions).
    """
    rows = df.withColumn(by[0], F.coalesce(F.col(by[0]).cast("string"), F.lit("")))
    order = _order(by, descending)
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    w = dealt.sortWithinPartitions(*order).write.mode("overwrite")
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
    g = (F.col(group) if group else F.lit(None)).cast("string")
    narrow = df.sparkSession.read.schema(rows.schema).parquet(path).select(
        F.col("_metadata.file_path").alias("file"), g.alias("value"), F.col(by[0]).alias("k"), F.col(by[1]).cast("string").alias("i"))
    here = narrow.groupBy("file", "value").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n"))
    first, last = ("high", "low") if descending else ("low", "high")
    # one row per file and group: where its rows begin and end in the order
    ends = narrow.alias("r").join(here.alias("h"), F.expr("r.file = h.file and r.value <=> h.value and r.k in (h.low, h.high)")).groupBy(
        "h.file", "h.value", "low", "high", "n").agg(F.min(F.when(F.col("k") == F.col(first), F.col("i"))).alias("first_id"),
                                                    F.max(F.when(F.col("k") == F.col(last), F.col("i"))).alias("last_id"))
    ends.withColumn("descending", F.lit(descending)).write.mode("overwrite").parquet(f"{path}_index")


def page(spark: SparkSession, path: str, by: list[str], group: str | None = None, value: str | None = None,
         descending: bool = False, limit: int = 50, after: tuple | None = None) -> DataFrame:
    """The ``limit`` rows of a group that follow the key ``after`` (sort value, id); reads the files they are in.

    File names number the range partitions, so they are in the order's order. Files that end before the key hold
    nothing of the page, and of those behind it as many are read as hold enough rows.
    """
    def behind(key: str, i: str) -> Column:
        if after is None:
            return F.lit(True)
        beyond = F.col(key) < after[0] if descending else F.col(key) > after[0]
        return beyond | ((F.col(key) == after[0]) & (F.col(i) > after[1]))
    first, last = ("high", "low") if descending else ("low", "high")
    index = spark.read.parquet(f"{path}_index").where(F.col("value").eqNullSafe(F.lit(value if group else None).cast("string")))
    spans = index.where(behind(last, "last_id")).withColumn("whole", behind(first, "first_id")).orderBy("file").limit(limit + 1)
    files, enough = [], 0
    for r in spans.collect():  # at most ``limit + 1`` files: each but the first holds only rows behind the key
        if enough >= limit:
            break
        files.append(r["file"])
        enough += r["n"] if r["whole"] else 0
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    d = spark.read.schema(schema).parquet(*files)
    if group:
        d = d.where(F.col(group).eqNullSafe(F.lit(value)))
    return d.where(behind(by[0], by[1])).orderBy(*_order(by, descending)).limit(limit)


def lookup(spark: SparkSession, path: str, column: str, keys: list[str]) -> DataFrame:
    """Rows of a table clustered by ``column`` with one of the few ``keys``, from the files whose span holds one."""
    holds = F.lit(False)
    for k in keys:
        holds = holds | F.lit(k).between(F.col("low"), F.col("high"))
    files = [r["file"] for r in spark.read.parquet(f"{path}_index").where(holds).select("file").distinct().collect()]
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(column).isin(*keys))
