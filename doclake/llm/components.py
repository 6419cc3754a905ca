"""Connected components of a link table by alternating star contraction.

Both steps are grouped minima and joins on a node, so no component is ever
gathered in one place; a hub's links are only streamed past its minimum. Every
round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _checked(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    out = staged(edges.distinct(), name)
    row = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return out, tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` -> ``(node, root)`` for every linked node that isn't its component's smallest."""
    edges, seen = _checked(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    while seen[0]:
        sym = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        low = low.select("n", F.least("n", "m").alias("m"))
        # every larger neighbour of a node moves to the node's minimum
        large = (edges.select(F.col("v").alias("n"), F.col("u").alias("far")).join(low, "n")
                 .select(F.col("far").alias("u"), F.col("m").alias("v")).where("u <> v")).distinct()
        # then every smaller neighbour, and the node itself
        down = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = (large.withColumnRenamed("u", "n").join(down, "n")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("n").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v"))
        edges, now = _checked(small, "stars")
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
