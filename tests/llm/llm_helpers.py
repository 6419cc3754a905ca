"""Fixtures and helpers of the tests in this folder."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Make a documents table of (doc_id, text[, source]) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


def clash(df, *names):
    """``df`` with extra columns of the given names."""
    for n in names:
        df = df.withColumn(n, F.lit("extra"))
    return df
