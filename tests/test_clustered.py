import random

import pytest
from pyspark.sql import functions as F

from doclake.operators import clustered as CL

BY = ["created_at", "document_id"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rnd = random.Random(3)
    rows = [(f"d{i:05d}", rnd.choice(["A", "A", "B", None]), rnd.choice([None, *(f"2026-01-{k:02d}" for k in range(1, 29))])) for i in range(3000)]
    path = str(tmp_path_factory.mktemp("clustered") / "state")
    CL.write_clustered(spark.createDataFrame(rows, "document_id string, status string, created_at string"), path, BY, "status",
                       descending=True, files=20, bloom=("document_id",))
    return path, [(d, s, c or "") for d, s, c in rows]


def files_read(df):
    return df.select(F.input_file_name().alias("f")).distinct().count()


@pytest.mark.parametrize("status", ["A", "B", None])
def test_every_page_in_order_from_few_files(spark, table, status):
    path, rows = table
    want = sorted([r for r in rows if r[1] == status], key=lambda r: r[0])
    want.sort(key=lambda r: r[2], reverse=True)
    got, after = [], None
    for k in range(6):
        page = CL.page(spark, path, BY, "status", status, True, 100, after)
        assert files_read(page) <= 6
        rows_of = [tuple(r) for r in page.select("document_id", "status", "created_at").collect()]
        got += rows_of
        after = (rows_of[-1][2], rows_of[-1][0])
    assert got == want[:600]


def test_pages_of_one_sort_value_that_fills_many_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    ids = [f"d{i:05d}" for i in range(1500)]
    random.Random(2).shuffle(ids)
    CL.write_clustered(spark.createDataFrame([(i, "2026-01-01") for i in ids], "document_id string, created_at string"), path, BY, files=12)
    after, got = None, []
    for _ in range(20):
        page = CL.page(spark, path, BY, limit=50, after=after)
        assert files_read(page) <= 3
        got += [r.document_id for r in page.collect()]
        after = ("2026-01-01", got[-1])
    assert got == sorted(ids)[:1000]


def test_a_page_behind_the_end_is_empty(spark, table):
    path, rows = table
    assert CL.page(spark, path, BY, "status", "A", True, 10, ("", "zzz")).collect() == []
    assert CL.page(spark, path, BY, "status", "nowhere", True, 10).collect() == []


def test_lookup_opens_one_file_a_key(spark, tmp_path):
    ids = [f"d{i:05d}" for i in range(2000)]
    random.Random(1).shuffle(ids)
    path = str(tmp_path / "by_id")
    CL.write_clustered(spark.createDataFrame([(i, f"f{i}") for i in ids], "document_id string, original_filename string"), path,
                       ["document_id", "original_filename"], files=16, bloom=("original_filename",))
    found = CL.lookup(spark, path, "document_id", ["d00007", "d01999", "d99999", "aaa"])
    assert sorted(r.document_id for r in found.collect()) == ["d00007", "d01999"] and files_read(found) <= 2
    assert CL.lookup(spark, path, "document_id", ["zzz"]).collect() == []
