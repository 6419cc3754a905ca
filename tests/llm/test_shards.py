import zlib

from pyspark.sql import functions as F

from doclake.llm import shards

from llm_helpers import clash, docs  # noqa: F401


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[4], r[5]))


def test_against_prefix_sums(docs):
    rows = [(i, "é" * ((i * 37) % 211)) for i in range(500)] + [(500, None), (501, "")]
    got = rows_of(shards.shard_table(docs(rows, 7), 9))
    total = sum(len((t or "").encode()) + 16 for _, t in rows)
    before, want, slots = 0, [], {}
    for i, t in rows:
        size = len((t or "").encode()) + 16
        s = min(8, (2 * before + size) * 9 // (2 * total))
        want.append((i, size, zlib.crc32((t or "").encode()), "bytes", s, slots.setdefault(s, 0), None))
        slots[s] += 1
        before += size
    assert got == want
    per = [sum(r[1] for r in got if r[4] == s) for s in range(9)]
    assert max(per) - min(per) <= 2 * max(r[1] for r in got)


def test_same_key_in_many_rows_stays_whole(docs):
    got = rows_of(shards.shard_table(docs([(7, "x" * 50)] * 300 + [(None, "y")] * 10, 5), 4))
    assert len(got) == 310 and [r[0] for r in got[:10]] == [None] * 10
    for s in range(4):
        assert [r[5] for r in got if r[4] == s] == list(range(sum(r[4] == s for r in got)))


def test_empty_and_clashing_columns(docs, tmp_path, spark):
    assert shards.shard_table(docs([]), 4).collect() == []
    df = clash(docs([(i, "abc") for i in range(20)]), "shard", "slot", "sz", "rid", "part")
    out = shards.assign_shards(df, shards.text_size(F.col("text")), "doc_id", 3)
    assert out.columns == [*df.columns, "_shard", "_slot", "shard_bytes_before"]
    assert out.where("shard = 'extra'").count() == 20
    plain = shards.assign_shards(docs([(i, "abc") for i in range(20)]), shards.text_size(F.col("text")), "doc_id", 3)
    shards.write_shards(plain, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 3
