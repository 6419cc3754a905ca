import corpus_pipeline
from doclake.llm import mixing, shards
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401


def test_places_are_worked_out_without_the_texts(docs, spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i} " * (i % 9), f"s{i % 3}") for i in range(400)]
    rows += [(None, f"no id {i}", None) for i in range(30)] + [(5, f"again {i}", "s1") for i in range(20)] + [(9, None, "s0")] * 3
    docs(rows).withColumn("shard", F.lit("own")).withColumn("file", F.lit("f")).write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    written, plain = [], shards.staged
    monkeypatch.setattr(shards, "staged", lambda df, name: written.append(df.columns) or plain(df, name))
    out = corpus_pipeline.sharding(spark, table, str(tmp_path))
    assert out.columns == [*table.columns, "_shard", "slot", "shard_bytes_before"]
    assert written and not any("text" in columns for columns in written)
    got = out.collect()
    assert sorted(map(str, [(r.doc_id, r.text, r.source) for r in got])) == sorted(map(str, rows))
    # the places of the rows that have an id of their own are those of the wide rows
    placed = mixing.interleave(table)
    old = shards.assign_shards(placed, shards.text_size(F.col("text")), [placed.columns[-1], "doc_id"], corpus_pipeline.N_SHARDS)
    alone = lambda r: r.doc_id not in (None, 5, 9)
    assert {r.doc_id: r["_shard"] for r in got if alone(r)} == {r.doc_id: r["_shard"] for r in old.collect() if alone(r)}
    for s in {r["_shard"] for r in got}:
        own = sorted((r for r in got if r["_shard"] == s), key=lambda r: r.slot)
        before = 0
        for k, r in enumerate(own):
            assert (r.slot, r.shard_bytes_before) == (k, before)
            before += len((r.text or "").encode()) + shards.ROW_OVERHEAD
