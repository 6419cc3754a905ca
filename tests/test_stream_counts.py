import os

from doclake.plans import queries_streams as ST


def written_by(files):
    """The tasks that wrote the part files."""
    return {os.path.basename(f).split("-")[1] for f in files}


def test_messages_are_written_by_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    row = "bigint, l_linenumber bigint, l_partkey bigint, l_returnflag string, l_linestatus string"
    spark.createDataFrame([(i // 4, i % 4 + 1, i, "ANR"[i % 3], "OF"[i % 2]) for i in range(600)], f"l_orderkey {row}").repartition(
        6).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, plain = [], ST.J.object_arrivals

    def arrivals(session, folder, **options):
        seen.append(len(written_by(f.path for f in session.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect())))
        return plain(session, folder, **options)
    monkeypatch.setattr(ST.J, "object_arrivals", arrivals)
    split = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "1500"}
    before = {k: spark.conf.get(k) for k in split}
    for k, v in split.items():
        spark.conf.set(k, v)
    try:
        r = ST.stream_counts(spark, str(tmp_path)).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert r.n_rows == 600 == r.main_rows + r.quarantine_rows and r.n_quarantined == r.quarantine_rows
    assert min(seen) > 4
