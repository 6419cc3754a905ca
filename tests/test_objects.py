import os

from doclake.sources import files as FS


def written_by(files):
    """The tasks that wrote the part files."""
    return {os.path.basename(f).split("-")[1] for f in files}


def test_small_objects_are_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        rows = spark.createDataFrame([(f"{i}.txt", f"text {i}") for i in range(60)], "name string, body string")
        FS.write_objects(rows, str(tmp_path), "staging/", "name", "body")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = [str(f) for f in tmp_path.rglob("part-*")]
    assert len(files) == 60 and len(written_by(files)) == 5
    got = {r.text_key: r.text for r in FS.read_texts(spark, str(tmp_path)).collect()}
    assert got == {f"staging/{i}.txt": f"text {i}\n" for i in range(60)}
