import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from doclake.session import checkpoint_path
from doclake.streaming import jobs as J
from doclake.streaming.batching import page_batches

T0 = dt.datetime(2026, 1, 1, 12, 0, 0)

# arrival offsets (s) per scenario -> expected page counts of the batches (gap 3 s)
SCENARIOS = {
    "single": ([0], [1]),
    "sequential": ([0, 2], [2]),
    "simultaneous": ([0, 0.1, 0.2], [3]),
    "split": ([0, 5], [1, 1]),
    "chain": ([0, 2, 4], [3]),
}


def _arrivals():
    rows = []
    for base, (offsets, _) in SCENARIOS.items():
        for i, off in enumerate(offsets):
            rows.append((f"incoming/{base}-{i + 1}.png", "image/png", T0 + dt.timedelta(seconds=off), "b"))
    return rows


def test_page_batches_static(spark):
    df = spark.createDataFrame(_arrivals(), J.MANIFEST_DDL)
    parsed = df.selectExpr("object_key", "event_time", "split(split(object_key, '/')[1], '-')[0] AS base_name")
    got = {}
    for r in page_batches(parsed, "3 seconds", id_col="object_key").collect():
        got.setdefault(r.base_name, []).append((r.batch_start, r.n_pages))
    for base, (_, expected) in SCENARIOS.items():
        assert [n for _, n in sorted(got[base])] == expected, base
    chain_end = [r for r in page_batches(parsed, "3 seconds", id_col="object_key").collect()
                 if r.base_name == "chain"][0].batch_end
    assert chain_end == T0 + dt.timedelta(seconds=7)


def _write_stream_files(folder, rows):
    """One JSON file per arrival, modification times in arrival order."""
    os.makedirs(folder, exist_ok=True)
    for i, (key, ctype, ts, bucket) in enumerate(sorted(rows, key=lambda r: r[2])):
        p = os.path.join(folder, f"a{i:04d}.json")
        with open(p, "w") as fh:
            fh.write(json.dumps({"object_key": key, "content_type": ctype,
                                 "event_time": ts.isoformat(), "bucket": bucket}))
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))


def _run(df, name, mode="append"):
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint_path(spark, f"test-{name}-{uuid.uuid4().hex}"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def test_page_batches_stream_matches_static(spark, tmp_path):
    rows = _arrivals() + [("incoming/heartbeat-1.png", "image/png", T0 + dt.timedelta(seconds=60), "b")]
    _write_stream_files(str(tmp_path / "in"), rows)
    stream = J.object_arrivals(spark, str(tmp_path / "in"), max_files_per_trigger=3)
    out = _run(J.batch_pages(stream, "3 seconds", watermark="0 seconds"), "pb_stream")
    got = {}
    for r in out.collect():
        got.setdefault(r.base_name, []).append((r.batch_start, r.n_pages))
    for base, (_, expected) in SCENARIOS.items():
        assert [n for _, n in sorted(got[base])] == expected, base


def test_eager_batches_stream(spark, tmp_path):
    keep = ("single", "sequential", "split")
    rows = [r for r in _arrivals() if r[0].split("/")[1].split("-")[0] in keep]
    rows += [("incoming/heartbeat-1.png", "image/png", T0 + dt.timedelta(seconds=60), "b")]
    _write_stream_files(str(tmp_path / "in"), rows)
    stream = J.object_arrivals(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    out = _run(J.eager_batches(stream, gap_ms=3000), "eager_stream")
    got = {}
    for r in out.collect():
        got.setdefault(r.base_name, []).append((r.kind, r.n_pages))
    # one file per micro-batch: a first page is always alone, so it passes at once
    # and the base's later pages come out as late pages (the reference's behaviour)
    assert got["single"] == [("single", 1)]
    assert sorted(got["sequential"]) == [("late", 1), ("single", 1)]
    assert sorted(got["split"]) == [("late", 1), ("single", 1)]


def test_eager_batches_together(spark, tmp_path):
    rows = [(f"incoming/multi-{i}.png", "image/png", T0 + dt.timedelta(seconds=0.1 * i), "b") for i in range(1, 4)]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({"object_key": k, "content_type": c,
                                                         "event_time": t.isoformat(), "bucket": b})
                                             for k, c, t, b in rows))
    (folder / "b.json").write_text(json.dumps({"object_key": "incoming/hb-1.png", "content_type": "image/png",
                                               "event_time": (T0 + dt.timedelta(seconds=30)).isoformat(), "bucket": "b"}))
    os.utime(folder / "a.json", (1_700_000_000, 1_700_000_000))
    os.utime(folder / "b.json", (1_700_000_100, 1_700_000_100))
    stream = J.object_arrivals(spark, str(folder), max_files_per_trigger=1)
    out = _run(J.eager_batches(stream, gap_ms=3000), "eager_together")
    multi = [r for r in out.collect() if r.base_name == "multi"]
    assert len(multi) == 1 and multi[0].kind == "batch" and multi[0].n_pages == 3


def test_completion_gate_fold_and_feed(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    rows = [("d1", 1, 2), ("d2", 1, 3), ("d1", 2, 2), ("d2", 2, 3)]
    for i, (d, p, n) in enumerate(rows):
        f = folder / f"t{i}.json"
        f.write_text(json.dumps({"document_id": d, "page_ordinal": p, "n_pages": n,
                                 "ts": (T0 + dt.timedelta(seconds=i)).isoformat()}))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    s = (spark.readStream.schema("document_id string, page_ordinal long, n_pages long, ts timestamp")
         .option("maxFilesPerTrigger", 2).json(str(folder)))
    out = _run(J.completion_gate(s), "gate").collect()
    assert [(r.document_id, r.n_pages) for r in out] == [("d1", 2)]

    ch = tmp_path / "changes"
    ch.mkdir()
    changes = [("d", 1, "status", "OCR_RUNNING", False), ("d", 2, "status", "COMPLETE", False),
               ("d", 3, "pii_error", None, True), ("e", 4, "status", "FAILED", False)]
    for i, (d, seq, attr, val, setnull) in enumerate(changes):
        f = ch / f"c{i}.json"
        f.write_text(json.dumps({"document_id": d, "seq": seq, "ts": (T0 + dt.timedelta(seconds=i)).isoformat(),
                                 "attr": attr, "value": val, "set_null": setnull}))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    cs = (spark.readStream.schema("document_id string, seq long, ts timestamp, attr string, value string, set_null boolean")
          .option("maxFilesPerTrigger", 2).json(str(ch)))
    folded = _run(J.fold_state(cs, ["status", "pii_error"]), "fold", mode="update")
    last = {r.document_id: r for r in folded.orderBy("updated_at").collect()}
    assert last["d"].status == "COMPLETE" and last["e"].status == "FAILED"

    polls = (spark.readStream.schema("document_id string, seq long, ts timestamp, attr string, value string, set_null boolean")
             .option("maxFilesPerTrigger", 1).json(str(ch))
             .select("document_id", "seq", "ts", F.col("attr").alias("polled")))
    feed = {(r.document_id, r.seq): r.changed for r in _run(J.change_feed(polls), "feed").collect()}
    assert feed == {("d", 1): True, ("d", 2): False, ("d", 3): True, ("e", 4): True}


def test_write_batches_idempotent_and_quarantine(spark, tmp_path):
    base = str(tmp_path / "out")
    run = J.write_batches(J.quarantine_outputs(lambda b: b.select("id")), base)
    batch = spark.createDataFrame([(1, None), (2, "malformed_json")], "id int, error_reason string")
    run(batch, 0)
    run(batch, 0)  # a replayed batch rewrites the same files
    assert spark.read.parquet(f"{base}/main").count() == 1
    assert spark.read.parquet(f"{base}/quarantine").count() == 1
    bad = J.write_batches({"main": lambda b: b, "side": lambda b: b.selectExpr("no_such_column")}, base + "2")
    bad(batch, 3)
    assert spark.read.parquet(f"{base}2/main").count() == 2
    assert spark.read.parquet(f"{base}2/_errors").count() == 1


def test_gate_goes_on_after_a_restart(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    place = checkpoint_path(spark, f"test-restart-{uuid.uuid4().hex}")

    def run(page, n):
        (folder / f"t{n}.json").write_text(json.dumps({"document_id": "d", "page_ordinal": page, "n_pages": 2,
                                                       "ts": (T0 + dt.timedelta(seconds=n)).isoformat()}))
        s = spark.readStream.schema("document_id string, page_ordinal long, n_pages long, ts timestamp").json(str(folder))
        q = (J.completion_gate(s).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", place).trigger(availableNow=True).start())
        q.awaitTermination(300)
        return spark.read.schema(J.GATE_OUT).parquet(str(tmp_path / "out")).count()
    assert [run(1, 0), run(2, 1), run(2, 2)] == [0, 1, 1]  # each run is a query of its own


def test_late_pages_stay_visible(spark):
    log = spark.createDataFrame([(f"incoming/a-{i}.png", "image/png", T0 + dt.timedelta(seconds=s), "b")
                                 for i, s in enumerate((0, 1, 100))] + [("incoming/z-1.png", "image/png", T0, "b")],
                                J.MANIFEST_DDL)
    batches = spark.createDataFrame([("a", T0, T0 + dt.timedelta(seconds=4), 2)],
                                    "base_name string, batch_start timestamp, batch_end timestamp, n_pages long")
    assert sorted(r.object_key for r in J.late_arrivals(log, batches).collect()) == ["incoming/a-2.png", "incoming/z-1.png"]


def test_both_readers_give_the_same_document(spark, tmp_path):
    from doclake.operators import ingest as I
    (tmp_path / "incoming").mkdir()
    (tmp_path / "incoming" / "INV-1.jpg").write_bytes(b"x")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    manifest = spark.createDataFrame([("incoming/INV-1.jpg", "image/jpeg", T0, "b")], J.MANIFEST_DDL)
    ids = {r.document_id for m in (J.binary_to_manifest(files, "b"), manifest)
           for r in I.document_records(I.accepted_pages(I.parse_keys(m))).collect()}
    assert len(ids) == 1


def test_static_batches_with_a_hot_base(spark):
    """One base holds most arrivals, in a chain over many buckets and many batches; against a plain scan."""
    import random
    rng = random.Random(2)
    at, rows = 0.0, []
    for i in range(3000):
        at += rng.choice([1, 2.999999, 3, 5, 700, 2000])
        rows.append(("hot", i, at))
    rows += [(f"b{i % 7}", 5000 + i, rng.uniform(0, 5000)) for i in range(200)]
    df = spark.createDataFrame([(b, i, T0 + dt.timedelta(microseconds=round(s * 1e6))) for b, i, s in rows],
                               "base_name string, object_id long, event_time timestamp")
    want = []
    for base in {r[0] for r in rows}:
        times = sorted(T0 + dt.timedelta(microseconds=round(s * 1e6)) for b, _, s in rows if b == base)
        start, last, n = times[0], times[0], 0
        for t in times:
            if t - last >= dt.timedelta(seconds=3):
                want.append((base, start, last + dt.timedelta(seconds=3), n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((base, start, last + dt.timedelta(seconds=3), n))
    got = [tuple(r) for r in page_batches(df).collect()]
    assert sorted(got) == sorted(want)
