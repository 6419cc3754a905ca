import datetime as dt
import json
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from doclake.session import checkpoint_path
from doclake.streaming import calls as C
from doclake.streaming import jobs as J
from doclake.streaming.stateful import CompletionGate, EagerBatches

T0 = dt.datetime(2026, 1, 1, 12, 0, 0)


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None


class Map(dict):
    writes = 0

    def containsKey(self, k):
        return k in self

    def updateValue(self, k, v):
        self.writes += 1
        self[k] = v


class Handle:
    """State of one key; timers are checked as the engine does."""

    def __init__(self, watermark_ms):
        self.watermark, self.timers, self.maps = watermark_ms, set(), []

    def getMapState(self, *_):
        self.maps.append(Map())
        return self.maps[-1]

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, ms):
        assert ms > self.watermark
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def begun(processor, watermark_ms=0):
    handle = Handle(watermark_ms)
    processor.init(handle)
    return handle


def pages(keys, at=T0):
    return iter([pd.DataFrame({"object_key": keys, "event_time": pd.Timestamp(at)})])


def test_a_quiet_night_and_page_order():
    """The watermark has moved on by ten hours when the pages come."""
    late = int(pd.Timestamp(T0).value // 1_000_000) + 36_000_000
    step = EagerBatches(3000, 3_600_000)
    handle = begun(step, late)
    assert list(step.handleInputRows(("a",), pages([f"incoming/a-{n}.png" for n in (10, 2, 1)] + ["incoming/a.png"]), handle)) == []
    assert handle.timers == {late + 1}
    handle.timers, handle.watermark = set(), late + 1
    out, = step.handleExpiredTimer(("a",), handle, None)
    assert out["pages"][0] == ["incoming/a-1.png", "incoming/a-2.png", "incoming/a-10.png", "incoming/a.png"]
    late_out, = step.handleInputRows(("a",), pages(["incoming/a-3.png"]), handle)
    assert late_out["kind"][0] == "late" and len(handle.timers) == 1
    gate = CompletionGate(1000)
    handle = begun(gate, late)
    list(gate.handleInputRows(("d",), iter([pd.DataFrame({"page_ordinal": [1], "n_pages": [2], "ts": [pd.Timestamp(T0)]})]), handle))
    assert handle.timers == {late + 1}


def test_state_writes_are_linear_in_the_pages():
    """10,000 pages of one document over 500 micro-batches, each handed in twice: one map write per page."""
    gate = CompletionGate(1000)
    handle = begun(gate)
    out = []
    for k in range(500):
        for _ in range(2):
            frame = pd.DataFrame({"page_ordinal": range(20 * k, 20 * k + 20), "n_pages": 10_000, "ts": pd.Timestamp(T0)})
            out += list(gate.handleInputRows(("d",), iter([frame]), handle))
    assert handle.maps[0].writes == 10_000 and len(handle.timers) == 1
    assert [f["n_pages"][0] for f in out] == [10_000]
    eager = EagerBatches(3000, 3_600_000)
    handle = begun(eager)
    for k in range(100):
        list(eager.handleInputRows(("a",), pages([f"incoming/a-{100 * k + i}.png" for i in range(100)]), handle))
    assert handle.maps[0].writes == 10_000
    out, = eager.handleExpiredTimer(("a",), handle, None)
    assert out["n_pages"][0] == 10_000 and not handle.maps[0]


def drop(folder, n, rows):
    """A file of the stream's source, its modification time in order."""
    os.makedirs(folder, exist_ok=True)
    p = f"{folder}/f{n:03d}.json"
    with open(p, "w") as f:
        f.write("\n".join(json.dumps({k: v.isoformat() if isinstance(v, dt.datetime) else v for k, v in r.items()}) for r in rows))
    os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))


def drain(stream, place, **kw):
    """Run a query over what is there; the place keeps its checkpoint, so the next call goes on."""
    w = stream.writeStream.option("checkpointLocation", place).trigger(availableNow=True)
    q = (w.foreachBatch(kw["batch"]) if "batch" in kw else w.format("parquet").option("path", kw["path"])).start()
    assert q.awaitTermination(300)
    return q


@pytest.fixture
def place(spark):
    return lambda: checkpoint_path(spark, f"test-{uuid.uuid4().hex}")


def arrival(key, seconds):
    return {"object_key": f"incoming/{key}.png", "content_type": "image/png", "event_time": T0 + dt.timedelta(seconds=seconds), "bucket": "b"}


def test_pages_behind_the_watermark_come_out_once(spark, tmp_path, place):
    src, out, got = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "late")
    drop(src, 0, [arrival("a-1", 0), arrival("a-2", 1), arrival("b-1", 0)])
    drop(src, 1, [arrival("hb-1", 600)])
    main, side = place(), place()

    def run():
        stream = J.object_arrivals(spark, src, max_files_per_trigger=1)
        drain(J.batch_pages(stream, "3 seconds", watermark="10 seconds"), main, path=out)
        drain(stream, side, batch=J.late_router(lambda s: s.read.parquet(out), got, "3 seconds", "10 seconds"))
    run()
    drop(src, 2, [arrival("a-3", 2), arrival("c-1", 50), arrival("hb-2", 700), arrival("a-3", 2)])
    run()
    run()  # nothing new: nothing again
    late = {(r.object_key, r.batch_start) for r in spark.read.parquet(f"{got}/late").collect()}
    assert late == {("incoming/a-3.png", T0), ("incoming/c-1.png", None)}
    assert spark.read.parquet(f"{got}/late").count() == 2
    assert {(r.base_name, r.n_pages) for r in spark.read.parquet(out).where("base_name <> 'hb'").collect()} == {("a", 2), ("b", 1)}


def test_a_hot_base_spreads_over_its_cells(spark):
    pages = spark.range(4000).selectExpr("'hot' AS base_name", "concat('incoming/hot-', id, '.png') AS object_key",
                                         "timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 60) AS event_time")
    batches = pages.select(
        "base_name", F.col("event_time").alias("batch_start"), (F.col("event_time") + F.expr("INTERVAL 5 SECONDS")).alias("batch_end"))
    found = J.covering_batches(pages, batches)
    assert found.where("batch_start = event_time").count() == 4000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_cell" in plan and "NestedLoop" not in plan


def test_flag_changes_between_batches_and_the_branch_fails_alone(spark, tmp_path, place):
    src, flags = str(tmp_path / "in"), str(tmp_path / "flags")
    schema = "document_id string, bucket string, ts timestamp, text string"

    def version(n, bucket, seconds, on):
        spark.createDataFrame([(bucket, T0 + dt.timedelta(seconds=seconds), on)], "bucket string, valid_from timestamp, enabled boolean"
                              ).write.mode("append").parquet(flags)

    def page(doc, bucket, seconds):
        return {"document_id": doc, "bucket": bucket, "ts": T0 + dt.timedelta(seconds=seconds), "text": f"mail {doc}@x.co"}
    version(0, "b", 0, True)
    drop(src, 0, [page("d1", "b", 5), page("d2", "other", 5), page("early", "b", -5)])
    main, side = place(), place()

    def run(bad=False):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
        drain(stream, main, path=str(tmp_path / "main"))
        read = (lambda s: s.read.parquet("/no/such/flags")) if bad else (lambda s: s.read.parquet(flags))
        return drain(stream, side, batch=J.pii_batches(read, str(tmp_path / "pii"), ["document_id"]))
    run()
    version(1, "b", 100, False)
    version(1, "other", 100, True)
    drop(src, 1, [page("d3", "b", 105), page("d4", "other", 105), page("d5", "b", 50)])
    with pytest.raises(Exception):
        run(bad=True)
    assert spark.read.parquet(str(tmp_path / "main")).count() == 6  # the main output is whole
    run()
    assert {r.document_id for r in spark.read.parquet(str(tmp_path / "pii")).collect()} == {"d1", "d4", "d5"}


def test_source_files_are_moved_and_none_twice(spark, tmp_path, place):
    src, gone, out = str(tmp_path / "in"), str(tmp_path / "gone"), str(tmp_path / "out")
    at = place()
    for n in range(4):
        drop(src, n, [arrival(f"x-{n}", n)])
        stream = J.object_arrivals(spark, src, max_files_per_trigger=1, archive=gone)
        drain(stream, at, path=out)  # a new query each time: a restart
    moved = J.moved_files(spark, src, gone).collect()
    assert {os.path.basename(r.old_path) for r in moved} >= {"f000.json", "f001.json"}
    assert len({r.old_path for r in moved}) == len(moved)
    assert all(os.path.exists(r.new_path) and not os.path.exists(r.old_path) for r in moved)
    assert sorted(r.object_key for r in spark.read.parquet(out).collect()) == [f"incoming/x-{n}.png" for n in range(4)]


def test_stored_counts_equal_the_rows_written(spark, tmp_path, place):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        drop(src, n, [{"id": 10 * n + i, "error_reason": "malformed_json" if i % 3 == 0 else None} for i in range(4 + n)])
    stream = spark.readStream.schema("id long, error_reason string").option("maxFilesPerTrigger", 1).json(src)
    seen = J.BatchMetrics()
    spark.streams.addListener(seen)
    try:
        drain(stream, place(), batch=J.write_batches(J.quarantine_outputs(lambda b: b.select("id")), base))
        drain(J.with_batch_metrics(stream, "arrived"), place(), path=str(tmp_path / "plain"))
        for _ in range(50):  # progress events come on a thread of their own
            if seen.table(spark).where("metric = 'arrived'").agg(F.sum("n_rows")).first()[0] == 15:
                break
            import time
            time.sleep(.2)
    finally:
        spark.streams.removeListener(seen)
    got = sorted((r.batch_id, r.n_rows, r.n_quarantined) for r in J.batch_counts(spark, base).collect())
    assert got == [(0, 4, 2), (1, 5, 2), (2, 6, 2)]
    assert spark.read.parquet(f"{base}/main").count() == 15 - 6 and spark.read.parquet(f"{base}/quarantine").count() == 6
    listened = seen.table(spark).where("metric = 'arrived'").agg(F.sum("n_rows"), F.sum("n_quarantined")).first()
    assert tuple(listened) == (15, 6)


def test_a_provider_that_fails_midway(spark, tmp_path, place):
    src, root, log = str(tmp_path / "in"), str(tmp_path / "calls"), str(tmp_path / "log")
    os.makedirs(log)
    drop(src, 0, [{"request_id": f"r{i}", "payload": f"p{i}"} for i in range(30)] + [{"request_id": "r1", "payload": "p1"}])
    drop(src, 1, [{"request_id": f"r{i}", "payload": f"p{i}"} for i in (2, 5, 40)])

    def call(request, payload):
        n = len([f for f in os.listdir(log) if f.startswith(request + ".")])
        open(f"{log}/{request}.{uuid.uuid4().hex}", "w").close()
        if request == "r7" or (request in ("r3", "r4") and n == 0):
            raise TimeoutError(f"no answer to {payload}")
        return 200, f"answer {payload}"
    stream = spark.readStream.schema("request_id string, payload string").option("maxFilesPerTrigger", 1).json(src)
    at = place()
    drain(stream, at, batch=C.answer_batches(call, root))
    got = {r.request_id: (r.body, r.attempt) for r in C.answers(spark, root).collect()}
    assert set(got) == {f"r{i}" for i in range(30) if i != 7} | {"r40"}
    assert got["r1"] == ("answer p1", 1) and got["r3"] == ("answer p3", 2)
    assert [(r.request_id, r.error) for r in C.dead_letters(spark, root).collect()] == [("r7", "TimeoutError: no answer to p7")]
    calls = [f.split(".")[0] for f in os.listdir(log)]
    assert {r: calls.count(r) for r in set(calls)} == {f"r{i}": 1 for i in [*range(30), 40]} | {"r3": 2, "r4": 2, "r7": 3}
    C.answer_batches(call, root)(spark.createDataFrame([("r1", "p1"), ("r7", "p7")], "request_id string, payload string"), 0)
    assert len(os.listdir(log)) == len(calls)  # the replayed batch calls nothing


def test_upserts_touch_their_buckets_alone(spark, tmp_path):
    from doclake.operators import state as ST
    path, attrs = str(tmp_path / "state"), ["status", "error"]
    schema = "document_id string, seq long, ts timestamp, attr string, value string, set_null boolean"
    log = [(f"d{i % 50}", i, T0 + dt.timedelta(seconds=i % 97), attrs[i % 2], None if i % 11 == 0 else f"v{i}", i % 22 == 0) for i in range(800)]
    first, second = spark.createDataFrame(log[:700], schema), spark.createDataFrame([r for r in log[700:] if r[0] in ("d3", "d4")], schema)
    assert ST.upsert_state(first, path, attrs, 0, buckets=8)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet")}
    before = files()
    assert ST.upsert_state(second, path, attrs, 1, buckets=8)
    after = files()
    kept = {p for p in before if p in after and before[p] == after[p]}
    assert len({os.path.dirname(p) for p in after if p not in kept}) <= 2 and len(kept) >= 5
    want = {tuple(r) for r in ST.fold_changes(first.unionByName(second), attrs).select("document_id", *attrs, "updated_at").collect()}
    assert {tuple(r) for r in ST.read_state(spark, path, attrs).collect()} == want
    assert not ST.upsert_state(second, path, attrs, 1, buckets=8) and files() == after  # replay changes nothing
