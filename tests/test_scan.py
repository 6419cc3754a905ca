import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from doclake.operators import scan
from doclake.operators.scan import Scan


@pytest.fixture
def split(spark):
    """Eight range partitions, however small the table."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(seed, n, keys):
    rnd = random.Random(seed)
    t0 = dt.datetime(2026, 1, 1)
    return [(rnd.choice(keys), rnd.choice([None, *range(30)]), i, t0 + dt.timedelta(milliseconds=rnd.randint(0, 900)),
             rnd.choice(["a", "b", None])) for i in range(n)]


SCHEMA = "k string, page long, id long, ts timestamp_ntz, v string"


@pytest.mark.parametrize("keys", [["x"], ["x", "x", "x", "y", None], [f"k{i}" for i in range(60)]])
def test_scans_equal_windows(split, keys):
    df = split.createDataFrame(rows_of(len(keys), 700, keys), SCHEMA)
    rows = scan.ranged(df, ["k"], ["ts", "id"])
    got = scan.scanned(rows, ["k"], [
        Scan("n", "sum", F.lit(1).cast("long")), Scan("s", "sum", F.col("page")), Scan("sb", "sum", F.col("page"), True),
        Scan("m", "min", F.col("page")), Scan("last", "last", F.col("v")), Scan("prev", "last", F.struct("v"), True)])
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", F.row_number().over(w).alias("n"), F.sum("page").over(upto).alias("s"),
                     F.sum("page").over(before).alias("sb"), F.min("page").over(upto).alias("m"), F.last("v", True).over(upto).alias("last"),
                     F.lag("v").over(w).alias("p"), (F.row_number().over(w) == 1).alias("first"))
    found = {(r.id, r.n, r.s, r.sb, r.m, r.last, r.prev.v if r.prev else None, r.prev is None) for r in got.collect()}
    assert found == set(map(tuple, want.collect()))


def test_one_key_and_minute_spreads_over_tasks(split):
    """A key whose rows all fall into one minute holds two thirds of the table."""
    t0 = dt.datetime(2026, 1, 1)
    rows = [("hot", None, i, t0 + dt.timedelta(milliseconds=i % 50), "a") for i in range(4000)]
    rows += [(f"k{i % 40}", None, i, t0 + dt.timedelta(hours=i), "b") for i in range(4000, 6000)]
    placed = scan.ranged(split.createDataFrame(rows, SCHEMA), ["k"], ["ts", "id"])
    per_part = placed.where("k = 'hot'").groupBy(scan.PART).count().collect()
    assert len(per_part) >= 4 and max(r["count"] for r in per_part) < 2000
    got = scan.scanned(placed, ["k"], [Scan("n", "sum", F.lit(1).cast("long"))]).where("k = 'hot'")
    assert sorted(r.n for r in got.collect()) == list(range(1, 4001))


def test_empty_table(split):
    df = split.createDataFrame([], SCHEMA)
    assert scan.positions(df, ["k"], ["ts"], "n").collect() == []


def test_positions_keep_columns(split):
    df = split.createDataFrame(rows_of(1, 50, ["x", "y"]), SCHEMA)
    out = scan.positions(df, ["k"], ["ts", "id"], "n", keep=["k", "id"])
    assert out.columns == ["k", "id", "n"] and out.count() == 50


def test_hot_document_keeps_its_page_order(split):
    """One document holds most pages, half of them without a number; against plain windows."""
    from doclake.operators import ingest as I
    rows = [("b", "hot", f"incoming/hot-{i}.png", i) for i in range(1, 900)]
    rows += [("b", "hot", f"incoming/hot{i}.png", None) for i in range(800)] + [("b", f"d{i % 9}", f"incoming/d{i % 9}-{i}.png", i)
                                                                               for i in range(200)]
    df = split.createDataFrame(rows + rows[:50], "bucket string, base_name string, object_key string, page_no long")
    for order, by in (("numeric", [F.col("page_no").asc_nulls_last(), "object_key"]), ("lexical", ["object_key"])):
        got = {r.object_key: r.page_ordinal for r in I.page_table(df, order=order).collect()}
        w = Window.partitionBy("base_name").orderBy(*by)
        want = {r.object_key: r.o for r in df.distinct().withColumn("o", F.row_number().over(w)).collect()}
        assert got == want


def test_changes_of_a_hot_document(split):
    from doclake.operators import state as ST
    df = split.createDataFrame(rows_of(5, 600, ["x", "x", "x", "y"]), SCHEMA).withColumnsRenamed(
        {"k": "document_id", "id": "seq", "v": "polled"})
    got = {(r.seq, r.changed) for r in ST.change_flags(df, "polled").collect()}
    w = Window.partitionBy("document_id").orderBy("ts", "seq")
    want = df.select("seq", (F.lag("seq").over(w).isNull() | ~F.lag("polled").over(w).eqNullSafe(F.col("polled"))).alias("c"))
    assert got == set(map(tuple, want.collect()))


def test_batches_of_a_hot_base_name(split):
    from doclake.streaming import batching
    df = split.createDataFrame([(r[0], r[2], r[3]) for r in rows_of(7, 500, ["x", "x", "y"])], "base_name string, object_id long, event_time timestamp_ntz")
    got = sorted((r.base_name, r.batch_start, r.batch_end, r.n_pages) for r in batching.page_batches(df, "4 milliseconds").collect())
    gap, want = dt.timedelta(milliseconds=4), []
    for base in ("x", "y"):
        at = sorted(r.event_time for r in df.where(F.col("base_name") == base).collect())
        run = [at[0]]
        for t in at[1:]:
            if t - run[-1] >= gap:
                want.append((base, run[0], run[-1] + gap, len(run)))
                run = []
            run.append(t)
        want.append((base, run[0], run[-1] + gap, len(run)))
    assert got == sorted(want) and len(got) > 10


def test_steps_of_a_hot_execution(split):
    """Entries and the first strictly later terminal event, many in one moment."""
    from doclake.operators import timeline as TL
    rnd = random.Random(11)
    t0 = dt.datetime(2026, 1, 1)
    rows = [(rnd.choice(["x", "x", "x", "y"]), i, t0 + dt.timedelta(milliseconds=rnd.randint(0, 40)),
             rnd.choice([TL.ENTERED, TL.ENTERED, TL.SUCCEEDED, TL.FAILED, "Other"]), "OCR") for i in range(500)]
    rows.append(("x", 900, None, TL.ENTERED, "OCR"))
    df = split.createDataFrame(rows, "execution_id string, event_id long, ts timestamp_ntz, type string, state string")
    got = {(r.event_id, r.status, r.terminal_event_id) for r in TL.workflow_steps(df).collect()}
    want = set()
    for x, i, ts, kind, _ in rows:
        if kind == TL.ENTERED:
            later = [(t, j, k) for y, j, t, k, _ in rows if y == x and k in (TL.SUCCEEDED, TL.FAILED) and ts and t > ts]
            end = min(later) if later else None
            want.add((i, "in_progress" if not end else "completed" if end[2] == TL.SUCCEEDED else "failed", end and end[1]))
    assert got == want
