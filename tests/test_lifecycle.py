import datetime as dt
import random

import pytest

from doclake.operators import lifecycle as LC
from doclake.operators import pages as PG

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "document_id string, seq long, ts timestamp_ntz, status string"


@pytest.fixture
def split(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def slow(rows):
    state, out = {}, set()
    for d, seq, ts, s in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        before = state.get(d, LC.NEW)
        legal = s is None or s in LC.STEPS.get(before, [])
        state[d] = s if legal and s is not None else before
        out.add((d, seq, before, legal, state[d]))
    return out


def test_transitions_of_a_hot_document(split):
    """One document holds most changes, most of them in a run that the lifecycle allows."""
    rnd = random.Random(4)
    run = LC.STATUSES[1:-1]
    rows = []
    for i in range(1200):
        ask = run[(i // 7) % len(run)] if rnd.random() < .6 else rnd.choice([*LC.STATUSES, None, "OTHER"])
        rows.append((rnd.choice(["hot", "hot", "hot", *(f"d{k}" for k in range(30))]), i, T0 + dt.timedelta(milliseconds=i // 40), ask))
    got = LC.transitions(split.createDataFrame(rows, SCHEMA))
    assert got.columns == ["document_id", "seq", "ts", "status", "from_status", "legal", "to_status"]
    assert {(r.document_id, r.seq, r.from_status, r.legal, r.to_status) for r in got.collect()} == slow(rows)


def test_complete_document_does_not_run_again(spark):
    run = ["OCR_RUNNING", "AGGREGATING", "LLM_RUNNING", "COMPLETE", "OCR_RUNNING"]
    rows = [("d", i, T0, s) for i, s in enumerate(run)]
    got = {r.seq: (r.from_status, r.legal, r.to_status) for r in LC.transitions(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == ("LLM_RUNNING", True, "COMPLETE") and got[4] == ("COMPLETE", False, "COMPLETE")


def test_composition_is_associative():
    a = LC.Automaton(LC.STATUSES, LC.STEPS)
    rnd = random.Random(1)
    for _ in range(50):
        f, g, h = (a.functions[rnd.choice(LC.STATUSES)] for _ in range(3))
        assert a.then(a.then(f, g), h) == a.then(f, a.then(g, h))
        assert a.then(a.identity, f) == f == a.then(f, a.identity)


def test_empty_table(spark):
    assert LC.transitions(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_parts_give_the_combined_text(split, tmp_path):
    rnd = random.Random(2)
    rows = [("big", i, "größer " * rnd.randint(0, 9)) for i in range(1, 400)] + [("d1", 1, None), ("d1", 2, "x"), ("d2", 1, "")]
    rnd.shuffle(rows)
    pages = split.createDataFrame(rows, "document_id string, page_ordinal int, text string")
    parts = PG.write_combined(pages, str(tmp_path / "parts"))
    plan = PG.combined_layout(pages)._jdf.queryExecution().toString()
    assert "collect_list" not in plan
    whole = {r.document_id: r.combined_text for r in PG.combined_text(pages).collect()}
    for d in ("big", "d1", "d2"):
        mine = PG.read_combined(parts, d).collect()
        assert "".join(r.part for r in mine) == whole[d]
        ends = [r.byte_to for r in mine]
        assert [r.byte_from for r in mine] == [0, *ends[:-1]] and ends[-1] == len(whole[d].encode())
    some = PG.read_combined(parts, "big", 500, 700).collect()
    text = "".join(r.part for r in some).encode()
    at = some[0].byte_from
    assert text[500 - at:700 - at] == whole["big"].encode()[500:700] and len(some) < 20
    plan = PG.read_combined(parts, "big", 500, 700)._jdf.queryExecution().toString()
    assert "PushedFilters: [Is" in plan
