from collections import Counter

import corpus_pipeline
from doclake.llm import mixing

from llm_helpers import clash, docs  # noqa: F401


def test_phases_place_every_block_near_its_weight(spark):
    sources = [("=a", 700, 60), ("=b", 90, 30), ("=c", 1, 1), ("=d", 1, 9), ("null", 3, 4)]
    totals = spark.createDataFrame([(s, b * 16 - 3, p) for s, b, p in sources], "src string, n_rows long, parts long")
    out = mixing.block_slots(totals).collect()
    assert sorted(r.slot for r in out) == list(range(sum(b for _, b, _ in sources)))
    assert sorted((r.src, r.block) for r in out) == sorted((s, k) for s, b, _ in sources for k in range(b))
    done, due = Counter(), dict.fromkeys((s for s, *_ in sources), 0.0)
    for r in sorted(out, key=lambda r: r.slot):
        active = {s: p for s, b, p in sources if done[s] < b}
        for s, p in active.items():
            due[s] += p / sum(active.values())
        assert r.block == done[r.src]
        done[r.src] += 1
        assert all(abs(done[s] - due[s]) < 2 for s in active)


def test_every_row_has_a_place(docs):
    rows = [(i, "x", None if i == 700 else "tiny" if i == 50 else "big" if i % 3 else f"s{i % 5}") for i in range(1500)]
    got = mixing.interleave(clash(docs(rows), "mix_slot", "src", "block"), block_rows=2, cycle=40)
    assert got.columns[-4:] == ["mix_slot", "src", "block", "_mix_slot"]
    got = {r.doc_id: r["_mix_slot"] for r in got.collect()}
    assert sorted(got) == list(range(1500)) and None not in got.values()
    early = mixing.schedule(docs(rows), block_rows=2, cycle=40).collect()
    assert 0 < sum(r.in_mix for r in early) < 1500
    assert sorted(set(got.values())) == list(range(len({(r.source, r.block) for r in early})))
    plan = mixing.mixed(docs(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_sources_without_weight_and_empty(docs):
    rows = [(i, "x", "abc"[i % 3]) for i in range(90)] + [(None, None, "a")] * 20 + [(5, "x", "a")] * 20
    out = mixing.interleave(docs(rows), {"a": 3, "b": 1, "nowhere": 5}, block_rows=4, cycle=8).collect()
    assert len(out) == 130 and {r.source for r in out if r.mix_slot is None} == {"c"}
    assert mixing.interleave(docs([])).collect() == [] and mixing.mixed(docs([])).collect() == []


def test_pipeline_stage_keeps_every_row_in_slot_order(docs, spark):
    rows = [(i, f"t{i}", None if i == 7 else "tiny" if i == 9 else "big" if i % 4 else "small") for i in range(2000)]
    stage = dict(corpus_pipeline.STAGES)["mixing"]
    out = stage(spark, docs(rows), "").collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted((i, t) for i, t, _ in rows)
    slots = {r.doc_id: r.mix_slot for r in mixing.interleave(docs(rows)).collect()}
    order = [(slots[r.doc_id], r.doc_id) for r in out]
    assert order == sorted(order)
