from collections import Counter

import corpus_pipeline
from doclake.llm import mixing

from llm_helpers import docs  # noqa: F401


def sharded(spark, df):
    return dict(corpus_pipeline.STAGES)["sharding"](spark, df, "").collect()


def test_shards_follow_the_weights_where_doc_ids_of_a_source_are_contiguous(docs, spark):
    sizes = {"a": 6400, "b": 3200, "c": 1600, None: 800}
    names = [s for s, n in sizes.items() for _ in range(n)]
    df = docs([(i, "x" * 20, s) for i, s in enumerate(names)])
    early = mixing.schedule(df).collect()
    until = sum(r.in_mix for r in early)
    total = sum(n ** mixing.TEMPERATURE for n in sizes.values())
    shards = {}
    for r in sharded(spark, df):
        shards.setdefault(r.shard, Counter())[r.source] += 1
    seen = 0
    for k in range(corpus_pipeline.N_SHARDS):
        seen += shards[k].total()
        if seen <= until:
            for s, n in sizes.items():  # less than a block off at each end
                assert abs(shards[k][s] - shards[k].total() * n ** mixing.TEMPERATURE / total) < 2 * mixing.BLOCK_ROWS
    assert until > 8000 and seen == 12000


def test_shards_are_cut_in_slot_and_doc_id_order(docs, spark):
    rows = [(i, "y" * (i * 37 % 90), "big" if i % 3 else f"s{i % 4}") for i in range(900)]
    slots = {r.doc_id: r.mix_slot for r in mixing.interleave(docs(rows)).collect()}
    size = [len(t) + 16 for _, t, _ in rows]
    order = sorted(range(900), key=lambda i: (slots[i], i))
    total, before, want, place = sum(size), 0, {}, Counter()
    for i in order:
        k = min(39, (2 * before + size[i]) * 40 // (2 * total))
        want[i] = (k, place[k])
        place[k] += 1
        before += size[i]
    out = sharded(spark, docs(rows))
    assert {r.doc_id: (r.shard, r.slot) for r in out} == want and len(out) == 900
