import math
import random
from collections import Counter
from fractions import Fraction

import corpus_pipeline
from doclake.llm import mixing

import test_decontaminate
import test_mixing
import test_repetition
import test_simhash


def write(spark, folder, rows, items):
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def corpus():
    rng = random.Random(8)
    common = [f"c{i}" for i in range(30)]
    word = lambda: rng.choice(common) if rng.random() < .4 else f"w{rng.randrange(9000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(18, 50)))) for i in range(12)]
    rows = []
    for i in range(260):
        t = [word() for _ in range(rng.randint(55, 240))]
        if i % 13 == 0:
            t[20:20] = rng.choice(items)[1].split()
        if i % 17 == 0:
            t = t[:30] * 4
        if i % 19 == 0:
            t = t[:20]
        rows.append((i, " ".join(t), "hot" if i % 2 else f"s{i % 7}"))
    for k in range(40):
        i, t, s = rows[rng.randrange(200)]
        t = t.split()
        if k % 2:
            t[rng.randrange(len(t))] = "changed"
        rows.append((300 + k, " ".join(t), s))
    return rows + [(400, None, "hot"), (401, "", None)], items


def slow(rows, items, block=mixing.BLOCK_ROWS):
    out = []
    for r in rows:
        n, _, _, _, rep, cov, longest = test_repetition.slow(r[1])
        if not (n < 50 or 2 * rep > n or cov > .3 * n or longest > 100):
            out.append(r)
    groups = test_simhash.slow_groups([test_simhash.slow_print(t) for _, t, _ in out])
    out = [r for k, r in enumerate(out) if groups[k] == k]
    leaked = {d for d, _ in test_decontaminate.brute([(i, t) for i, t, _ in out], items)}
    out = [r for r in out if r[0] not in leaked]
    n = Counter(s for *_, s in out)
    key = test_mixing.mixing_key
    cycle = max(mixing.CYCLE, 4 * len(n))
    total = sum(c ** mixing.TEMPERATURE for c in n.values())
    exact = {s: c ** mixing.TEMPERATURE / total * (cycle - len(n)) for s, c in n.items()}
    parts = {s: 1 + int(e) for s, e in exact.items()}
    for s in sorted(n, key=lambda s: (int(exact[s]) - exact[s], key(s)))[:cycle - sum(parts.values())]:
        parts[s] += 1
    by_key = {key(s): s for s in n}
    blocks = {k: -(-n[by_key[k]] // block) for k in by_key}
    slots = slow_slots(blocks, {key(s): p for s, p in parts.items()})
    place = {}
    for s in n:
        own = sorted((i % mixing.BUCKETS, i) for i, _, x in out if x == s)
        for k, (_, i) in enumerate(own):
            place[i] = slots[key(s), k // block]
    texts = {i: t for i, t, _ in out}
    size = {i: len(texts[i].encode()) + 16 for i in place}
    total, before, want, filled = sum(size.values()), 0, [], Counter()
    for i in sorted(place, key=lambda i: (place[i], i)):
        s = min(39, (2 * before + size[i]) * 40 // (2 * total))
        want.append((i, texts[i], s, filled[s]))
        filled[s] += 1
        before += size[i]
    return sorted(want)


def slow_slots(blocks, parts):
    """The slot of every (source, block): phases between the sources' ends, each its whole cycles and one of the rest."""
    slots, done, at = {}, dict.fromkeys(blocks, 0), 0

    def run(share):
        nonlocal at
        for s in test_mixing.slow_cycle(share, sum(share.values())):
            slots[s, done[s]] = at
            done[s] += 1
            at += 1

    for e in sorted(blocks, key=lambda s: (blocks[s] / parts[s], s)):
        cycles = Fraction(blocks[e], parts[e])
        goal = {s: blocks[s] if blocks[s] <= parts[s] * cycles else min(blocks[s], math.floor(parts[s] * cycles + Fraction(1, 2)))
                for s in blocks}
        active = {s: goal[s] - done[s] for s in blocks if done[s] < blocks[s]}
        times = min(m // parts[s] for s, m in active.items()) if active else 0
        for _ in range(times):
            run({s: parts[s] for s in active})
        rest = {s: m - times * parts[s] for s, m in active.items() if m > times * parts[s]}
        if rest:
            run(rest)
    return slots


def test_run_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    write(spark, str(tmp_path), rows, items)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = slow(rows, items)
    assert sorted((r.doc_id, r.text, r.shard, r.slot) for r in got) == want
    assert 100 < len(want) < 250


def test_empty_table_and_columns(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:5] == docs.columns and out.count() == 0, name
        assert name == "sharding" or out.columns == docs.columns
