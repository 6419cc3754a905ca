from collections import Counter

from doclake.llm import mixing

from llm_helpers import clash, docs  # noqa: F401


def mixing_key(s):
    return "null" if s is None else f"={s}"


def slow_cycle(parts, q):
    done, out = {s: 0 for s in parts}, []
    for t in range(q):
        free = [(-(-(done[s] + 1) * q // parts[s]), s) for s in sorted(parts)
                if done[s] < parts[s] and done[s] * q // parts[s] <= t]
        due, s = min(free)
        assert t < due
        done[s] += 1
        out.append(s)
    return out


def test_cycle_is_earliest_deadline_first(spark):
    rows = [(f"={k}", 10 * (k + 1) ** 2, 1 + 3 * k, 70) for k in range(6)]
    rows.append(("=z", 5, 70 - sum(r[2] for r in rows), 70))
    parts = spark.createDataFrame(rows, "src string, n_rows long, parts long, cycle long")
    got = [r.src for r in mixing.edf_cycle(parts).orderBy("at").collect()]
    assert got == slow_cycle({r[0]: r[2] for r in rows}, 70)


def test_schedule_deviates_by_less_than_a_block(docs):
    rows = [(i, "x", None if i % 11 == 0 else "big" if i % 3 else f"s{i % 7}") for i in range(3000)]
    out = mixing.schedule(docs(rows), block_rows=4, cycle=50).collect()
    assert len(out) == 3000
    blocks = {(r.source, r.block): (r.slot, r.release, r.due, r.in_mix) for r in out}
    assert all(release <= slot < due for slot, release, due, _ in blocks.values())
    sizes = Counter((r.source, r.block) for r in out)
    n = Counter(r.source for r in out)
    assert all(v == 4 or (s, b) == (s, (n[s] - 1) // 4) for (s, b), v in sizes.items())
    order = sorted(((v[0], k[0]) for k, v in blocks.items() if v[3]), key=lambda x: x[0])
    assert [t for t, _ in order] == list(range(len(order)))
    total = sum(c ** mixing.TEMPERATURE for c in n.values())
    exact = {s: c ** mixing.TEMPERATURE / total * (50 - len(n)) for s, c in n.items()}
    parts = {s: 1 + int(e) for s, e in exact.items()}
    for s in sorted(n, key=lambda s: (int(exact[s]) - exact[s], mixing_key(s)))[:50 - sum(parts.values())]:
        parts[s] += 1
    done = Counter()
    for t, s in order:
        done[s] += 1
        assert all(abs(done[k] - (t + 1) * parts[k] / 50) < 1 for k in n)
    ends = [s for s in n if all(v[3] for k, v in blocks.items() if k[0] == s)]
    assert ends


def test_given_weights_and_unweighted_sources(docs):
    rows = [(i, "x", "abc"[i % 3]) for i in range(300)]
    out = mixing.schedule(docs(rows), {"a": 3, "b": 1, "nowhere": 5}, block_rows=5, cycle=8).collect()
    assert {r.source for r in out if r.slot is None} == {"c"} and not any(r.in_mix for r in out if r.source == "c")
    kept = Counter(r.source for r in out if r.in_mix)
    assert kept["a"] == 100 and 25 <= kept["b"] <= 45
    mixed = mixing.mix(clash(docs(rows), "slot", "block", "src", "cycle"), {"a": 3, "b": 1}, block_rows=5, cycle=8)
    assert mixed.columns[-4:] == ["slot", "block", "src", "cycle"]
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in out if r.in_mix)


def test_repeated_null_and_empty(docs):
    rows = [(5, "x", "a")] * 40 + [(None, None, "a")] * 40 + [(1, "y", None)]
    out = mixing.schedule(docs(rows), block_rows=4).collect()
    assert len(out) == 81 and all(r.slot is not None for r in out)
    assert mixing.schedule(docs([])).collect() == []
    assert mixing.mix(docs([])).collect() == []


def test_no_python_in_the_plan(docs):
    plan = mixing.mix(docs([(1, "x", "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
