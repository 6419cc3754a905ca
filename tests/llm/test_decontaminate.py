import random

import numpy as np

from doclake.llm import decontaminate as dc

from llm_helpers import clash, docs  # noqa: F401


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 90))]
        b = [rng.randrange(-1, 6) for _ in range(rng.randint(0, 90))]
        assert dc.common_subsequence(a, b) == slow_lcs(a, b)


def corpus(seed=2):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    word = lambda: rng.choice(common) if rng.random() < .5 else f"w{rng.randrange(5000)}"
    items = [(i, [word() for _ in range(rng.randint(16, 70))]) for i in range(25)]
    docs, planted = [], set()
    for d in range(300):
        t = [word() for _ in range(rng.randint(0, 500))]
        if d % 4 == 0:
            i, w = rng.choice(items)
            w = list(w)
            kind = d // 4 % 4
            if kind == 1:
                w[rng.randrange(len(w))] = "changed"
            elif kind == 2:  # a paraphrase: a third of the words replaced, the answer kept
                for k in rng.sample(range(len(w) - 5), (len(w) - 5) // 3):
                    w[k] = f"p{rng.randrange(99)}"
            elif kind == 3:
                w = [x.upper() + rng.choice([",", "", "!"]) for x in w]
            at = rng.randint(0, len(t))
            t[at:at] = w
            planted.add((d, i))
        docs.append((d, " ".join(t)))
    return docs, [(i, " ".join(w)) for i, w in items], planted


def brute(docs, items):
    """All documents against all items, every window, with the plain checks."""
    out = set()
    for d, text in docs:
        words = dc.words_of(text)
        for i, item in items:
            w = dc.words_of(item)
            if not w or not set(w) & set(words):
                continue
            reach = max(dc.STRIDE, len(w))
            for at in range(0, max(1, len(words) - dc.STRIDE), dc.STRIDE):
                part = words[max(0, at - reach):at + dc.PASSAGE + reach]
                if len(set(w) & set(part)) < .6 * len(set(w)):
                    continue
                share = slow_lcs(w, part) / len(w)
                tail = w[-dc.ANSWER_WORDS:]
                held = any(part[k:k + len(tail)] == tail for k in range(len(part)))
                if share >= dc.NEAR_VERBATIM or share >= dc.PARAPHRASE and held:
                    out.add((d, i))
    return out


def test_against_brute_force(docs, spark):
    rows, items, planted = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.leaks(clash(docs(rows), "mark", "seq", "t"), clash(bench, "doc_id")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == brute(rows, items)
    assert planted <= found and len(got) == len(found)
    left = dc.drop_leaks(clash(docs(rows), "mark", "__d"), bench)
    assert sorted(r.doc_id for r in left.collect()) == sorted({d for d, _ in rows} - {d for d, _ in found})
    assert left.columns[-2:] == ["mark", "__d"]


def test_item_blocks_and_own_answers(docs, spark, monkeypatch):
    rows, items, _ = corpus(3)
    bench = spark.createDataFrame([(*x, "no such answer") for x in items[:8]], "item_id long, text string, a string")
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 3)
    got = dc.leaks(docs(rows[:120]), bench, "a").collect()
    assert got and not any(r.has_answer for r in got)
    verbatim = {(d, i) for d, t in rows[:120] for i, x in items[:8]
                if slow_lcs(dc.words_of(x), dc.words_of(t)) >= .8 * len(dc.words_of(x)) and " ".join(dc.words_of(x)) in
                " ".join(dc.words_of(t))}
    assert verbatim <= {(r.doc_id, r.item_id) for r in got}


def test_sketch_is_the_product_of_the_passages(docs, spark, monkeypatch):
    rows, items, _ = corpus(4)
    block = dc._Items([(i, t, None) for i, t in items])
    coded = dc.encode(docs(rows[:50]), block.number)
    seen, n = dc.passage_counts(coded, len(block.number), "<i2")
    a = []
    for _, t in rows[:50]:
        seq = [block.number.get(dc.normal(w), -1) for w in t.encode().split()]
        for k in range(0, len(seq), dc.PASSAGE):
            a.append(np.bincount([x for x in seq[k:k + dc.PASSAGE] if x >= 0], minlength=len(block.number)))
    a = np.array(a)
    assert n == len(a) and (seen == (a > 0).sum(axis=0)).all()
    idf = np.log((1 + n) / (1 + seen)) + 1e-6
    omega = np.random.default_rng(dc.SEED).standard_normal((len(idf), dc.RANK + dc.OVERSAMPLE))
    x = a * idf
    monkeypatch.setattr(dc, "CHUNK", 500)
    monkeypatch.setattr(dc, "FREQUENT", 20)
    assert np.allclose(dc.sketch(coded, idf, seen, "<i2"), x.T @ (x @ omega), rtol=1e-3, atol=1e-1)


def test_nulls_repeats_and_empty(docs, spark):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "..")], "item_id long, text string")
    rows = [(1, item), (1, item), (1, "other text"), (None, f"a {item}"), (5, None), (6, ""), (7, "x " * 300 + item)]
    got = sorted(((r.doc_id, r.item_id) for r in dc.leaks(docs(rows), bench).collect()), key=str)
    assert got == sorted([(d, i) for d in (1, 1, None, 7) for i in (1, 2)], key=str)
    assert sorted(map(str, (r.doc_id for r in dc.drop_leaks(docs(rows), bench).collect()))) == ["1", "5", "6"]
    assert dc.leaks(docs([]), bench).collect() == []
    assert dc.leaks(docs(rows), bench.limit(0)).collect() == []
    assert dc.drop_leaks(docs(rows), bench.limit(0)).count() == 7
