import random

from doclake.llm import decontaminate as dc

from llm_helpers import docs  # noqa: F401


def every_leak(rows, items):
    """All windows of all texts against all items, no candidate test."""
    out = set()
    for d, text in rows:
        words = dc.words_of(text)
        for i, item in items:
            w = dc.words_of(item)
            number = {x: k for k, x in enumerate(dict.fromkeys(w))}
            a = [number[x] for x in w]
            reach = max(dc.STRIDE, len(w))
            for at in range(0, max(1, len(words) - dc.STRIDE), dc.STRIDE):
                part = [number.get(x, -1) for x in words[max(0, at - reach):at + dc.PASSAGE + reach]]
                share = dc.common_subsequence(a, part) / len(a)
                if share >= dc.NEAR_VERBATIM or share >= dc.PARAPHRASE and dc._holds(a[-dc.ANSWER_WORDS:], part):
                    out.add((d, i))
                    break
    return out


def test_items_beside_repeated_benchmark_words(docs, spark):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    word = lambda: rng.choice(common) if rng.random() < .5 else f"w{rng.randrange(4000)}"
    items = [(i, [word() for _ in range(rng.choice([1, 9, 18, 40, 70, 150]))]) for i in range(40)]
    rare = sorted({w for _, x in items for w in x if w[0] == "w"})
    rows, planted = [], set()
    for d in range(240):
        i, w = items[d % 40]
        w = list(w)
        if d % 3 == 1 and len(w) > 8:  # a paraphrase that keeps its answer
            for k in rng.sample(range(len(w) - 5), (len(w) - 5) // 3):
                w[k] = f"p{rng.randrange(99)}"
        n = (0, 20, 40, 64)[d % 4]
        foreign = [rng.choice(rare)] * n if d % 2 else [rng.choice(rare) for _ in range(n)]
        t = [word() for _ in range(rng.randint(0, 60))] + foreign + w + foreign + [word() for _ in range(rng.randint(0, 60))]
        rows.append((d, " ".join(t)))
        planted.add((d, i))
    rows += [(1000, items[3][1][0]), (1001, "")]
    bench = [(i, " ".join(w)) for i, w in items]
    got = dc.leaks(docs(rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert planted <= found and found == every_leak(rows, bench) and len(got) == len(found)
