import random

import numpy as np
import xxhash

from doclake.llm import simhash
from doclake.llm.components import components

from llm_helpers import clash, docs  # noqa: F401


def slow_print(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(prints, bits=3):
    """Component (smallest index) of each fingerprint by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    for t in ["", " \t\n", "One", "one two", "A b C d", "É é\x85x y z\xa0q", "a b c " * 999,
              "x" * 70000 + " y z", "Ω " * 70000]:
        assert simhash.fingerprint(t.encode()) == slow_print(t)


def test_query_against_all_pairs(docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(1, 300))]
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows), " ".join(t)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "\n")]
    prints = [slow_print(t) for _, t in rows]
    want = {(i, f"{p:016x}", g) for (i, _), p, g in zip(rows, prints, slow_groups(prints))}
    got = simhash.near_copy_groups(clash(docs(rows), "fp", "root", "__t"))
    assert {tuple(r) for r in got.collect()} == want
    kept = simhash.drop_near_copies(clash(docs(rows), "fp", "root")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({g for *_, g in want})
    assert kept[0].fp == "extra"


def test_index_finds_all_links_of_a_bucket():
    rng = np.random.default_rng(1)
    for n, flips in ((2, 2), (40, 3), (700, 5), (1500, 3), (900, 64)):
        centre = rng.integers(0, 1 << 63, 3, dtype="uint64")
        fps = set()
        for _ in range(n):
            f = int(rng.choice(centre))
            for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
                f ^= 1 << int(b)
            fps.add(f)
        fps = np.array(sorted(fps), "uint64")
        fps = fps[np.argsort(simhash.gray_rank(fps))]
        got = simhash.bucket_roots(fps, 3)
        assert got.tolist() == slow_groups([int(x) for x in fps])


def test_links_of_random_fingerprints(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for f in list(fps):
        for _ in range(rng.randint(0, 3)):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([((f ^ (1 << 63)) - (1 << 63),) for f in fps], "fp long")
    roots = {r.node % 2**64: r.root % 2**64 for r in components(simhash.fingerprint_links(df)).collect()}
    ours = [roots.get(f, f) for f in fps]
    slow = slow_groups(fps)
    assert [ours.index(x) for x in ours] == slow


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 80)}


def test_ties_nulls_and_empty(docs):
    rows = [(None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (4, "other words here now")]
    got = sorted((tuple(r) for r in simhash.near_copy_groups(docs(rows)).collect()), key=str)
    assert sorted((r[0], r[2]) for r in got if r[0]) == [(4, 4), (9, 9), (9, 9)]
    assert [r[2] for r in got if r[0] is None] == [9]
    kept = simhash.drop_near_copies(docs(rows)).collect()
    assert sorted(r.doc_id for r in kept) == [4, 9]
    assert [r.text for r in simhash.drop_near_copies(docs([(None, "x y")] * 3)).collect()] == ["x y"]
    assert simhash.near_copy_groups(docs([])).collect() == []
    assert simhash.drop_near_copies(docs([])).collect() == []
