import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from doclake.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Per conversation id its turns (role, text) as the query's contract rebuilds them."""
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def slow(convs):
    """All nodes of the trie, from every prefix of every conversation."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += not children[p]
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def trie_of(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    turns = prefix_trie.turns_in_order(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return got(prefix_trie.trie_nodes(turns, spark.createDataFrame([(c,) for c in convs], "conv_id long")))


def test_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "c", "", None, "a  b c\n"]))
            for c in [*range(0, 90, 3), 20, 40, 61, 62, 63] for t in range(rnd.randint(1, 6))]
    rows += [(7, None, "user", "null turn first"), (7, 1, "b", "tie"), (7, 1, "a", "tie"), (7, 1, "a", "a tie"),
             (None, 0, "user", "no conversation"), (120, 0, "u", "shared"), (120, 1, "u", "shared")]
    rows += rows[:4] + [(c, 0, "u", "only one turn") for c in range(201, 219)]
    spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("extra")).write.parquet(
        f"{tmp_path}/conversations.parquet")
    assert got(queries.op12_prefix_trie(spark, str(tmp_path))) == slow(rebuilt(rows))


def test_nested_copies_and_many_branches(spark):
    """Prefixes of one another, copies, a branch at every depth, and long shared beginnings."""
    def turn(x):
        return ("u", f"word {x}")

    main = [turn(i) for i in range(37)]
    convs = {i: main[:i] for i in range(0, 37, 5)}
    convs |= {100 + i: main[:i] + [turn("off"), turn(i)] for i in range(0, 37, 2)}
    convs |= {200 + i: main[:20] + [turn(x) for x in bin(i)[2:]] for i in range(40)}
    convs |= {300 + i: main for i in range(30)} | {400 + i: [] for i in range(3)}
    assert trie_of(spark, convs) == slow(convs)


def test_long_paths_are_cut_into_stretches(spark, monkeypatch):
    """The same trie where every path spreads over stretches of four turns."""
    monkeypatch.setattr(prefix_trie, "STRETCH", 2)
    main = [("u", f"word {i}") for i in range(23)]
    convs = {1: main, 2: main[:4], 3: main[:8] + [("u", "off")], 4: main[:9] + main[:9], 5: main[:9] + main[:7]}
    assert trie_of(spark, convs) == slow(convs)


def test_batches_cost_few_jobs(spark, monkeypatch):
    """What a batch costs the driver: the trie is one scan whatever its batches, and a batch takes few jobs."""
    tries, build = [], prefix_trie.build
    monkeypatch.setattr(prefix_trie, "build", lambda *a: tries.append(build(*a)) or tries[0])
    convs = {i: [("u", f"word {x}") for x in f"{i:05b}"] for i in range(32)}
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.nextJobId()
    assert trie_of(spark, convs) == slow(convs)
    jobs = scheduler.nextJobId() - before
    assert tries[0].batches >= 3
    for df in (tries[0].paths, tries[0].ends, tries[0].settled):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert jobs < 60 + 36 * tries[0].batches


@pytest.mark.parametrize("convs", [{}, {5: []}, {5: [("a", "b c")], 6: [("a", "b c")]}])
def test_small_cases(spark, convs):
    assert trie_of(spark, convs) == slow(convs)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 70) for b in range(a + 1, 71)]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("f", prefix_trie.two_fattest(F.col("a"), F.col("b")))
    for r in df.collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x)


def test_signatures_differ(spark):
    rows = [(c, p, f"{(c * p) % 7:032x}", 1) for c in range(40) for p in range(1, 9)]
    df = prefix_trie.signatures(spark.createDataFrame(rows, "conv_id long, pos long, hash string, words long"))
    seen = {(r.s1, r.s2): tuple((r.conv_id * p) % 7 for p in range(1, r.pos + 1)) for r in df.collect()}
    assert len(seen) == len(set(seen.values()))
