import random
import re

import numpy as np
from pyspark.sql import functions as F

from doclake.llm import repetition

from llm_helpers import clash, docs  # noqa: F401


def slow(text, least=repetition.MIN_REPEAT):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)

    def covered(k):
        seen, hit = {}, set()
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            if g in seen:
                hit.update(range(i, i + k), range(seen[g], seen[g] + k))
            seen[g] = i
        return hit
    longest = 0
    while covered(longest + 1):
        longest += 1
    lines, n_dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(covered(3)),
            len(covered(least)), longest)


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t", "one", "a a", "a a a a a", "# $x\n\n$x\n # $x\n$x", "é\x85ü\xa0ß x\x1cy"]
    for n in (5, 30, 80, 200, 400):
        for v in (2, 8, 300):
            out.append(" ".join(rng.choice(["a", "bé", "c<", "d", "e", "f", "g", "h"][:v]) if v < 300
                                else f"w{rng.randrange(v)}" for _ in range(n)))
    line = " ".join(f"l{i}" for i in range(25))
    out += ["\n".join([line] * 9), f"{line} x {line} y " + " ".join(f"z{i}" for i in range(500)), "Und " * 700,
            " ".join(f"z{i}" for i in range(80)) + f" {line}\n" * 3]
    return out


def test_counts_against_brute_force(docs):
    rows = list(enumerate(texts()))
    got = {r.doc_id: tuple(r)[1:] for r in repetition.repetition_stats(docs(rows)).collect()}
    for i, t in rows:
        assert got[i] == slow(t), (i, t and t[:60])


def test_verdicts(docs):
    rows = list(enumerate(texts()))
    stats = repetition.verdicts(repetition.repetition_stats(docs(rows)))
    for r in stats.collect():
        n, _, _, _, rep, cov, longest = slow(rows[r.doc_id][1])
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert r.kept == (not r.base_failed and cov <= 0.3 * n and longest <= 100)
    assert {r.kept for r in stats.collect()} == {True, False}
    kept = repetition.drop_repetitive(docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in stats.collect() if r.kept)
    assert kept.columns == docs(rows).columns


def test_suffix_array_over_several_texts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = rng.integers(0, 40, 6)
        word = np.concatenate([rng.integers(0, 3, s) + 3 * k for k, s in enumerate(sizes)])
        ends = np.cumsum(sizes)
        best = repetition.repeat_lengths(word, np.repeat(ends, sizes))
        for k, (lo, hi) in enumerate(zip(ends - sizes, ends)):
            t = word[lo:hi].tolist()
            for i in range(len(t)):
                want = max((next((d for d in range(len(t)) if max(i, j) + d >= len(t) or t[i + d] != t[j + d]), 0)
                            for j in range(len(t)) if j != i), default=0)
                assert best[lo + i] == want


def test_small_batches_give_equal_results(docs, monkeypatch):
    rows = list(enumerate(texts()))
    monkeypatch.setattr(repetition, "BATCH_WORDS", 50)
    got = {r.doc_id: tuple(r)[1:] for r in repetition.repetition_stats(docs(rows)).collect()}
    assert all(got[i] == slow(t) for i, t in rows)


def test_empty_repeated_and_clashing(docs):
    assert repetition.drop_repetitive(docs([])).collect() == []
    good = " ".join(f"w{i}" for i in range(60))
    df = clash(docs([(1, good), (1, good), (None, good), (2, None)]), "kept", "n_words", "base_failed")
    out = repetition.drop_repetitive(df)
    assert out.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "1", "None"]
    assert out.where(F.col("kept") == "extra").count() == 3


def test_registered_columns_stand_in_contract_order(spark):
    from doclake.llm.queries import op5_repetition
    assert op5_repetition(spark, "/root/testdata/sf0.001").columns == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words"]
