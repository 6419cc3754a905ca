import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from doclake.llm import quality

from llm_helpers import clash, docs  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def logistic(z):
    return 1 / (1 + math.exp(-z))


def strength(groups):
    """groups: (n, rate, prior)"""
    noise = sum(m * (1 - m) for _, _, m in groups)
    spread = sum(n * (r - m) ** 2 for n, r, m in groups) - noise
    total = sum(n for n, _, _ in groups)
    size = total - sum(n * n for n, _, _ in groups) / total
    between = max(spread / max(size, 1.0), 1e-9)
    within = sum(n * m * (1 - m) for n, _, m in groups) / total
    return min(max(within / between - 1, 1.0), quality.MAX_PRIOR)


def slow_posteriors(rows):
    """rows: (host, path, log odds)"""
    paths, hosts = defaultdict(list), defaultdict(list)
    for h, p, z in rows:
        paths[h, p].append(logistic(z))
        hosts[h].append(logistic(z))
    base = np.mean([logistic(z) for *_, z in rows])
    k = strength([(len(v), np.mean(v), base) for v in hosts.values()])
    host = {h: (sum(v) + k * base) / (len(v) + k) for h, v in hosts.items()}
    k2 = strength([(len(v), np.mean(v), host[h]) for (h, _), v in paths.items()])
    return base, host, {(h, p): (sum(v) + k2 * host[h]) / (len(v) + k2) for (h, p), v in paths.items()}


def test_site_posteriors_against_plain_formulas(spark):
    rng = random.Random(1)
    for spread in (0.0, 2.0):
        rows = []
        for h in [None, *"abcdefgh"]:
            centre = rng.gauss(1, spread)
            for p in [None, "x", "y"]:
                rows += [(h, p, rng.gauss(centre, 1)) for _ in range(rng.randint(1, 40))]
        base, host, path = slow_posteriors(rows)
        df = spark.createDataFrame(rows, "host string, path string, z double").repartition(3)
        got = quality.site_posteriors(df, "z").collect()
        assert len(got) == len(path)
        for r in got:
            assert r.base == pytest.approx(base) and r.host_post == pytest.approx(host[r.host])
            assert r.path_post == pytest.approx(path[r.host, r.path])


def planted(seed=3, n=700):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = rng.random() < .2, rng.random() < .2
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(40, 200))]
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = f"scoundrel{rng.choice(['s', 'ly', ',', ''])}"
        rows.append((i, " ".join(words), f"host{rng.randrange(9)}"))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_combination(docs, spark):
    rows, labels = planted()
    known = spark.createDataFrame(labels[:400] + [(1, None, None), (2, 1, None), (None, 1, 1)], LABELS)
    out = quality.quality_verdicts(clash(docs(rows), "host", "quality"), known, F.col("source"), F.col("lang")).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == 700
    right = sum(got[i].kept == (q == 1 and t == 0) for i, q, t in labels[400:])
    assert right >= 0.98 * 300
    for c in ("quality", "toxic"):
        base, host, path = slow_posteriors([(r.host, r.path, r[f"{c}_logit"]) for r in out])
        for r in out[:50]:
            odds = r[f"{c}_logit"] + math.log(path[r.host, r.path] / (1 - path[r.host, r.path])) - math.log(base / (1 - base))
            assert r[f"p_{c}"] == pytest.approx(logistic(odds), abs=1e-6)
    assert all(r.kept == (r.p_quality >= .5 and r.p_toxic < .5) for r in out)


def test_bound_on_labelled_documents(docs, spark):
    rows, labels = planted(4, 60)
    few = quality.labelled_features(docs(rows), spark.createDataFrame(labels, LABELS), 25)
    assert few.count() == 25


def test_nulls_repeats_single_class_and_empty(docs, spark):
    rows = [(1, None, None), (1, None, None), (None, "a b c", "s"), (2, "", "s"), (3, "x " * 50000, "s")]
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(9, 0, 1)]):
        out = quality.quality_verdicts(docs(rows), spark.createDataFrame(labels, LABELS), F.col("source"), F.lit(None))
        got = out.collect()
        assert len(got) == 5 and all(r.kept for r in got)
    empty = quality.quality_verdicts(docs([]), spark.createDataFrame([], LABELS), F.col("source"), F.col("lang"))
    assert empty.collect() == []
