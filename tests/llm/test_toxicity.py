import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from doclake.llm import toxicity
from doclake.llm.queries import op11_toxicity
from llm_helpers import clash, docs  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"
BAD = ["zorkel", "blifnak", "grumpfo", "snivelt", "dretchy"]
SYLLABLES = ["an", "er", "tion", "in", "the", "re", "ou", "st", "ing", "ed", "or", "ha"]


def corpus(n, seed=1):
    """(doc_id, text, toxic): prose of syllables, every sixth text with two to five bad words."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4))) for _ in range(rnd.randint(20, 120))]
        toxic = i % 6 == 0
        for _ in range(rnd.randint(2, 5) if toxic else 0):
            words.insert(rnd.randint(0, len(words)), rnd.choice(BAD))
        out.append((i, " ".join(words), int(toxic)))
    return out


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def scores(spark, docs, rows, labels, **kw):
    df = toxicity.toxicity_scores(docs(rows), spark.createDataFrame(labels, LABELS), **kw)
    return {r.doc_id: r for r in df.collect()}


def test_held_out_texts_are_told_apart(spark, docs):
    rows = corpus(900)
    got = scores(spark, docs, [(i, t) for i, t, _ in rows], [(i, 1, y) for i, _, y in rows])
    assert {i: r.held_out for i, r in got.items()} == {i: held_out(i) for i, _, _ in rows}
    test = [(got[i], y) for i, _, y in rows if held_out(i)]
    assert sum(r.predicted == y for r, y in test) >= .95 * len(test)
    pos, neg = [r.score for r, y in test if y], [r.score for r, y in test if not y]
    assert np.mean([p > n for p in pos for n in neg]) > .97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r, _ in test)


def test_held_out_labels_are_never_used(spark, docs):
    """Turning the labels of the rows that are held out changes no score."""
    rows = corpus(300)
    text = [(i, t) for i, t, _ in rows]
    plain = scores(spark, docs, text, [(i, 1, y) for i, _, y in rows])
    turned = scores(spark, docs, text, [(i, 1, 1 - y if held_out(i) else y) for i, _, y in rows])
    assert {i: r.score for i, r in plain.items()} == {i: r.score for i, r in turned.items()}


def test_defined_cases(spark, docs):
    rows = corpus(300)
    long = " ".join(t for _, t, y in rows if not y)
    texts = [(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (1002, long), (1003, long + " zorkel blifnak" * 40),
                                            (None, rows[0][1]), (1004, rows[0][1]), (1004, rows[0][1]), (1005, " \n\t ")]
    labels = [(i, 1, y) for i, _, y in rows] + [(2, 1, None), (None, 1, 1), (0, 1, 0)]
    df = toxicity.toxicity_scores(clash(docs(texts), "t", "gains", "fold", "score"), spark.createDataFrame(labels, LABELS))
    got = df.collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == by[1005].score and by[1000].n_windows == 0 and by[1000].predicted == 0
    assert by[1002].predicted == 0 and by[1003].predicted == 1
    assert by[1004].score == by[0].score == by[None].score and not by[None].held_out
    assert sum(r.doc_id == 1004 for r in got) == 2


@pytest.mark.parametrize("kind", ["none", "one class"])
def test_without_labels_of_both_kinds(spark, docs, kind):
    labels = [] if kind == "none" else [(i, 1, 0) for i in range(30)]
    got = scores(spark, docs, [(i, t) for i, t, _ in corpus(30)], labels)
    assert len(got) == 30 and all(r.predicted == 0 for r in got.values()) and len({r.score for r in got.values()}) == 1


def test_empty_table(spark, docs):
    assert scores(spark, docs, [], [(1, 1, 1)]) == {}


def test_windows_hold_every_word(monkeypatch):
    rnd = random.Random(2)
    for n in [*range(0, 60), 4000]:
        text = b"".join(b"w%d" % i + rnd.choice([b" ", b"\n", b"  \t"]) for i in range(n))
        for chunk in (1 << 20, 50):
            monkeypatch.setattr(toxicity, "CHUNK_BYTES", chunk)
            cut = [w.split() for w in toxicity.windows(text)]
            words = text.split()
            assert all(len(w) <= toxicity.WINDOW for w in cut)
            assert [w for k, c in enumerate(cut) for w in c[k > 0:]] == words
            assert all(a[-1] == b[0] for a, b in zip(cut, cut[1:]))


def test_gain_needs_a_told_phrase():
    base = b" the tion er ing and ouer rethe "
    distance = toxicity.Distance(base, b" plain words here ", b" zorkel blifnak ")
    assert distance.histogram(b"the ouer zorkel and tion blifnak the er ing")[1:].sum() == 1
    assert distance.histogram(b"the ouer and tion the er ing")[1:].sum() == 0


def test_registered_query_finds_the_marked_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = op11_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(
        "held_out and toxic is not null")
    right = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right >= .95
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
