import random

from doclake.llm import suffixes

from llm_helpers import clash, docs  # noqa: F401


def slow(rows, k):
    """Words (doc, later) covered by windows of k words that occur twice or more."""
    places, cover, across = {}, {}, {}
    for row, (doc, text) in enumerate(rows):
        w = (text or "").encode().split()
        for i in range(len(w) - k + 1):
            places.setdefault(tuple(w[i:i + k]), []).append((-1 if doc is None else doc, i, row))
    for ps in places.values():
        if len(ps) > 1:
            first = min(ps)[:2]
            for doc, i, _ in ps:
                key = (doc, (doc, i) != first)
                cover.setdefault(key, set()).update(range(i, i + k))
                across.setdefault(key, set()).update(
                    range(i, i + k) if len({p[0] for p in ps}) > 1 else ())
    return cover, across


def covered(spans):
    cover, across = {}, {}
    for r in spans:
        key = (-1 if r.doc_id is None else r.doc_id, r.later_copy)
        words = set(range(r.start_word, r.end_word))
        assert not cover.setdefault(key, set()) & words
        cover[key] |= words
        if r.across_documents:
            across.setdefault(key, set()).update(words)
    return cover, across


def corpus(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randint(6, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 4) if rng.random() < .5 else 0
            t += p[a:len(p) - rng.randint(0, 4)] + [word() for _ in range(rng.randint(0, 10))]
        rows.append((i, " ".join(t)))
    rows.append((n, rows[0][1]))
    rows.append((n + 1, rows[1][1] + "\n" + rows[1][1]))
    return rows


def test_against_all_windows(spark, docs):
    for seed, k, anchor, vocabulary in ((1, 12, 6, 400), (2, 9, 3, 400), (3, 8, 8, 3), (4, 10, 4, 2)):
        rows = corpus(seed, vocabulary=vocabulary)
        want, across = slow(rows, k)
        got, got_across = covered(suffixes.repeated_spans(clash(docs(rows), "pos", "doc", "head"), k, anchor).collect())
        assert got == want
        assert all(got_across.get(key, set()) >= words for key, words in across.items())


def test_many_borders(spark, docs):
    """More partitions than rows in most: every suffix is a border case."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        rows = corpus(7, 15)
        assert covered(suffixes.repeated_spans(docs(rows), 10, 5).collect())[0] == slow(rows, 10)[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_passage_in_a_third_of_the_rows(docs):
    rng = random.Random(3)
    common = " ".join(f"c{i}" for i in range(70))
    rows = [(i, " ".join(f"w{rng.random()}" for _ in range(40)) + (f" {common} " if i % 3 == 0 else " ")
             + " ".join(f"w{rng.random()}" for _ in range(40))) for i in range(300)]
    spans = suffixes.repeated_spans(docs(rows)).collect()
    assert sorted(r.doc_id for r in spans) == [i for i, _ in rows if i % 3 == 0]
    assert all((r.start_word, r.end_word, r.first_doc, r.later_copy, r.across_documents)
               == (40, 110, 0, r.doc_id > 0, True) for r in spans)


def test_repeated_rows_nulls_and_removal(docs):
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, f"x  {text}\ny"), (5, None), (6, ""), (7, "short"), (8, text[::-1]),
            (9, "begin " + text + "  end of it")]
    spans = suffixes.repeated_spans(docs(rows))
    got = {(r.doc_id, r.later_copy): (r.start_word, r.end_word, r.across_documents) for r in spans.collect()}
    assert got[None, False] == (1, 61, True) and got[1, True] == (0, 60, True) and got[9, True] == (1, 61, True)
    left = {r.doc_id: r.text for r in suffixes.drop_repeats(docs(rows), spans).collect()}
    assert left[None] == rows[2][1] and left[1] == "" and left[9] == "begin end of it" and left[5] is None
    assert suffixes.repeated_spans(docs([])).collect() == []


def test_rows_under_one_id_keep_their_own_words(docs):
    """Three rows, two under one id: only the row that holds the copy loses words."""
    a, u, v = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 60), ("u", 20), ("v", 80)))
    rows = [(5, f"{a} {u}"), (5, v), (1, a), (None, v + " x"), (None, f"{a} y")]
    table = clash(docs(rows), "row", "cuts")
    left = suffixes.drop_repeats(table, suffixes.repeated_spans(table))
    assert left.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(5, u), (5, ""), (1, ""), (0, v + " x"), (0, f"{a} y")])


def test_a_third_without_an_id_spreads_over_tasks(spark, docs):
    rng = random.Random(9)
    common = " ".join(f"c{i}" for i in range(60))
    rows = [(None if i % 3 else i, f"{common} " + " ".join(f"w{rng.random()}" for _ in range(30))) for i in range(600)]
    found = suffixes.neighbours(suffixes.kept_suffixes(docs(rows)))
    keys = found.groupBy("doc", "row").count().agg({"count": "max"}).first()[0]
    assert keys <= 40 and found.select("doc", "row").distinct().count() == 600
    spans = suffixes.repeated_spans(docs(rows)).collect()
    assert len(spans) == 600 and {(r.start_word, r.end_word) for r in spans} == {(0, 60)} and sum(not r.later_copy for r in spans) == 1
