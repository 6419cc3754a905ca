from doclake.llm import decontaminate as dc

from llm_helpers import docs  # noqa: F401

ITEM = [f"q{i}" for i in range(20)]


def paraphrase(*tail):
    """An item with six of its words replaced and the given words at its end."""
    return " ".join([f"z{i}" if i in (1, 3, 5, 7, 9, 11) else w for i, w in enumerate(ITEM[:15])] + list(tail))


def test_punctuation_between_the_words_of_the_answer(docs, spark):
    tail = ITEM[15:]
    marked = [*tail[:2], "-", tail[2], "|", "•", *tail[3:]]
    rows = [(1, paraphrase(*tail)), (2, paraphrase(*marked)), (3, paraphrase(*tail[:2], "other", *tail[2:])),
            (4, " ".join("-" for _ in range(300))), (5, "... " * 90 + paraphrase(*marked))]
    bench = spark.createDataFrame([(1, " ".join(ITEM)), (2, " ".join(ITEM[:15] + marked))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.has_answer for r in dc.leaks(docs(rows), bench).collect()}
    assert got == {(d, i): True for d in (1, 2, 5) for i in (1, 2)}


def test_answers_in_words_of_their_own(docs, spark):
    rows = [(1, paraphrase(*ITEM[15:], "by", "the", "Red", "Fox.")), (2, paraphrase(*ITEM[15:])),
            (3, paraphrase(*ITEM[15:], "red", "-", "fox")), (4, "the red fox"), (5, " ".join(ITEM))]
    bench = spark.createDataFrame([(1, " ".join(ITEM), "red fox")], "item_id long, text string, a string")
    got = {r.doc_id: r.has_answer for r in dc.leaks(docs(rows), bench, "a").collect()}
    assert got == {1: True, 3: True, 5: False}
