import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from doclake.operators import pii

# text -> its detections, written out by hand; at least one per rule, and what each rule must not take
FIXTURE_CASES = {
    "SSN 123-45-6789.": [("ssn", "123-45-6789", 4, 15, "high")],
    "SSN 123-45-67890": [("zip_code", "67890", 11, 16, "low")],
    "1234 5678-90123456": [("account_number", "1234 5678-90123456", 0, 18, "high")],
    "card 12345678901234567": [],
    "mail a.b+c@x.co, z": [("email", "a.b+c@x.co", 5, 15, "high")],
    "mail A_B@HOST.ORG": [("email", "A_B@HOST.ORG", 5, 17, "high")],
    "a pipe counts: a@b.|x": [("email", "a@b.|x", 15, 21, "high")],
    "no domain: a@b": [],
    "call 555.123.4567": [("phone", "555.123.4567", 5, 17, "medium")],
    "call 5551234567 now": [("phone", "5551234567", 5, 15, "medium")],
    "call (555) 123-4567": [],
    "12 Oak Street": [("address", "12 Oak Street", 0, 13, "medium")],
    "4 \n Elm\tLN.": [("address", "4 \n Elm\tLN", 0, 10, "medium")],
    "90210-1234 or 90210": [("zip_code", "90210-1234", 0, 10, "low"), ("zip_code", "90210", 14, 19, "low")],
    "x90210 902101": [],
    "3 boxes test": [("address", "3 boxes test", 0, 12, "medium")],
    "Customer: Mary Poole": [("personal_name", "Mary Poole", 10, 20, "medium")],
    "Signed: Jane Moss": [("personal_name", "Jane Moss", 8, 17, "medium")],
    "dear lucy moor": [("personal_name", "lucy moor", 5, 14, "medium")],
    "Name: Lucy Finch": [],
    "Mr. Tom\nReed": [("personal_name", "Tom\nReed", 4, 12, "medium")],
    "From Nell Brook": [],
    "Dear Vincent Hale": [],
    "Dear Ruth Gould, date": [],
    "To Ford Bank": [],
    "Client: Acme Inc": [],
    "By: Della Ghent Associates": [],
    "": [],
    "To To To Ann Lee": [("personal_name", "To To", 3, 8, "medium")],
    "Ünïcode é 123-45-6789": [("ssn", "123-45-6789", 10, 21, "high")],
}
RULES = ["ssn", "account_number", "email", "phone", "address", "zip_code", "personal_name"]


def _spark_detect(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    staged = pii.with_detections(df)
    rows = {r.id: [tuple(d) for d in r.detections] for r in staged.select("id", "detections").collect()}
    return [rows[i] for i in range(len(texts))]


def test_fixture_cases(spark):
    texts = list(FIXTURE_CASES)
    for t, g in zip(texts, _spark_detect(spark, texts)):
        assert g == FIXTURE_CASES[t], t


def test_cases_behind_one_another(spark):
    """Texts of several cases, far enough apart: the detections of each, moved, by rule and then by place."""
    rnd = random.Random(7)
    wall = "\n" + "=" * 80 + "\n"
    texts, want = [], []
    for _ in range(150):
        text, found = "", []
        for case in rnd.sample(list(FIXTURE_CASES), rnd.randint(2, 9)):
            found += [(k, x, s + len(text), e + len(text), c) for k, x, s, e, c in FIXTURE_CASES[case]]
            text += case + wall
        texts.append(text)
        want.append(found)
    for t, g, w in zip(texts, _spark_detect(spark, texts), want):
        assert sorted(g) == sorted(w), t
        places = [(RULES.index(k), s) for k, _, s, _, _ in g if k != "personal_name"]
        assert places == sorted(places)


def _holds(text, found):
    """What every detection satisfies, whatever the text."""
    last = {}
    for kind, part, start, end, confidence in found:
        assert text[start:end] == part and start < end
        assert confidence == {"ssn": "high", "account_number": "high", "email": "high", "zip_code": "low"}.get(kind, "medium")
        digits = sum(c.isdigit() for c in part)
        assert {"ssn": digits == 9 and part.count("-") == 2, "account_number": digits == 16, "email": "@" in part and "." in part,
                "phone": digits == 10, "address": part[0].isdigit() and part[-1].isalpha(), "zip_code": digits in (5, 9),
                "personal_name": len(part.split()) == 2}[kind]
        if kind != "personal_name":  # one rule's matches come in order and don't overlap
            assert start >= last.get(kind, 0)
            last[kind] = end
    order = [RULES.index(f[0]) for f in found]
    assert order == sorted(order)


def test_documents_hold_the_properties(spark):
    texts = [t or "" for t in pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text"]).column("text").to_pylist()]
    got = _spark_detect(spark, texts)
    for t, g in zip(texts, got):
        _holds(t, g)
    assert sum(map(len, got)) > 50


def test_random_strings_hold_the_properties(spark):
    rnd = random.Random(7)
    pieces = ["123-45-6789", "555.123.4567", "90210", "-1234", "1234 5678 9012 3456", "a.b@x.org", "@", ".",
              "12 Main St", " Street", "Dear ", "To ", "From ", "Name: ", "Signed: ", "By:", "Mary Poole",
              "Acme Inc", "Ford Bank", " at ", "date", "\n", "  ", "Ünïcode ", "é", "x", "0", "-", "_"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    for t, g in zip(texts, _spark_detect(spark, texts)):
        _holds(t, g)


def test_summary_and_masking(spark):
    pages = spark.createDataFrame([("d1", 1, "SSN 123-45-6789 and 90210"), ("d1", 2, "nothing"),
                                   ("d2", 1, "")], "document_id string, page_no int, text string")
    s = pii.document_summary(pii.with_detections(pages), "document_id")
    rows = {r.document_id: r for r in s.collect()}
    assert rows["d1"].total_pages == 2 and rows["d1"].pages_with_pii == 1
    assert rows["d1"].total_pii_instances == 2 and rows["d1"].pii_types_detected == ["ssn", "zip_code"]
    assert rows["d2"].detected_pii is False
    row = spark.createDataFrame([("abcdefghij", [(1, 3), (2, 5), (5, 6), (8, 9)]), (None, None)],
                                "text string, detections array<struct<start_pos:int,end_pos:int>>")
    out = [r.masked_text for r in pii.with_masked_text(row, mask="#").collect()]
    # overlapping spans merge, an adjacent span starts a new mask
    assert out == ["a##gh#j", ""]


def test_boxes_exact_then_first_containing_line(spark):
    lines = spark.createDataFrame([
        ("p", 1, "Call 555.123.4567 now", (0.1, 0.1, 0.5, 0.1)),
        ("p", 2, "SSN 123-45-6789", (0.1, 0.3, 0.5, 0.1)),
        ("p", 3, "call 555.123.4567", (0.1, 0.5, 0.5, 0.1)),
        ("p", 4, "Call 555.123.4567 now", (0.2, 0.7, 0.5, 0.1)),
    ], "page string, line_ord int, text string, bbox struct<Left:double,Top:double,Width:double,Height:double>")
    page_text = lines.groupBy("page").agg(F.array_join(F.sort_array(F.collect_list(
        F.struct("line_ord", "text"))).text, "\n").alias("text"))
    det = pii.explode_detections(pii.with_detections(page_text), ["page"])
    boxes = {r.pii_text: r.bbox for r in pii.map_to_boxes(det, lines, page_text, ["page"]).collect()}
    # first line containing the phone is line 1, whose duplicate (line 4) gives the box
    assert tuple(boxes["555.123.4567"]) == (0.2, 0.7, 0.5, 0.1)
    assert tuple(boxes["123-45-6789"]) == (0.1, 0.3, 0.5, 0.1)
    rect = spark.createDataFrame([((0.99, 0.0, 0.5, 0.01),)], "b struct<Left:double,Top:double,Width:double,Height:double>") \
        .select(pii.redaction_rect(F.col("b"), F.lit(1000), F.lit(800)).alias("r")).collect()[0].r
    assert tuple(rect) == (982, 0, 1000, 16)


def test_boxes_in_page_matches_join_form(spark):
    row = spark.createDataFrame([(
        "p",
        [("Call 555.123.4567 now", (0.1, 0.1, 0.5, 0.1)), ("SSN 123-45-6789", (0.1, 0.3, 0.5, 0.1)),
         ("call 555.123.4567", (0.1, 0.5, 0.5, 0.1)), ("Call 555.123.4567 now", (0.2, 0.7, 0.5, 0.1)),
         ("Dear Ann Lee", (0.1, 0.9, 0.5, 0.1))],
    )], "page string, lines array<struct<text:string,bbox:struct<Left:double,Top:double,Width:double,Height:double>>>")
    row = row.withColumn("text", F.array_join(F.transform("lines", lambda l: l["text"]), "\n"))
    got = {b.m.text: tuple(b.m.bbox) for b in pii.boxes_in_page(pii.with_detections(row)).first().boxes}
    assert got["555.123.4567"] == (0.2, 0.7, 0.5, 0.1)
    assert got["123-45-6789"] == (0.1, 0.3, 0.5, 0.1)
    assert got["Ann Lee"] == (0.1, 0.9, 0.5, 0.1)


def test_work_is_linear_in_matches_and_lines():
    """Twice the matches and lines take about twice the time."""
    import time

    import pyarrow as pa
    from doclake.functions import pii as rules

    def seconds(n):
        text = " ".join(f"Name: Ann Lee{chr(97 + i % 26)} {10000 + i} 555-123-{i % 10000:04d}" for i in range(n))
        t0 = time.process_time()
        found = rules._detections(pa.array([text]))
        assert len(found[0]) > 2 * n
        return time.process_time() - t0
    seconds(500)
    small, large = min(seconds(10000) for _ in range(3)), min(seconds(20000) for _ in range(3))
    assert large < 3 * small
