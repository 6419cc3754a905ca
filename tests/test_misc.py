import json
import uuid

from pyspark.sql import functions as F

from doclake.operators import ingest as I
from doclake.operators import pages as PG
from doclake.operators import pii
from doclake.operators import state as ST
from doclake.sources import files as FS
from doclake.streaming import jobs as J


def test_listing_and_text_reads(spark, tmp_path):
    root = tmp_path / "bucket"
    (root / "incoming" / "sub").mkdir(parents=True)
    (root / "incoming" / "a-1.jpg").write_bytes(b"1")
    (root / "incoming" / "sub" / "deep.jpg").write_bytes(b"2")
    (root / "staging" / "d").mkdir(parents=True)
    (root / "staging" / "d" / "text_page_1.txt").write_text("hello\nworld")
    keys = {r.object_key for r in FS.list_objects(spark, str(root)).collect()}
    assert keys == {"incoming/a-1.jpg"}  # one folder level, like a delimiter listing
    (root / "staging" / "my doc+1").mkdir()
    (root / "staging" / "my doc+1" / "text_page_2.txt").write_text("x")
    # the keys that the page-text sink writes find their objects
    pages = spark.createDataFrame([("d", 1, ""), ("my doc+1", 2, ""), ("gone", 1, "")], "document_id string, page_ordinal long, text string")
    wanted = PG.page_text_sink(pages).select("text_key")
    got = {r.text_key: r.text for r in FS.texts_for_keys(wanted, FS.read_texts(spark, str(root))).collect()}
    assert got == {"staging/d/text_page_1.txt": "hello\nworld", "staging/my doc+1/text_page_2.txt": "x",
                   "staging/gone/text_page_1.txt": ""}


def test_results_join_and_result_json(spark, tmp_path):
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "d1_response.json").write_text(json.dumps({"schema_passes": ["classification"]}))
    docs = spark.createDataFrame([("d1", "results/d1_response.json"), ("d2", None)], "document_id string, result_key string")
    j = {r.document_id: r.schema_passes
         for r in FS.results_for_documents(docs, FS.read_results(spark, str(tmp_path))).collect()}
    assert j["d1"] == ["classification"] and j["d2"] is None
    pages = spark.createDataFrame([("d", 2, "call 555.123.4567"), ("d", 1, "SSN 123-45-6789")],
                                  "document_id string, page_no int, text string")
    doc = json.loads(pii.result_json(pii.with_detections(pages), "document_id", "page_no").first().result_json)
    assert [d["type"] for d in doc["pii_detections"]] == ["ssn", "phone"]  # page order
    assert doc["processing_summary"]["pages_with_pii"] == 2 and doc["status"] == "PII_PROCESSED"


def test_prefix_siblings_pairing_append_confidence(spark):
    docs = spark.createDataFrame([("1", "ORD12"), ("2", "ORD3"), ("3", None)], "document_id string, original_filename string")
    assert [r.document_id for r in ST.by_filename_prefix(docs, "ORD1").collect()] == ["1"]
    listing = spark.createDataFrame([("a", "k1"), ("a", "k2"), ("b", "k3")], "base_name string, object_key string")
    trig = spark.createDataFrame([("a",)], "base_name string")
    assert sorted(r.object_key for r in I.siblings(listing, trig).collect()) == ["k1", "k2"]
    msg = spark.createDataFrame([("d", ["p1", "p2", "p3"], ["t1", "t2"])],
                                "document_id string, pages array<string>, ocr_text_keys array<string>")
    pairs = [(r.page_no, r.page_key, r.text_key) for r in pii.pair_pages_with_text_keys(msg).collect()]
    assert pairs == [(1, "p1", "t1"), (2, "p2", "t2")]
    arr = spark.createDataFrame([(["a"],)], "x array<string>")
    assert arr.select(ST.append_if_absent(F.col("x"), F.lit("a")).alias("y")).first().y == ["a"]
    t = spark.createDataFrame([("90210 and 123-45-6789",)], "text string")
    high = pii.with_detections(t, min_confidence="medium").first().detections
    assert [d.type for d in high] == ["ssn"]


def test_stream_dedupe_late_split_and_pii_branch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [{"object_key": f"incoming/{b}", "content_type": "image/png", "event_time": f"2026-01-01T00:00:0{i}",
             "bucket": "b"} for i, b in enumerate(["x-1.png", "x-2.png", "y-1.png"])]
    (folder / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    s = J.object_arrivals(spark, str(folder))
    from doclake.session import checkpoint_path
    q = (J.dedupe_bases(s).writeStream.format("memory").queryName("dd").outputMode("append")
         .option("checkpointLocation", checkpoint_path(spark, f"test-dd-{uuid.uuid4().hex}")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.base_name for r in spark.table("dd").collect()) == ["x", "y"]
    batch = spark.createDataFrame([("x", "k1"), ("z", "k2")], "base_name string, object_key string")
    docs = spark.createDataFrame([("x",)], "original_filename string")
    new, late = J.split_late_pages(batch, docs)
    assert [r.base_name for r in new.collect()] == ["z"] and [r.base_name for r in late.collect()] == ["x"]
    texts = spark.createDataFrame([("d", 1, "mail a@b.co")], "document_id string, page_no int, text string")
    det = J.pii_branch(texts, ["document_id", "page_no"]).collect()
    assert [(d.pii_type, d.start_pos) for d in det] == [("email", 5)]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from doclake.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_paginated_ocr_responses_are_numbered(spark, tmp_path):
    (tmp_path / "ocr" / "p").mkdir(parents=True)
    for n in (2, 10):
        (tmp_path / "ocr" / "p" / f"part-{n}.json").write_text(
            json.dumps({"Blocks": [{"BlockType": "LINE", "Text": f"line {n}"}]}))
    r = FS.read_ocr_responses(spark, str(tmp_path), "ocr/").withColumn("page", F.lit("p"))
    assert sorted((x.response_key, x.part_no) for x in r.collect()) == [("ocr/p/part-10.json", 10), ("ocr/p/part-2.json", 2)]
    assert PG.page_text_from_parts(r, ["page"]).first().text == "line 2\nline 10"
