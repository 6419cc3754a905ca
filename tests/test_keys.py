from pyspark.sql import functions as F

from doclake.operators import ingest as I
from doclake.sources import envelope as V

MANIFEST = [
    ("incoming/DOCA-0.jpeg", "image/jpeg", "DOCA", 0, "document", True),
    ("incoming/DOCA-1.jpeg", "image/jpeg", "DOCA", 1, "document", True),
    ("incoming/DOCA-10.jpeg", "image/jpeg", "DOCA", 10, "document", True),
    ("incoming/DOCA_2.jpeg", "image/jpeg", "DOCA", 2, "document", True),
    ("incoming/a-1_2.jpg", "image/jpeg", "a-1", 2, "document", True),
    ("incoming/report-2024.01.jpg", "image/jpeg", "report", 2024, "document", True),
    ("incoming/single.png", "image/png", "single", None, "document", True),
    ("incoming/scan_1.pdf", "application/pdf", "scan", 1, "document", False),
    ("incoming/scan_1.tiff", "image/tiff", "scan", 1, None, True),
    ("incoming/pack.ZIP", "application/zip", "pack", None, None, False),
    ("incoming/pack.zip", "application/zip", "pack", None, "archive", False),
    ("incoming/.bashrc", None, ".bashrc", None, None, False),
    ("incoming/inv.tar.gz", None, "inv.tar", None, None, False),
]


def _manifest(spark):
    return spark.createDataFrame([(k, c) for k, c, *_ in MANIFEST], "object_key string, content_type string") \
        .withColumn("event_time", F.current_timestamp()).withColumn("bucket", F.lit("b"))


def test_key_rules(spark):
    got = {r.object_key: r for r in I.parse_keys(_manifest(spark)).collect()}
    for key, _, base, page, route, mime in MANIFEST:
        r = got[key]
        assert (r.base_name, r.page_no, r.route, r.mime_ok) == (base, page, route, mime), key


def test_grouping_numeric_and_lexical_order(spark):
    acc = I.accepted_pages(I.parse_keys(_manifest(spark)))
    num = {r.object_key: r.page_ordinal for r in I.page_table(acc).collect()}
    lex = {r.object_key: r.page_ordinal for r in I.page_table(acc, order="lexical").collect()}
    assert [num[f"incoming/DOCA-{i}.jpeg"] for i in (0, 1, 10)] == [1, 2, 4]
    assert num["incoming/DOCA_2.jpeg"] == 3
    assert [lex[f"incoming/DOCA-{i}.jpeg"] for i in (0, 1, 10)] == [1, 2, 3]
    recs = {r.original_filename: r for r in I.document_records(acc).collect()}
    assert recs["DOCA"].pages_received == 4 and recs["DOCA"].ocr_mode == "ASYNC"
    assert recs["single"].ocr_mode == "SYNC" and recs["DOCA"].status == "OCR_RUNNING"
    # same bucket + base -> same id on a retry
    again = {r.original_filename: r.document_id for r in I.document_records(acc).collect()}
    assert again["DOCA"] == recs["DOCA"].document_id


def test_skip_existing_and_moves(spark):
    acc = I.accepted_pages(I.parse_keys(_manifest(spark)))
    docs = spark.createDataFrame([("DOCA",)], "original_filename string")
    left = {r.base_name for r in I.skip_existing(acc, docs).collect()}
    assert "DOCA" not in left and "single" in left
    moves = I.file_moves(I.page_table(acc)).collect()
    for m in moves:
        assert m.new_key == m.old_key.replace("incoming/", f"complete/{m.document_id}/")


def test_envelope_cases(spark):
    rec = '{"eventSource":"aws:s3","s3":{"bucket":{"name":"b"},"object":{"key":"%s"}}}'
    msgs = [
        (1, "aws:sqs", '{"Records":[' + rec % "incoming/a-1.jpg" + "]}"),
        (2, "aws:sqs", '{"Records":[' + ",".join(rec % f"incoming/m-{i}.jpg" for i in range(3)) + "]}"),
        (3, "aws:sqs", '{"Event":"s3:TestEvent"}'),
        (4, "aws:sqs", "not json"),
        (5, "aws:sqs", None),
        (6, "aws:sqs", '{"Records":[' + rec % "incoming/my%20file+2.jpg" + "]}"),
        (7, "aws:sqs", '{"Records":[' + rec % "elsewhere/x.jpg" + "]}"),
        (8, None, '{"Records":[' + rec % "incoming/q.jpg" + "]}"),
    ]
    df = spark.createDataFrame(msgs, "id int, src string, body string")
    out = V.decode_storage_events(df, ["id"], source_col="src", require_sources=True, prefix="incoming/").collect()
    by = {}
    for r in out:
        by.setdefault(r.id, []).append(r)
    assert [r.object_key for r in by[1]] == ["incoming/a-1.jpg"]
    assert sorted(r.object_key for r in by[2]) == [f"incoming/m-{i}.jpg" for i in range(3)]
    assert by[3][0].error_reason == "test_event"
    assert by[4][0].error_reason == "malformed_json" and by[5][0].error_reason == "malformed_json"
    assert by[6][0].object_key == "incoming/my file 2.jpg"
    assert (by[7][0].object_key, by[7][0].error_reason) == ("elsewhere/x.jpg", "outside_prefix")
    assert by[8][0].error_reason == "not_a_queue_record"


def test_pii_message_shapes(spark):
    q = '{"Records":[{"eventSource":"aws:sqs","body":"{\\"document_id\\":\\"d1\\",\\"pages\\":[\\"p1\\"],\\"ocr_text_keys\\":[\\"t1\\"]}"},' \
        '{"eventSource":"aws:sqs","body":"{\\"document_id\\":\\"d2\\",\\"pages\\":[\\"p2\\"],\\"ocr_text_keys\\":[]}"}]}'
    direct = '{"document_id":"d3","pages":["a","b"],"ocr_text_keys":["x"],"bucket_name":"other"}'
    df = spark.createDataFrame([(1, q), (2, direct)], "id int, payload string")
    out = {r.document_id: r for r in V.decode_pii_messages(df, "id", default_bucket="main").collect()}
    assert out["d1"].bucket_name == "main" and out["d1"].error_reason is None
    assert out["d2"].error_reason.startswith("No OCR text keys")
    assert out["d3"].bucket_name == "other"


def test_bad_pii_messages_keep_a_row(spark):
    msgs = [(1, '{"Records":[{"eventSource":"aws:sqs","body":"{bad"},{"eventSource":"other","body":"{}"}]}'),
            (2, "{bad"), (3, None), (4, '{"document_id":"d"} trailing'), (5, '{"document_id":"d"}')]
    out = V.decode_pii_messages(spark.createDataFrame(msgs, "id int, payload string"), "id").collect()
    assert sorted((r.id, r.msg_idx, r.error_reason) for r in out) == [
        (1, 0, "malformed_json"), (1, 1, "not_a_queue_record"), (2, 0, "malformed_json"), (3, 0, "malformed_json"),
        (4, 0, "malformed_json"), (5, 0, "No OCR text keys provided for PII processing")]


def test_queue_batches_and_config_and_history(spark, tmp_path):
    from doclake.operators import flags as FL
    from doclake.operators import pii
    from doclake.sources import files as FS
    batch = '{"Records":[{"eventSource":"aws:sqs","body":"{\\"Event\\":\\"s3:TestEvent\\"}"},{"eventSource":"x","body":"b"}]}'
    rows = V.explode_queue_batch(spark.createDataFrame([(1, batch)], "batch_id int, payload string")).collect()
    assert [(r.msg_idx, r.event_source) for r in rows] == [(0, "aws:sqs"), (1, "x")] and "TestEvent" in rows[0].body
    (tmp_path / "c.json").write_text('{"config_key":"pii_processing","config_type":"feature_flag","enabled":true}')
    flags = FS.read_config(spark, str(tmp_path / "c.json"), "pii_processing", "feature_flag")
    assert FL.read_flag(flags, "pii_processing", "feature_flag")["enabled"] is True
    spark.createDataFrame([("e", "TaskSucceeded"), ("e", "Other")], "execution_id string, type string").write.parquet(
        str(tmp_path / "h"))
    assert [r.type for r in FS.read_history(spark, str(tmp_path / "h")).collect()] == ["TaskSucceeded"]
    key = spark.range(1).select(pii.redacted_image_key(F.lit("d"), F.lit(3)).alias("k")).first().k
    assert key == "results/d_page_3_redacted.jpg"
