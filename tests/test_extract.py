import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.operators import extract as X


def _resp(spark, rows):
    data = []
    for i, (status, content) in enumerate(rows):
        body = json.dumps({"choices": [{"message": {"content": content}}]}) if status == 200 else "err"
        data.append((str(i), f"r{i}", status, body))
    return spark.createDataFrame(data, "document_id string, request_id string, http_status int, body string")


def test_decode_three_way_and_routing(spark):
    cases = [
        (200, '{"document_type": "receipt", "confidence": 0.8}'),   # object -> receipt -> invoice schema
        (200, '{"document_type": null}'),                            # JSON null type stays null
        (200, '{"confidence": 0.2}'),                                # missing -> unknown
        (200, '["a"]'),                                              # non-object JSON cannot be read
        (200, "plain words"),                                        # not JSON -> raw text, unknown
        (200, '{"a": 1} trailing'),                                  # trailing text is not JSON
        (429, None),                                                 # call failed
        (200, '{"document_type": "insurance"}'),                     # map target present
        (200, '{"document_type": "weird"}'),                         # no schema of that name
    ]
    dec = X.decode_responses(_resp(spark, cases))
    out = {r.document_id: r for r in X.classification_outcome(dec, ["classification", "invoice", "insurance"]).collect()}
    assert out["0"].schema_name == "invoice" and out["0"].schema_passes == ["classification", "specific_extraction_invoice"]
    assert out["1"].document_type is None and out["1"].status == "COMPLETE" and out["1"].schema_name is None
    assert out["2"].document_type == "unknown"
    assert out["3"].status == "FAILED" and out["3"].last_error == "'list' object has no attribute 'get'"
    assert out["4"].document_type == "unknown" and out["4"].status == "COMPLETE"
    assert out["5"].document_type == "unknown"
    assert out["6"].status == "FAILED" and out["6"].last_error.startswith("OpenAI API call failed: HTTP error: 429")
    assert out["7"].schema_name == "insurance"
    assert out["8"].schema_name is None and out["8"].schema_passes == ["classification"]
    empty = X.decode_responses(spark.createDataFrame([("x", "rx", 200, '{"choices": []}')],
                                                     "document_id string, request_id string, http_status int, body string"))
    e = X.classification_outcome(empty, ["classification"]).first()
    assert e.status == "FAILED" and e.last_error.startswith("OpenAI API call failed: Request error")
    none = {r.document_id: r for r in X.classification_outcome(dec, ["invoice"]).collect()}
    assert none["0"].status == "FAILED" and none["0"].last_error == "OpenAI API call failed: Unknown error"
    assert none["0"].schema_passes == [] and none["0"].asDict().keys() == out["0"].asDict().keys()
    accepted = X.decode_responses(spark.createDataFrame([("x", "rx", 202, "later")],
                                                        "document_id string, request_id string, http_status int, body string"))
    assert accepted.first().error == "OpenAI API error: 202 - later"


def test_schema_compile_shorthand_and_nesting():
    cat = X.bundled_catalog()
    st = X.compile_schema(cat["classification"])
    assert st["confidence"].dataType == T.DoubleType()
    assert st["key_entities"].dataType == T.ArrayType(T.StringType())
    cc = X.compile_schema(cat["credit_cards"])
    rewards = cc["rewards_program"].dataType
    assert isinstance(rewards, T.StructType)
    assert rewards["bonus_categories"].dataType.elementType["category"].dataType == T.StringType()
    inv = X.compile_schema(cat["invoice"])
    assert inv["line_items"].dataType.elementType["unit_price"].dataType == T.StringType()
    assert X.compile_schema(X.DEFAULT_CATALOG["default"]["classification"])["document_type"].dataType == T.StringType()


def test_prompts_requests_and_provider(spark):
    cat = X.bundled_catalog()
    docs = spark.createDataFrame([("a", "same text"), ("b", "same text"), ("c", "other")],
                                 "document_id string, text string")
    req = X.build_requests(docs, "classification", cat["classification"])
    rows = {r.document_id: r for r in req.collect()}
    assert rows["a"].request_id == rows["b"].request_id != rows["c"].request_id
    assert "IMPORTANT CLASSIFICATION GUIDELINES" in rows["a"].prompt
    payload = json.loads(rows["a"].payload)
    assert payload["temperature"] == 0.1 and payload["max_tokens"] == 2000
    assert [m["role"] for m in payload["messages"]] == ["system", "user"]
    gen = X.build_requests(docs, "specific_extraction_invoice", cat["invoice"]).collect()[0].prompt
    assert "GUIDELINES" not in gen and gen.endswith("follows the schema structure.\n")
    pend = X.pending_requests(req, spark.createDataFrame([(rows["c"].request_id,)], "request_id string"))
    assert pend.count() == 1

    def provider(batches):
        import pandas as pd
        for pdf in batches:
            yield pd.DataFrame({"request_id": pdf["request_id"], "http_status": 200,
                                "body": '{"choices":[{"message":{"content":"{\\"document_type\\":\\"letter\\"}"}}]}'})
    assert [r.n_documents for r in pend.collect()] == [2]
    got = X.call_provider(X.payloads_for(pend, req), provider).collect()
    assert len(got) == 1 and got[0].http_status == 200


def test_violations(spark):
    cat = X.bundled_catalog()["classification"]
    df = spark.createDataFrame([('{"document_type": "memo", "confidence": 1.5}',),
                                ('{"document_type": "invoice", "confidence": 0.5, "industry": "Retail"}',),
                                ('{"industry": "Space"}',)], "c string")
    v = [r.v for r in df.select(X.extraction_violations(F.col("c"), cat).alias("v")).collect()]
    assert v[0] == ["enum:document_type", "range:confidence"]
    assert v[1] == []
    assert v[2] == ["missing:document_type", "missing:confidence", "enum:industry"]
    nested = {"fields": {"a": {"type": "object", "properties": {"b": {"type": "string", "required": True}, "c": "array"}}}}
    df = spark.createDataFrame([('{"a": {"c": "x"}}',), ('{"a": {"b": 1, "c": []}}',), ('{"a": []}',), ("{}",)], "c string")
    v = [r.v for r in df.select(X.extraction_violations(F.col("c"), nested).alias("v")).collect()]
    assert v == [["missing:a.b", "type:a.c"], ["type:a.b"], ["type:a", "missing:a.b"], ["missing:a.b"]]


def test_second_pass_and_result_document(spark):
    cat = X.bundled_catalog()
    docs = spark.createDataFrame([("0", "bill"), ("1", "note"), ("2", "x")], "document_id string, text string")
    first = X.decode_responses(_resp(spark, [(200, '{"document_type": "receipt"}'), (200, "plain"), (500, None)]))
    out = X.classification_outcome(first, sorted(cat))
    req = X.second_pass_requests(docs, out, cat)
    rows = req.collect()
    assert [(r.document_id, r.schema_name, r.pass_name) for r in rows] == [("0", "invoice", "specific_extraction_invoice")]
    assert '"vendor_name"' in rows[0].prompt and "Document Text:\nbill\n" in rows[0].prompt
    got = req.select("document_id", "request_id").join(spark.createDataFrame(
        [(rows[0].request_id, 200, json.dumps({"choices": [{"message": {"content": '{"vendor_name": "V"}'}}]}))],
        X.RESPONSE_SCHEMA), "request_id")
    results = {r.document_id: json.loads(r.result_json)
               for r in X.result_documents(out, first, X.decode_responses(got), "2026-01-01").collect()}
    assert sorted(results) == ["0", "1"]
    a = results["0"]["document_analysis"]
    assert a["classification"]["data"] == {"document_type": "receipt"} and a["classification"]["success"]
    assert a["specific_extraction"]["data"] == {"vendor_name": "V"}
    assert results["0"]["schema_passes"] == ["classification", "specific_extraction_invoice"]
    assert results["1"]["document_analysis"]["classification"] == {
        "success": True, "data": {"raw_text": "plain"}, "raw_response": "plain"}
    typed = X.typed_answers(X.decode_responses(got), cat["invoice"]).first().answer
    assert typed.vendor_name == "V" and typed.line_items is None


def test_catalog_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"fields": {"x": {"type": "string"}}}')
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "notes.txt").write_text("{}")
    cat = X.catalog_dict(X.read_catalog(spark, str(tmp_path)))
    assert list(cat) == ["a"]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "x.txt").write_text("{}")
    assert list(X.catalog_dict(X.read_catalog(spark, str(empty)))) == ["default"]
