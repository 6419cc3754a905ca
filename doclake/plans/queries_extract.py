"""Registered extraction and configuration queries (LLM, CFG bindings)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import extract as X
from doclake.operators import flags as FL
from doclake.plans import bindings as B


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _catalog():
    return X.bundled_catalog()


def _requests(spark, sf_dir):
    cat = _catalog()
    return X.build_requests(B.llm_documents(spark, sf_dir), X.CLASSIFICATION, cat[X.CLASSIFICATION])


def _prompt_sql() -> str:
    pre, post = X.prompt_parts(X.CLASSIFICATION, _catalog()[X.CLASSIFICATION])
    return f"{_q(pre)} || coalesce(text, '') || {_q(post)}"


def llm_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification requests for every document: prompt, payload, request id."""
    r = _requests(spark, sf_dir)
    return r.select(F.col("document_id").alias("doc_id"), "pass_name", "request_id",
                    F.length("prompt").cast("bigint").alias("prompt_chars"), F.md5("prompt").alias("prompt_md5"),
                    F.md5("payload").alias("payload_md5"))


def llm_requests_sql() -> str:
    p = _prompt_sql()
    pay = (f"CAST(json_object('model', '{X.MODEL}', 'messages', json_array("
           f"json_object('role', 'system', 'content', {_q(X.SYSTEM_MESSAGE)}), json_object('role', 'user', 'content', p)),"
           f" 'temperature', {X.TEMPERATURE}, 'max_tokens', {X.MAX_TOKENS}) AS VARCHAR)")
    return f"""
    SELECT doc_id, pass_name, request_id, prompt_chars, prompt_md5, md5({pay}) AS payload_md5 FROM (
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'classification' AS pass_name, p,
             sha256('classification|' || p) AS request_id, CAST(length(p) AS BIGINT) AS prompt_chars,
             md5(p) AS prompt_md5
      FROM (SELECT doc_id, {p} AS p FROM documents))"""


def llm_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct requests without a recorded response (J1): only ids are shuffled."""
    return X.pending_requests(_requests(spark, sf_dir), B.llm_recorded(spark, sf_dir, _catalog()[X.CLASSIFICATION]))


def llm_pending_sql() -> str:
    p = _prompt_sql()
    return f"""
    WITH r AS (SELECT doc_id, sha256('classification|' || {p}) AS request_id FROM documents)
    SELECT request_id, CAST(count(*) AS BIGINT) AS n_documents FROM r
    WHERE request_id NOT IN (SELECT request_id FROM r WHERE doc_id % 4 <> 0)
    GROUP BY request_id"""


def _decoded(spark, sf_dir):
    return X.decoded_for(_requests(spark, sf_dir), B.llm_recorded(spark, sf_dir, _catalog()[X.CLASSIFICATION]))


def llm_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification outcome of every document, pending ones included: type, routing, passes, status
    (H24, H27-H29, C6, C7, T14-T17)."""
    out = X.classification_outcome(_decoded(spark, sf_dir), sorted(_catalog()))
    return out.select(F.col("document_id").alias("doc_id"), "success", "document_type", "schema_name",
                      F.array_join("schema_passes", ",").alias("schema_passes"), "status", "last_error")


def _py_type_sql(k: str) -> str:
    return (f"CASE {k} WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' "
            f"WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END")


def _outcome_ctes() -> str:
    """CTEs up to ``f``: one row per document with its answer and what follows from it."""
    names = sorted(_catalog())
    tmap = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.TYPE_TO_SCHEMA.items())
    in_cat = ", ".join(f"'{n}'" for n in names)
    return f"""
    WITH r AS (SELECT doc_id, {B.LLM_CONTENT_SQL} AS content, {B.LLM_STATUS_SQL} AS http_status,
                      sha256('classification|' || {_prompt_sql()}) AS request_id FROM documents),
    rec AS (SELECT request_id, arg_min(content, doc_id) AS content, arg_min(http_status, doc_id) AS http_status
            FROM r WHERE doc_id % 4 <> 0 GROUP BY request_id),
    d AS (SELECT r.doc_id, rec.http_status = 200 AS success,
                 CASE WHEN rec.http_status = 200 THEN rec.content END AS content, rec.http_status
          FROM r LEFT JOIN rec USING (request_id)),
    k AS (SELECT *, CASE WHEN success AND json_valid(content) THEN json_type(content) END AS kind FROM d),
    t AS (SELECT *,
                 CASE WHEN kind = 'OBJECT' THEN CASE WHEN json_exists(content, '$.document_type')
                                                     THEN json_extract_string(content, '$.document_type') ELSE 'unknown' END
                      WHEN success AND kind IS NULL THEN 'unknown' END AS document_type,
                 CASE WHEN success AND kind IS NOT NULL AND kind <> 'OBJECT'
                      THEN '''' || {_py_type_sql('kind')} || ''' object has no attribute ''get''' END AS read_error
          FROM k),
    s AS (SELECT *, coalesce(CASE document_type {tmap} END, document_type) AS sname FROM t),
    f AS (SELECT *, coalesce(sname IN ({in_cat}), false) AND coalesce(success, false) AND read_error IS NULL AS second FROM s)"""


_PASSES_SQL = "'classification' || CASE WHEN second THEN ',specific_extraction_' || sname ELSE '' END"


def llm_outcomes_sql() -> str:
    return f"""{_outcome_ctes()}
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, success, document_type,
           CASE WHEN second THEN sname END AS schema_name,
           CASE WHEN success IS NULL THEN '' ELSE {_PASSES_SQL} END AS schema_passes,
           CASE WHEN success IS NULL THEN 'LLM_RUNNING' WHEN success AND read_error IS NULL THEN 'COMPLETE'
                ELSE 'FAILED' END AS status,
           CASE WHEN NOT success THEN 'OpenAI API call failed: HTTP error: ' || CAST(http_status AS VARCHAR) || ' - rate limited'
                WHEN read_error IS NOT NULL THEN read_error END AS last_error
    FROM f"""


def _second_requests(spark, sf_dir):
    out = X.classification_outcome(_decoded(spark, sf_dir), sorted(_catalog()))
    return out, X.second_pass_requests(B.llm_documents(spark, sf_dir).select("document_id", "text"), out, _catalog())


def llm_second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-pass requests of every document whose type has a schema."""
    _, r = _second_requests(spark, sf_dir)
    return r.select(F.col("document_id").alias("doc_id"), "schema_name", "pass_name", "request_id",
                    F.md5("prompt").alias("prompt_md5"))


def _second_sql() -> str:
    """CTE ``q``: the documents with a second pass and its prompt."""
    cases = " ".join(f"WHEN '{n}' THEN {_q(X.prompt_parts(X.SPECIFIC_PREFIX + n, sch)[0])} || coalesce(text, '') || "
                     f"{_q(X.prompt_parts(X.SPECIFIC_PREFIX + n, sch)[1])}" for n, sch in sorted(_catalog().items()))
    return f"""q AS (
      SELECT f.doc_id, sname, 'specific_extraction_' || sname AS pass_name, CASE sname {cases} END AS p
      FROM f JOIN documents USING (doc_id) WHERE second)"""


def llm_second_pass_sql() -> str:
    return f"""{_outcome_ctes()}, {_second_sql()}
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, sname AS schema_name, pass_name, sha256(pass_name || '|' || p) AS request_id,
           md5(p) AS prompt_md5 FROM q"""


PROCESSED_AT = "2026-01-01T00:00:00"


def llm_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result document of every finished document: both passes' answers in one JSON text."""
    out, req = _second_requests(spark, sf_dir)
    second = X.decoded_for(req, B.llm_recorded_second(req))
    r = X.result_documents(out, _decoded(spark, sf_dir), second, PROCESSED_AT)
    return r.select(F.col("document_id").alias("doc_id"), "result_key", "result_json")


def llm_results_sql() -> str:
    def call(ok, content, is_json, error):
        return (f"CASE WHEN {ok} THEN '{{\"success\":true,\"data\":' || CASE WHEN {is_json} THEN {content} "
                f"ELSE CAST(json_object('raw_text', {content}) AS VARCHAR) END || ',\"raw_response\":' || "
                f"CAST(to_json({content}) AS VARCHAR) || '}}' "
                f"ELSE '{{\"success\":false,\"error\":' || CAST(to_json({error}) AS VARCHAR) || '}}' END")
    err = ("CASE WHEN b.http_status < 300 THEN 'OpenAI API error: ' ELSE 'HTTP error: ' END "
           "|| CAST(b.http_status AS VARCHAR) || ' - rate limited'")
    return f"""{_outcome_ctes()}, {_second_sql()},
    a2 AS (SELECT doc_id, sha256(pass_name || '|' || p) AS request_id, {B.LLM_SECOND_SQL} AS content,
                  {B.LLM_SECOND_STATUS_SQL} AS http_status FROM q),
    r2 AS (SELECT request_id, arg_min(content, doc_id) AS content, arg_min(http_status, doc_id) AS http_status
           FROM a2 GROUP BY request_id),
    b AS (SELECT a2.doc_id, r2.content, r2.http_status FROM a2 JOIN r2 USING (request_id))
    SELECT CAST(f.doc_id AS VARCHAR) AS doc_id, 'results/' || CAST(f.doc_id AS VARCHAR) || '_response.json' AS result_key,
           '{{"document_analysis":{{"classification":' || {call('true', 'f.content', "f.kind IS NOT NULL", "''")}
           || CASE WHEN b.doc_id IS NOT NULL THEN ',"specific_extraction":' ||
                {call('b.http_status = 200', 'b.content', 'json_valid(b.content)', err)} ELSE '' END
           || '}},"processing_timestamp":"{PROCESSED_AT}","schema_passes":["' || replace({_PASSES_SQL}, ',', '","') || '"]}}'
           AS result_json
    FROM f LEFT JOIN b ON b.doc_id = f.doc_id
    WHERE success AND read_error IS NULL"""


def extraction_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared schema rules checked on every document's classification answer (H25, H26); documents whose answer is
    no object, or still pending, say so."""
    d = X.parsed(_decoded(spark, sf_dir))
    v = X.violations(F.col("parsed"), _catalog()[X.CLASSIFICATION])
    is_object = F.coalesce(F.col("json_kind") == "OBJECT", F.lit(False))
    return d.select(F.col("document_id").alias("doc_id"),
                    F.when(F.col("success").isNull(), "pending").when(is_object, "checked").otherwise("no object").alias("state"),
                    F.when(is_object, F.array_join(v, ",")).alias("violations"))


def _checks_sql(fields: dict, at: str = "$", shown: str = "") -> list[str]:
    checks = []
    for name, spec in fields.items():
        spec = {"type": spec} if isinstance(spec, str) else spec
        path, label = f'{at}."{name}"', f"{shown}{name}"
        val, there = f"json_extract_string(content, '{path}')", f"json_exists(content, '{path}')"
        if spec.get("required"):
            checks.append(f"CASE WHEN NOT {there} THEN 'missing:{label}' END")
        kinds = {"array": "'ARRAY'", "object": "'OBJECT'", "string": "'VARCHAR'", "boolean": "'BOOLEAN'"}.get(
            spec.get("type", "string"), "'BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT'")
        checks.append(f"CASE WHEN {val} IS NOT NULL AND json_type(content, '{path}') NOT IN ({kinds}) THEN 'type:{label}' END")
        if spec.get("enum"):
            lst = ", ".join(_q(e) for e in spec["enum"])
            checks.append(f"CASE WHEN {val} IS NOT NULL AND {val} NOT IN ({lst}) THEN 'enum:{label}' END")
        if name == "confidence":
            num = f"TRY_CAST({val} AS DOUBLE)"
            checks.append(f"CASE WHEN {val} IS NOT NULL AND ({num} IS NULL OR {num} < 0 OR {num} > 1) THEN 'range:{label}' END")
        if spec.get("type") == "object" and spec.get("properties"):
            checks += _checks_sql(spec["properties"], path, f"{label}.")
    return checks


def extraction_check_sql() -> str:
    checks = _checks_sql(_catalog()[X.CLASSIFICATION]["fields"])
    return f"""{_outcome_ctes()}
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
           CASE WHEN success IS NULL THEN 'pending' WHEN kind = 'OBJECT' THEN 'checked' ELSE 'no object' END AS state,
           CASE WHEN kind = 'OBJECT' THEN concat_ws(',', {", ".join(checks)}) END AS violations
    FROM (SELECT doc_id, success, kind, CASE WHEN kind = 'OBJECT' THEN content END AS content FROM f)"""


def extraction_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the second pass read with their schema's compiled type, nested fields included, and its rules
    checked (H25, H26): one row per document and the schemas of this catalog that its answer is read with."""
    _, req = _second_requests(spark, sf_dir)
    d = X.decoded_for(req, B.llm_recorded_second(req)).join(req.select("document_id", "schema_name"), "document_id")
    cat = _catalog()
    inv = X.typed_answers(d.where((F.col("schema_name") == "invoice") & (F.col("json_kind") == "OBJECT")), cat["invoice"])
    bank = X.typed_answers(d.where((F.col("schema_name") == "banking") & (F.col("json_kind") == "OBJECT")), cat["banking"])

    def row(df, name, *cols):
        return df.select(F.col("document_id").alias("doc_id"), "schema_name",
                         *[c.cast("string").alias(n) for n, c in zip(("party", "number", "detail"), cols)],
                         F.array_join(X.extraction_violations(F.col("content"), cat[name]), ",").alias("violations"))
    return row(inv, "invoice", F.col("answer.vendor_name"), F.col("answer.invoice_number"),
               F.get("answer.line_items", F.lit(0))["quantity"]).unionByName(
        row(bank, "banking", F.col("answer.bank_name"), F.col("answer.offer_type"), F.col("answer.fees.annual_fee")))


def extraction_typed_sql() -> str:
    def part(name, a, b, c):
        return f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, sname AS schema_name, json_extract_string(content, '{a}') AS party,
           json_extract_string(content, '{b}') AS number, json_extract_string(content, '{c}') AS detail,
           concat_ws(',', {", ".join(_checks_sql(_catalog()[name]["fields"]))}) AS violations
           FROM j WHERE sname = '{name}'"""
    return f"""{_outcome_ctes()}, {_second_sql()},
    a2 AS (SELECT doc_id, sname, sha256(pass_name || '|' || p) AS request_id, {B.LLM_SECOND_SQL} AS content,
                  {B.LLM_SECOND_STATUS_SQL} AS http_status FROM q),
    r2 AS (SELECT request_id, arg_min(content, doc_id) AS content, arg_min(http_status, doc_id) AS http_status
           FROM a2 GROUP BY request_id),
    j AS (SELECT a2.doc_id, a2.sname, r2.content FROM a2 JOIN r2 USING (request_id)
          WHERE r2.http_status = 200 AND json_valid(r2.content))
    {part("invoice", "$.vendor_name", "$.invoice_number", "$.line_items[0].quantity")}
    UNION ALL {part("banking", "$.bank_name", "$.offer_type", "$.fees.annual_fee")}"""


# schema -> the fields shown as party, number and detail
SHOWN = {"invoice": ("vendor_name", "invoice_number", "line_items[0].quantity"),
         "banking": ("bank_name", "offer_type", "fees.annual_fee"),
         "credit_cards": ("issuer", "card_name", "rewards_program.base_earning_rate"),
         "insurance": ("insurance_company", "insurance_type", "claims_process.24_7_claims")}


def _shown(answer, path: str):
    """A field of a typed answer by its path."""
    for part in path.split("."):
        name, _, at = part.partition("[")
        answer = answer.getField(name)
        if at:
            answer = F.get(answer, F.lit(int(at[:-1])))
    return answer.cast("string")


def extraction_typed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer of the second pass, whichever schema of the catalog it was asked with, read with that schema's
    type and checked by its rules (H25, H26); each answer is parsed once."""
    _, req = _second_requests(spark, sf_dir)
    d = X.decoded_for(req, B.llm_recorded_second(req)).join(req.select("document_id", "schema_name"), "document_id")
    d = X.parsed(d.where(F.col("json_kind") == "OBJECT"))
    cat = _catalog()
    typed = d.select("document_id", "schema_name", "parsed", *[
        F.when(F.col("schema_name") == n, X.typed(F.col("parsed"), cat[n])).alias(f"as_{n}") for n in SHOWN])

    def pick(make):
        return F.coalesce(*[F.when(F.col("schema_name") == n, make(n)) for n in SHOWN])
    return typed.select(
        F.col("document_id").alias("doc_id"), "schema_name",
        *[pick(lambda n, k=k: _shown(F.col(f"as_{n}"), SHOWN[n][k])).alias(c) for k, c in enumerate(("party", "number", "detail"))],
        pick(lambda n: F.array_join(X.violations(F.col("parsed"), cat[n]), ",")).alias("violations"))


def extraction_typed_all_sql() -> str:
    def quoted(path: str) -> str:
        return "$." + ".".join('"' + p.partition("[")[0] + '"' + "".join(p.partition("[")[1:]) for p in path.split("."))

    def part(name):
        shown = ", ".join(f"json_extract_string(content, '{quoted(f)}') AS {c}"
                          for f, c in zip(SHOWN[name], ("party", "number", "detail")))
        return f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, sname AS schema_name, {shown},
           concat_ws(',', {", ".join(_checks_sql(_catalog()[name]["fields"]))}) AS violations
           FROM j WHERE sname = '{name}'"""
    return f"""{_outcome_ctes()}, {_second_sql()},
    a2 AS (SELECT doc_id, sname, sha256(pass_name || '|' || p) AS request_id, {B.LLM_SECOND_SQL} AS content,
                  {B.LLM_SECOND_STATUS_SQL} AS http_status FROM q),
    r2 AS (SELECT request_id, arg_min(content, doc_id) AS content, arg_min(http_status, doc_id) AS http_status
           FROM a2 GROUP BY request_id),
    j AS (SELECT a2.doc_id, a2.sname, r2.content FROM a2 JOIN r2 USING (request_id)
          WHERE r2.http_status = 200 AND json_valid(r2.content))
    {" UNION ALL ".join(part(n) for n in SHOWN)}"""


def pii_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PII feature-flag gate per document, the source acting as bucket."""
    flags = FL.flag_table(spark, [B.PII_FLAG])
    flag = FL.read_flag(flags, "pii_processing", "feature_flag")
    d = B.table(spark, sf_dir, "documents", "doc_id", "source")
    return d.select("doc_id", "source", FL.pii_enabled(F.col("source"), flag).alias("pii_enabled"))


def pii_gate_sql() -> str:
    lst = ", ".join(_q(b) for b in B.PII_FLAG["s3_buckets"])
    en = "true" if B.PII_FLAG["enabled"] else "false"
    return f"""
    SELECT doc_id, source, coalesce({en} AND (len([{lst}]) = 0 OR list_contains([{lst}], source)), false) AS pii_enabled
    FROM documents"""
