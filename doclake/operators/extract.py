"""Schema-driven classification and extraction.

The language model itself is outside the library: this module builds the
request table (prompt, payload, request id), finds requests without a
response, lets a caller-supplied provider fill them (``mapInPandas``), and
decodes responses into per-document outcomes, routing and validation.
The schema catalog is a handful of small files: it is read with Spark,
collected (bounded by the number of schema files) and used as literals.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.functions import keys as K

# ---------------------------------------------------------------------------
# These must equal the reference's texts for equal requests.
MODEL = "gpt-3.5-turbo"
SYSTEM_MESSAGE = "You are a document analysis assistant. Respond only with valid JSON."
TEMPERATURE = 0.1
MAX_TOKENS = 2000
PROMPT_HEAD = "\nPlease analyze the following document text and extract information according to this schema:\n\nSchema: "
CLASSIFICATION_GUIDELINES = """

IMPORTANT CLASSIFICATION GUIDELINES:
- For document_type: Use "promotion" for ads, marketing materials, offers, deals, or promotional content (email, social media, direct mail, etc.)
- For promotions: Always set the industry field and primary_company field
- For co-branded offers (e.g., "American Airlines Mastercard"): Set primary_company as the main brand (American Airlines) and secondary_company as the partner (Mastercard)
- If document type is unclear, use "other"
- Industry must be one of the exact values listed in the enum
- For Credit Card industry, category should be one of the specific credit card categories listed"""
TEXT_HEAD = "\n\nDocument Text:\n"
CLASSIFICATION_TAIL = "\n\nPlease respond with a JSON object that follows the schema structure exactly.\n"
GENERIC_TAIL = "\n\nPlease respond with a JSON object that follows the schema structure.\n"
CLASSIFICATION = "classification"
SPECIFIC_PREFIX = "specific_extraction_"
# document type -> schema name of the second pass (other types use their own name)
TYPE_TO_SCHEMA = {
    "promotion": "banking",
    "invoice": "invoice",
    "banking": "banking",
    "credit_card": "credit_cards",
    "insurance": "insurance",
    "receipt": "invoice",
    "contract": "invoice",
    "letter": "invoice",
}
DEFAULT_CATALOG = {"default": {"classification": {
    "description": "Classify the document type and extract key information",
    "fields": ["document_type", "confidence", "key_entities"]}}}
UNKNOWN_TYPE = "unknown"
CALL_FAILED = "OpenAI API call failed: "
NO_CLASSIFICATION = CALL_FAILED + "Unknown error"
HTTP_ERROR, API_ERROR = "HTTP error: %d - %s", "OpenAI API error: %d - %s"
NO_CONTENT = "Request error: no message content in the response"
NOT_A_DICT = "'%s' object has no attribute 'get'"
PENDING, COMPLETE, FAILED = "LLM_RUNNING", "COMPLETE", "FAILED"
# ---------------------------------------------------------------------------

# --------------------------------------------------------------- catalog

def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Schema files of a folder as (schema_name, schema_json); unparsable files
    are dropped. The name is the file name with '.json' removed."""
    raw = (spark.read.text(folder, wholetext=True)
           .select(F.col("value").alias("schema_json"), F.col("_metadata.file_name").alias("file_name")))
    return (raw.where(F.col("file_name").endswith(".json") & F.try_parse_json("schema_json").isNotNull())
            .select(F.replace(F.col("file_name"), F.lit(".json"), F.lit("")).alias("schema_name"), "schema_json"))


def catalog_dict(catalog: DataFrame) -> dict:
    """The catalog on the driver (a few small files), with the default entry
    when the folder holds none."""
    out = {r["schema_name"]: json.loads(r["schema_json"]) for r in catalog.collect()}
    return out or dict(DEFAULT_CATALOG)


def bundled_catalog() -> dict:
    """The schemas that come with the package (also when it is shipped as a zip file)."""
    folder = resources.files("doclake").joinpath("resources", "schemas")
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".json")), key=lambda f: f.name)
    return {f.name.replace(".json", ""): json.loads(f.read_text()) for f in files}


_TYPES = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}


def _field_type(spec) -> T.DataType:
    if isinstance(spec, str):  # shorthand: "x": "string" / "array"
        return T.ArrayType(T.StringType()) if spec == "array" else _TYPES.get(spec, T.StringType())
    kind = spec.get("type", "string")
    if kind == "array":
        items = spec.get("items")
        return T.ArrayType(_field_type(items) if items else T.StringType())
    if kind == "object":
        props = spec.get("properties", {})
        return T.StructType([T.StructField(k, _field_type(v)) for k, v in props.items()])
    return _TYPES.get(kind, T.StringType())


def compile_schema(schema: dict) -> T.StructType:
    """Schema file -> Spark struct type (applied to responses with ``from_json``)."""
    fields = schema.get("fields", {})
    if isinstance(fields, list):
        return T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return T.StructType([T.StructField(k, _field_type(v)) for k, v in fields.items()])


# --------------------------------------------------------------- requests

def prompt_parts(pass_name: str, schema: dict) -> tuple[str, str]:
    """(text before the document text, text after it)."""
    head = PROMPT_HEAD + json.dumps(schema, indent=2)
    if pass_name == CLASSIFICATION:
        return head + CLASSIFICATION_GUIDELINES + TEXT_HEAD, CLASSIFICATION_TAIL
    return head + TEXT_HEAD, GENERIC_TAIL


def prompt(text: Column, pass_name: str, schema: dict) -> Column:
    pre, post = prompt_parts(pass_name, schema)
    return F.concat(F.lit(pre), F.coalesce(text, F.lit("")), F.lit(post))


def payload(prompt_col: Column) -> Column:
    """Request body as JSON text."""
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")),
                   F.struct(F.lit("user").alias("role"), prompt_col.alias("content")))
    return F.to_json(F.struct(F.lit(MODEL).alias("model"), msgs.alias("messages"),
                              F.lit(TEMPERATURE).alias("temperature"), F.lit(MAX_TOKENS).alias("max_tokens")))


def request_id(pass_name: Column, prompt_col: Column) -> Column:
    """Content hash: identical prompts share one request (and one response)."""
    return F.sha2(F.concat(pass_name, F.lit("|"), prompt_col), 256)


def with_request(docs: DataFrame, pass_name: str, schema: dict, text_col: str = "text") -> DataFrame:
    """Add ``pass_name``, ``prompt``, ``request_id`` and ``payload`` of one pass to each row (narrow)."""
    return (docs.withColumn("pass_name", F.lit(pass_name)).withColumn("prompt", prompt(F.col(text_col), pass_name, schema))
            .withColumn("request_id", request_id(F.col("pass_name"), F.col("prompt")))
            .withColumn("payload", payload(F.col("prompt"))))


def build_requests(docs: DataFrame, pass_name: str, schema: dict, doc_col: str = "document_id",
                   text_col: str = "text") -> DataFrame:
    """One request per document for one pass (narrow)."""
    return with_request(docs, pass_name, schema, text_col).select(doc_col, "pass_name", "prompt", "request_id", "payload")


def second_pass_requests(docs: DataFrame, outcomes: DataFrame, catalog: dict, doc_col: str = "document_id",
                         text_col: str = "text") -> DataFrame:
    """One request per document whose outcome names a schema of the catalog (C7), for that schema's own pass.

    The prompt parts of the few schemas are literals; only documents that need the pass are joined.
    """
    todo = outcomes.where(F.col("schema_name").isNotNull()).select("document_id", "schema_name")
    joined = docs.withColumnRenamed(doc_col, "document_id").join(todo, "document_id")
    p = F.lit(None).cast("string")
    for name in sorted(catalog):
        p = F.when(F.col("schema_name") == name, prompt(F.col(text_col), SPECIFIC_PREFIX + name, catalog[name])).otherwise(p)
    return (joined.select("document_id", "schema_name", F.concat(F.lit(SPECIFIC_PREFIX), "schema_name").alias("pass_name"),
                          p.alias("prompt"))
            .withColumn("request_id", request_id(F.col("pass_name"), F.col("prompt")))
            .withColumn("payload", payload(F.col("prompt"))))


def pending_requests(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Distinct request ids that have no response yet, with the number of documents that wait for each.

    Only ids travel: the payloads are looked up for what is left (``payloads_for``).
    """
    return (requests.groupBy("request_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_documents"))
            .join(responses.select("request_id"), "request_id", "left_anti"))


def payloads_for(pending: DataFrame, requests: DataFrame, doc_col: str = "document_id") -> DataFrame:
    """(request_id, payload) of the pending ids, from the one request of each that has the smallest document id."""
    first = requests.groupBy("request_id").agg(F.min(doc_col).alias(doc_col)).join(pending, "request_id", "left_semi")
    return requests.join(first, ["request_id", doc_col]).select("request_id", "payload")


RESPONSE_SCHEMA = "request_id string, http_status int, body string"


def call_provider(pending: DataFrame, provider: Callable[[Iterator], Iterator]) -> DataFrame:
    """Fill pending requests with a caller-supplied function over pandas batches
    (``request_id``, ``payload`` in; ``request_id``, ``http_status``, ``body`` out).
    Arrow-batched, spread over all tasks; keep the batch small for remote calls."""
    return pending.mapInPandas(provider, RESPONSE_SCHEMA)


def replay_provider(recorded: DataFrame, pending: DataFrame) -> DataFrame:
    """Default provider: recorded responses, matched by request id (a join)."""
    return pending.select("request_id").join(recorded, "request_id").select("request_id", "http_status", "body")


# --------------------------------------------------------------- responses

_ENVELOPE = T.StructType([T.StructField("choices", T.ArrayType(T.StructType([
    T.StructField("message", T.StructType([T.StructField("content", T.StringType())]))])))])

_PY_TYPE = {"ARRAY": "list", "STRING": "str", "BOOLEAN": "bool", "VOID": "NoneType", "NULL": "NoneType"}


def strict_json(c: Column) -> Column:
    """True when ``c`` is one complete JSON value (no trailing text)."""
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return (c.isNotNull() & wrapped.isNotNull() & listed.isNotNull()
            & (F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1))


def json_kind(c: Column) -> Column:
    """OBJECT / ARRAY / STRING / number / BOOLEAN / VOID of a strict JSON value."""
    s = F.schema_of_variant(F.try_parse_json(c))
    return (F.when(s.startswith("OBJECT"), F.lit("OBJECT")).when(s.startswith("ARRAY"), F.lit("ARRAY"))
             .otherwise(s))


def _py_type_name(kind: Column) -> Column:
    m = F.create_map(*[x for k, v in _PY_TYPE.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[kind], F.when(kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT"),
                                      F.lit("float")).otherwise(F.lit("int")))


def decode_responses(responses: DataFrame) -> DataFrame:
    """Response rows -> success, content, error, JSON shape and document type.

    Status 200: the first choice's content; a strict JSON object is the data, a
    text that is not JSON becomes ``{raw_text}`` (success, type 'unknown'), and
    other JSON values cannot be read as an object (``read_error``). Any other
    status: success false with the error text, which tells a refused call
    (300 and above) from another success code.
    """
    env = F.from_json(F.col("body"), _ENVELOPE)
    content = F.try_element_at(env["choices"], F.lit(1))["message"]["content"]
    ok = F.col("http_status") == 200
    out = responses.withColumn("content", F.when(ok, content))
    is_json = strict_json(F.col("content"))
    kind = F.when(is_json, json_kind(F.col("content")))
    has_key = F.when(kind == "OBJECT", F.array_contains(F.json_object_keys(F.col("content")), "document_type"))
    dtype = (F.when(kind == "OBJECT", F.when(has_key, F.get_json_object(F.col("content"), "$.document_type"))
                    .otherwise(F.lit(UNKNOWN_TYPE)))
              .when(ok & F.col("content").isNotNull() & ~F.coalesce(is_json, F.lit(False)), F.lit(UNKNOWN_TYPE)))
    # a 200 whose body has no first choice is a failed call, like any request error
    no_choice = ok & F.col("content").isNull()
    body = F.coalesce(F.col("body"), F.lit(""))
    return (out.withColumn("success", ok & ~no_choice)
               .withColumn("json_kind", kind)
               .withColumn("document_type", dtype)
               .withColumn("read_error", F.when(ok & is_json & (kind != "OBJECT"), F.format_string(
                   NOT_A_DICT, _py_type_name(kind))))
               .withColumn("error", F.when(no_choice, F.lit(NO_CONTENT)).when(
                   ~ok & F.col("http_status").between(200, 299), F.format_string(API_ERROR, "http_status", body)).when(
                   ~ok, F.format_string(HTTP_ERROR, "http_status", body))))


def classification_outcome(decoded: DataFrame, catalog_names: list[str]) -> DataFrame:
    """Per document: status, document type, second-pass schema and pass list.

    A failed call fails the document; a readable object gives its type (a
    JSON null type stays null); the type picks the second-pass schema through
    the fixed map (or its own name) and that pass runs only if the catalog has
    the schema. A document without a response is still running. Without a
    classification schema no document can complete. The columns are the same
    in every case.
    """
    if CLASSIFICATION not in catalog_names:
        none = F.lit(None).cast("string")
        return decoded.select("document_id", F.lit(False).alias("success"), none.alias("document_type"),
                              none.alias("schema_name"), F.array().cast("array<string>").alias("schema_passes"),
                              F.lit(FAILED).alias("status"), F.lit(NO_CLASSIFICATION).alias("last_error"))
    m = F.create_map(*[x for k, v in TYPE_TO_SCHEMA.items() for x in (F.lit(k), F.lit(v))])
    t = F.col("document_type")
    schema_name = F.coalesce(m[t], t)
    waiting = F.col("success").isNull()
    read = F.coalesce(F.col("success"), F.lit(False)) & F.col("read_error").isNull()
    second = F.coalesce(schema_name.isin(*catalog_names), F.lit(False)) & read
    passes = F.array_compact(F.array(F.when(~waiting, F.lit(CLASSIFICATION)),
                                     F.when(second, F.concat(F.lit(SPECIFIC_PREFIX), schema_name))))
    return decoded.select(
        "document_id", "success", t.alias("document_type"),
        F.when(second, schema_name).alias("schema_name"), passes.alias("schema_passes"),
        F.when(waiting, F.lit(PENDING)).when(read, F.lit(COMPLETE)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(~waiting & ~read, F.coalesce(F.concat(F.lit(CALL_FAILED), F.col("error")), F.col("read_error")))
        .alias("last_error"))


def decoded_for(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Every request with its decoded response; all response columns are null while it is pending."""
    return requests.select("document_id", "request_id").join(decode_responses(responses), "request_id", "left")


# --------------------------------------------------------------- result document

def call_result(success: Column, content: Column, json_kind_col: Column, error: Column) -> Column:
    """One call's part of the result document, as JSON text: its data (the object, or the raw text) or its error."""
    data = F.when(json_kind_col.isNotNull(), content).otherwise(F.to_json(F.struct(content.alias("raw_text"))))
    raw = F.to_json(F.struct(content.alias("raw_response")))
    good = F.concat(F.lit('{"success":true,"data":'), data, F.lit(","), F.substr(raw, F.lit(2)))
    bad = F.concat(F.lit('{"success":false,'), F.substr(F.to_json(F.struct(error.alias("error"))), F.lit(2)))
    return F.when(success, good).when(~success, bad)


def result_documents(outcomes: DataFrame, first: DataFrame, second: DataFrame, timestamp: str) -> DataFrame:
    """``document_id, result_key, result_json`` of every finished document: both passes' answers, the list of passes
    and the time of processing. ``first`` and ``second`` hold the decoded responses per document."""
    def part(d: DataFrame, name: str) -> DataFrame:
        return d.select("document_id", call_result(F.col("success"), F.col("content"), F.col("json_kind"),
                                                   F.col("error")).alias(name))
    j = (outcomes.where(F.col("status") == COMPLETE).select("document_id", "schema_passes")
         .join(part(first, "_a"), "document_id").join(part(second, "_b"), "document_id", "left"))
    analysis = F.concat(F.lit('{"classification":'), F.col("_a"), F.coalesce(
        F.concat(F.lit(',"specific_extraction":'), F.col("_b")), F.lit("")), F.lit("}"))
    passes = F.concat(F.lit('["'), F.array_join("schema_passes", '","'), F.lit('"]'))
    return j.select("document_id", K.result_key(F.col("document_id")).alias("result_key"), F.concat(
        F.lit('{"document_analysis":'), analysis, F.lit(f',"processing_timestamp":"{timestamp}","schema_passes":'),
        passes, F.lit("}")).alias("result_json"))


def parsed(answers: DataFrame, content_col: str = "content", out: str = "parsed") -> DataFrame:
    """Answers with their content as a variant: parsed once, read by every rule and field below."""
    return answers.withColumn(out, F.try_parse_json(content_col))


def _ddl(t: T.DataType) -> str:
    """A type as text, names quoted (schemas name fields like 24_7_claims)."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"`{f.name}`:{_ddl(f.dataType)}" for f in t) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def typed(variant: Column, schema: dict) -> Column:
    """A parsed answer read with the schema's compiled type (null where absent or of another type)."""
    return F.try_variant_get(variant, "$", _ddl(compile_schema(schema)))


def typed_answers(decoded: DataFrame, schema: dict) -> DataFrame:
    """Decoded answers with ``answer``: the content read with the schema's compiled type (null fields where absent)."""
    return decoded.withColumn("answer", F.from_json("content", compile_schema(schema)))


def violations(variant: Column, schema: dict) -> Column:
    """Declared-but-unchecked rules of a schema as a violations array: missing required fields, values of another
    JSON type, values outside an enum, confidence outside [0, 1]; the fields of nested objects too, by their path."""
    return F.array_compact(F.array(*_rules(variant, schema.get("fields", {}), "$", ""), F.lit(None).cast("string")))


def extraction_violations(content: Column, schema: dict) -> Column:
    """``violations`` of a JSON text."""
    return violations(F.try_parse_json(content), schema)


def _rules(variant: Column, fields: dict, at: str, shown: str) -> list[Column]:
    checks = []
    for name, spec in fields.items():
        if isinstance(spec, str):
            spec = {"type": spec}
        path, label = f"{at}.{name}", f"{shown}{name}"
        node = F.try_variant_get(variant, path, "variant")
        val = F.try_variant_get(variant, path, "string")  # null for a JSON null as well
        if spec.get("required"):
            checks.append(F.when(node.isNull(), F.lit(f"missing:{label}")))
        kind = F.schema_of_variant(node)
        wanted = {"array": kind.startswith("ARRAY"), "object": kind.startswith("OBJECT"),
                  "string": kind == "STRING", "boolean": kind == "BOOLEAN"}.get(
            spec.get("type", "string"), kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
        checks.append(F.when(val.isNotNull() & ~wanted, F.lit(f"type:{label}")))
        if spec.get("enum"):
            checks.append(F.when(val.isNotNull() & ~val.isin(*spec["enum"]), F.lit(f"enum:{label}")))
        if name == "confidence":
            num = val.try_cast("double")
            checks.append(F.when(val.isNotNull() & (num.isNull() | (num < 0) | (num > 1)), F.lit(f"range:{label}")))
        if spec.get("type") == "object" and spec.get("properties"):
            checks += _rules(variant, spec["properties"], path, f"{label}.")
    return checks
