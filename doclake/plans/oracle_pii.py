"""DuckDB SQL twins of the detection rules (used by ``oracle_sql``).

RE2 has no ``(?U)``; plain case-insensitive matching equals Python's on the
driver text, which is what the correctness check runs on.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values, stated here a second time so that a change in the library shows.
# (type, pattern, confidence), matched case-insensitively, in this order.
PII_PATTERNS = [
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "high"),
    ("account_number", r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b", "high"),
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "high"),
    ("phone", r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", "medium"),
    ("address", r"\b\d+\s+[A-Za-z\s]+(?:Street|St|Avenue|Ave|Road|Rd|Drive|Dr|Lane|Ln|Boulevard|Blvd|Way|Circle|Cir|Court|Ct)\b", "medium"),
    ("zip_code", r"\b\d{5}(?:-\d{4})?\b", "low"),
]
# Name contexts; group 1 is the name, reported as type personal_name, medium.
NAME_PATTERNS = [
    r"(?:Dear|To|From|Mr\.|Mrs\.|Ms\.|Dr\.)\s+([A-Z][a-z]+\s+[A-Z][a-z]+)",
    r"(?:Name|Applicant|Customer|Client):\s*([A-Z][a-z]+\s+[A-Z][a-z]+)",
    r"(?:Signed|By):\s*([A-Z][a-z]+\s+[A-Z][a-z]+)",
]
NAME_TYPE, NAME_CONFIDENCE = "personal_name", "medium"
# A candidate name is rejected when it contains one of these (case-insensitive)
BUSINESS_INDICATORS = [
    "LLC", "Inc", "Corp", "Company", "Associates", "Group", "Partners",
    "Chevrolet", "Ford", "Toyota", "Honda", "BMW", "Mercedes", "Audi",
    "Bank", "Credit", "Union", "Insurance", "Agency", "Services",
]
# ... or when one of these occurs within 50 characters of the first
# occurrence of the name in the text (plain substrings, no word boundary).
BUSINESS_CONTEXTS = ["from", "at", "company", "business", "dealer", "dealership"]
CONTEXT_RADIUS = 50
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pattern_sql(src: str, key: str, ordinal: int, pattern: str, ty: str, conf: str) -> str:
    p = _q(pattern)
    return f"""
    SELECT {key}, {ordinal} AS pat, i AS mi, '{ty}' AS type, ms[i + 1] AS text,
           CAST(coalesce(list_sum(list_transform(gs[1:i + 1], lambda s: length(s))), 0)
              + coalesce(list_sum(list_transform(ms[1:i], lambda s: length(s))), 0) AS BIGINT) AS start_pos,
           '{conf}' AS confidence
    FROM (SELECT {key}, ms, gs, unnest(range(len(ms))) AS i
          FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), {p}, 0, 'i') AS ms,
                       string_split_regex(coalesce(text, ''), {p}, 'i') AS gs FROM {src}))"""


def _name_sql(src: str, key: str, ordinal: int, pattern: str) -> str:
    p = _q(pattern)
    inds = " OR ".join(f"instr(lower(n), {_q(w.lower())}) > 0" for w in BUSINESS_INDICATORS)
    ctxs = " OR ".join(f"instr(ctx, {_q(w)}) > 0" for w in BUSINESS_CONTEXTS)
    r = CONTEXT_RADIUS
    return f"""
    SELECT {key}, pat, mi, type, text, start_pos, confidence FROM (
      SELECT *, lower(substr(full_text, greatest(npos - {r}, 0) + 1,
                 least(length(full_text), npos + length(n) + {r}) - greatest(npos - {r}, 0))) AS ctx
      FROM (
        SELECT {key}, {ordinal} AS pat, i AS mi, '{NAME_TYPE}' AS type, ns[i + 1] AS text, ns[i + 1] AS n,
               full_text, instr(lower(full_text), lower(ns[i + 1])) - 1 AS npos,
               CAST(coalesce(list_sum(list_transform(gs[1:i + 1], lambda s: length(s))), 0)
                  + coalesce(list_sum(list_transform(ms[1:i], lambda s: length(s))), 0)
                  + length(ms[i + 1]) - length(ns[i + 1]) AS BIGINT) AS start_pos,
               '{NAME_CONFIDENCE}' AS confidence
        FROM (SELECT {key}, full_text, ms, ns, gs, unnest(range(len(ms))) AS i
              FROM (SELECT {key}, coalesce(text, '') AS full_text,
                           regexp_extract_all(coalesce(text, ''), {p}, 0, 'i') AS ms,
                           regexp_extract_all(coalesce(text, ''), {p}, 1, 'i') AS ns,
                           string_split_regex(coalesce(text, ''), {p}, 'i') AS gs FROM {src}))))
    WHERE NOT ({inds}) AND NOT (npos >= 0 AND ({ctxs}))"""


def detections_sql(src: str, key: str) -> str:
    """Rows (key, det_idx, pii_type, pii_text, start_pos, end_pos, confidence).

    ``src`` is a relation with columns ``key`` and ``text``.
    """
    parts = [_pattern_sql(src, key, i, p, ty, c) for i, (ty, p, c) in enumerate(PII_PATTERNS)]
    parts += [_name_sql(src, key, len(PII_PATTERNS) + j, p) for j, p in enumerate(NAME_PATTERNS)]
    union = "\nUNION ALL\n".join(parts)
    return f"""
    SELECT {key},
           CAST(row_number() OVER (PARTITION BY {key} ORDER BY pat, mi) - 1 AS BIGINT) AS det_idx,
           type AS pii_type, text AS pii_text, start_pos,
           CAST(start_pos + length(text) AS BIGINT) AS end_pos, confidence
    FROM ({union})"""
