"""Personal-data detection, masking and box mapping as vectorized Arrow functions.

A detection is ``struct<type, text, start_pos, end_pos, confidence>`` with
0-based, half-open code-point offsets, in the order the rules are listed
below: every match of the first rule, then every match of the second, ...
then the three name contexts. Overlapping detections are all kept.

Each text is scanned once per rule that it can match at all (a cheap guard
decides), and every match costs constant work, so the time is linear in text
and matches. The functions run on Arrow batches next to the other columns of
a row: the text is never exploded, grouped or joined back.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference rules for equal results.
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
# Confidence order used by the optional minimum-confidence filter.
CONFIDENCE_RANK = {"low": 0, "medium": 1, "high": 2}
# ---------------------------------------------------------------------------

_INDICATORS_RE = re.compile("|".join(re.escape(w.lower()) for w in BUSINESS_INDICATORS))
_CONTEXTS_RE = re.compile("|".join(re.escape(w) for w in BUSINESS_CONTEXTS))
_DIGIT = re.compile(r"\d")

DETECTION_DDL = "struct<type:string,text:string,start_pos:int,end_pos:int,confidence:string>"
_DETECTION = pa.struct([("type", pa.string()), ("text", pa.string()), ("start_pos", pa.int32()),
                        ("end_pos", pa.int32()), ("confidence", pa.string())])

# (type, compiled pattern, reported group, confidence, what the text must hold for a match)
_RULES = [(kind, re.compile(pattern, re.IGNORECASE), 0, confidence,
           {"ssn": ("-", True), "email": ("@", False)}.get(kind, ("", True)))
          for kind, pattern, confidence in PII_PATTERNS]
_RULES += [(NAME_TYPE, re.compile(pattern, re.IGNORECASE), 1, NAME_CONFIDENCE, (mark, False))
           for pattern, mark in zip(NAME_PATTERNS, ("", ":", ":"))]


class _Names:
    """The business-name test for the candidate names of one text, each distinct name decided once."""

    def __init__(self, text: str):
        self.text, self.lower, self.known = text, text.lower(), {}

    def personal(self, name: str) -> bool:
        low = name.lower()
        if low not in self.known:
            self.known[low] = not (_INDICATORS_RE.search(low) or self._in_business_context(low, len(name)))
        return self.known[low]

    def _in_business_context(self, low: str, length: int) -> bool:
        at = self.lower.find(low)
        if at < 0:
            return False
        around = self.text[max(0, at - CONTEXT_RADIUS):at + length + CONTEXT_RADIUS].lower()
        return _CONTEXTS_RE.search(around) is not None


def _detections(texts: pa.Array) -> pa.Array:
    ends, rule_of, pieces, starts, stops = [0], [], [], [], []
    for value in texts.to_pylist():
        text = value or ""
        digits = _DIGIT.search(text) is not None
        names = None
        for number, (kind, pattern, group, _, (mark, needs_digit)) in enumerate(_RULES):
            if (needs_digit and not digits) or mark not in text:
                continue
            hits = [(m[group], *m.span(group)) for m in pattern.finditer(text)]
            if hits and kind == NAME_TYPE:
                names = names or _Names(text)
                hits = [h for h in hits if names.personal(h[0])]
            rule_of += [number] * len(hits)
            pieces += [h[0] for h in hits]
            starts += [h[1] for h in hits]
            stops += [h[2] for h in hits]
        ends.append(len(pieces))
    rules = pa.array(rule_of, pa.int32())
    found = pa.StructArray.from_arrays(
        [pa.array([r[0] for r in _RULES]).take(rules), pa.array(pieces, pa.string()), pa.array(starts, pa.int32()),
         pa.array(stops, pa.int32()), pa.array([r[3] for r in _RULES]).take(rules)], fields=list(_DETECTION))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)


def detections(text: Column) -> Column:
    """``array<detection>`` of a text column (null: no detection)."""
    return F.arrow_udf(_detections, f"array<{DETECTION_DDL}>")(text)


def masked(text: Column, found: Column, mask: str) -> Column:
    """The text with every detected span replaced by ``mask``: overlapping spans share one mask, adjacent ones
    get one each."""
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for value, spans in zip(texts.to_pylist(), lists.to_pylist()):
            value, parts, at = value or "", [], 0
            for a, b in sorted((d["start_pos"], d["end_pos"]) for d in spans or ()):
                if a >= at:
                    parts += [value[at:a], mask]
                at = max(at, b)
            out.append("".join([*parts, value[at:]]))
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text, found)


def line_numbers(lines: Column, found: Column) -> Column:
    """Per detection, the number (from 0) of the page line whose box it takes, or null: the last line equal to the
    detected text, else the last copy of the first line that contains it in any case."""
    def run(pages: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for texts, spans in zip(pages.to_pylist(), lists.to_pylist()):
            texts = [t or "" for t in texts or ()]
            last = {t: k for k, t in enumerate(texts)}
            lower = [t.lower() for t in texts]
            starts, at = [], 0
            for t in lower:
                starts.append(at)
                at += len(t) + 1
            page, seen = "\n".join(lower), {}
            row = []
            for d in spans or ():
                low = d["text"].lower()
                if d["text"] in last:
                    row.append(last[d["text"]])
                    continue
                if low not in seen:  # without a line break, a hit in the page lies in one line
                    hit = -1 if "\n" in low else page.find(low)
                    seen[low] = None if hit < 0 else last[texts[bisect_right(starts, hit) - 1]]
                row.append(seen[low])
            out.append(row)
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")(lines, found)


def confidence_at_least(confidence: Column, minimum: str) -> Column:
    """Optional minimum-confidence filter (low < medium < high)."""
    rank = F.create_map(*[x for k, v in CONFIDENCE_RANK.items() for x in (F.lit(k), F.lit(v))])
    return rank[confidence] >= F.lit(CONFIDENCE_RANK[minimum])
