"""The document lifecycle as a finite automaton over status changes.

A change asks for a status. Whether it is taken depends on the status before,
which depends on all changes before it. Each change is a function from status
to status; functions compose, and composing is associative. So the changes of
a document are composed inside range partitions of its time, one composition
per partition is carried along, and a second pass applies it: the status before
every change is known without bringing a document's changes into one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.operators.scan import PART, SEQ, written

# ---------------------------------------------------------------------------
# The statuses of a document and the steps between them.
NEW = "NEW"
STATUSES = [NEW, "AWAITING_PAGES", "PROCESSING_WINDOW", "OCR_RUNNING", "AGGREGATING", "LLM_RUNNING", "COMPLETE", "FAILED"]
STEPS = {
    NEW: ["AWAITING_PAGES", "PROCESSING_WINDOW", "OCR_RUNNING"],
    "AWAITING_PAGES": ["PROCESSING_WINDOW", "OCR_RUNNING"],
    "PROCESSING_WINDOW": ["OCR_RUNNING", "FAILED"],
    "OCR_RUNNING": ["AGGREGATING", "FAILED"],
    "AGGREGATING": ["LLM_RUNNING", "FAILED"],
    "LLM_RUNNING": ["COMPLETE", "FAILED"],
}
# ---------------------------------------------------------------------------


class Automaton:
    """Functions on at most eight states, as codes of three bits per state: bits 3 s to 3 s + 2 say where s goes."""

    def __init__(self, states: list[str], steps: dict[str, list[str]]):
        if len(states) > 8:
            raise ValueError("at most eight states")
        self.states = states
        self.identity = sum(s << 3 * s for s in range(len(states)))
        # asking for a status leads there from where a step allows it, and leaves every other status as it is
        self.functions = {name: sum((t if name in steps.get(a, []) else s) << 3 * s for s, a in enumerate(states))
                          for t, name in enumerate(states)}

    def then(self, first: int, second: int) -> int:
        return sum((second >> 3 * (first >> 3 * s & 7) & 7) << 3 * s for s in range(len(self.states)))


def _composed(sorted_rows: DataFrame, key: str, status: str, automaton: Automaton) -> DataFrame:
    """``_before``: what the changes of the key before this one, inside its partition, do to a status."""
    out = T.StructType([*sorted_rows.schema.fields, T.StructField("_before", T.IntegerType())])
    names = sorted_rows.columns

    def run(batches):
        known: dict[tuple[int, int], int] = {}
        at, code, begun = None, automaton.identity, False
        for b in batches:
            before = []
            for k, s in zip(b.column(key).to_pylist(), b.column(status).to_pylist()):
                if not begun or k != at:
                    at, code, begun = k, automaton.identity, True
                before.append(code)
                step = automaton.functions.get(s, automaton.identity)
                if (code, step) not in known:
                    known[code, step] = automaton.then(code, step)
                code = known[code, step]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(before, pa.int32())], names=[*names, "_before"])

    return sorted_rows.mapInArrow(run, out)


def transitions(changes: DataFrame, key: str = "document_id", status: str = "status",
                order: tuple[str, ...] = ("ts", "seq"), states: list[str] = STATUSES, steps: dict = STEPS) -> DataFrame:
    """The changes with ``from_status`` (before the change), ``legal`` and ``to_status`` (after it).

    A document starts as the first state. A change that no step allows, or to an unknown status, is illegal and leaves
    the status; a null status changes nothing and is no illegal step.
    """
    automaton = Automaton(states, steps)
    by = [key, *order]
    placed = changes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(SEQ, F.monotonically_increasing_id()).withColumn(
        PART, F.shiftright(SEQ, 33).cast("long"))
    rows = written(_composed(placed, key, status, automaton), "transitions")
    last = rows.select(PART, SEQ, F.struct(key).alias("k"), F.struct("_before", F.col(status).alias("s")).alias("v"))
    ends = last.groupBy(PART).agg(F.min_by("k", SEQ).alias("head"), F.max_by("k", SEQ).alias("tail"),
                                  F.max_by("v", SEQ).alias("v")).orderBy(PART).collect()  # one row per partition
    carries, tail, so_far = [], None, 0
    for r in ends:
        state = so_far if tail is not None and tail == r["head"] else 0
        carries.append((r[PART], r["head"], state))
        whole = automaton.then(r["v"]["_before"], automaton.functions.get(r["v"]["s"], automaton.identity))
        so_far = whole >> 3 * (state if r["head"] == r["tail"] else 0) & 7
        tail = r["tail"]
    spark = changes.sparkSession
    carry = spark.createDataFrame(carries, f"{PART} long, _head {last.schema['k'].dataType.simpleString()}, _carry int")
    begin = F.when(F.struct(key).eqNullSafe(F.col("_head")), F.col("_carry")).otherwise(F.lit(0))
    names = F.array(*[F.lit(s) for s in states])
    before = F.call_function("shiftright", F.col("_before"), 3 * begin).bitwiseAND(F.lit(7))
    allowed = F.lit(False)
    for a, targets in steps.items():
        allowed = allowed | ((F.col("from_status") == a) & F.col(status).isin(*targets))
    return rows.join(F.broadcast(carry), PART, "left").withColumn("from_status", F.get(names, before)).withColumn(
        "legal", F.col(status).isNull() | F.coalesce(allowed, F.lit(False))).withColumn(
        "to_status", F.when(F.col("legal"), F.coalesce(F.col(status), F.col("from_status"))).otherwise(F.col("from_status"))).drop(
        PART, SEQ, "_before", "_head", "_carry")
