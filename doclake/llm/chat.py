"""Reply trees: every conversation's best branch, formatted as one chat text.

A node names its parent. Iterative self-joins double the distance that each
node looks up the tree, so a tree of depth d takes log2(d) rounds of joins on
(conversation, node); a round also adds up the scores, which gives every leaf
the score of its root-to-leaf path. Branches are ranked by score, the best
``top`` per conversation are enumerated with the same doubled steps, and each
path is formatted as one conversation with the loss mask on assistant texts.

Template (fixed values below): ``<s>role\\ntext</s>`` per turn. A control
string inside a role or text gets a backslash after its first character (and
one more if it already has some), which unescaping removes again.

Defined cases: a null text or role is empty; a null conversation id is a
conversation of its own; rows of one conversation with equal turns are ordered
by role, then text; a node whose parent is missing, itself or later in order
starts a tree of its own; a conversation has one row per chosen path, however
long; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, staged

# Strings that chat templates read as control, first character and rest.
OPEN, CLOSE = "<s>", "</s>"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPE = rf"([<\[])(\\*)({_RESTS})"
UNESCAPE = rf"([<\[])\\(\\*)({_RESTS})"


def escape(s: str) -> str:
    return re.sub(ESCAPE, r"\1\\\2\3", s)


def unescape(s: str) -> str:
    return re.sub(UNESCAPE, r"\1\2\3", s)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(s))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the [start, end) code points of its assistant texts."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{OPEN}{_role_out(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        if not part.startswith(OPEN):
            raise ValueError("a turn doesn't start with its marker")
        role, _, text = part[len(OPEN):].partition("\n")
        turns.append((_role_in(role), unescape(text)))
    return turns


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as reply nodes: each answers the row before it."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    return conversations.select(
        F.when(F.col("conv_id").isNull(), "none").otherwise(F.concat(F.lit("="), F.col("conv_id"))).alias("conv"),
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).select("conv", "conv_id", F.row_number().over(order).cast("long").alias("node"), "role", "text").select(
        "*", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.length("text").cast("double").alias("score"))


def best_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """``conv, leaf, path_score, rank, node, pos`` of the best branches; nodes are ``conv, node, parent, score``.

    A node's number must be larger than its parent's (any reply order has that).
    """
    slim = nodes.select("conv", "node", "parent", "score")
    known = slim.select("conv", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = slim.join(known, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("known") & (F.col("parent") < F.col("node")), F.col("parent")).alias("up"),
        F.col("score").cast("double").alias("sum"), F.lit(1).cast("long").alias("hops"))
    steps = [staged(step, "steps")]
    while steps[-1].where("up is not null").limit(1).count():
        last = steps[-1]
        far = last.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"),
                          F.col("sum").alias("sum2"), F.col("hops").alias("hops2"))
        longer = last.where("up is not null").join(far, ["conv", "up"]).select(
            "conv", "node", F.col("up2").alias("up"), (F.col("sum") + F.col("sum2")).alias("sum"),
            (F.col("hops") + F.col("hops2")).alias("hops"))
        steps.append(staged(longer.unionByName(last.where("up is null")), "steps"))
    whole = steps.pop()  # every node's way to its root
    inner = steps[0].where("up is not null").select("conv", F.col("up").alias("node")).distinct() if steps \
        else whole.limit(0).select("conv", "node")
    leaves = whole.join(inner, ["conv", "node"], "left_anti")
    if top == 1:
        best = leaves.groupBy("conv").agg(F.min(F.struct((-F.col("sum")).alias("s"), "node", "hops")).alias("b")).select(
            "conv", F.col("b.node").alias("leaf"), (-F.col("b.s")).alias("path_score"), "b.hops", F.lit(1).alias("rank"))
    else:
        rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("sum"), "node"))
        best = leaves.withColumn("rank", rank).where(F.col("rank") <= top).select(
            "conv", F.col("node").alias("leaf"), F.col("sum").alias("path_score"), "hops", "rank")
    paths = best.select("*", F.col("leaf").alias("node"), F.col("hops").alias("pos"))
    for k, table in enumerate(steps):
        jump = table.where("up is not null").select("conv", "node", "up")
        more = paths.join(jump, ["conv", "node"]).select(
            *[c for c in paths.columns if c not in ("node", "pos")], F.col("up").alias("node"),
            (F.col("pos") - (1 << k)).alias("pos"))
        paths = staged(paths.unionByName(more), "paths")
    return paths.select("conv", "leaf", "path_score", "rank", "node", "pos")


def format_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: ``conv_id, leaf, rank, path_score, formatted, loss_spans``."""
    bounded_batches(nodes.sparkSession)
    text = nodes.select("conv", "conv_id", "node", "role", "text")
    grouped = paths.join(text, ["conv", "node"]).groupBy("conv", "conv_id", "leaf", "rank", "path_score").agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    src = grouped.select("conv_id", "leaf", "rank", "path_score", F.col("turns.role").alias("roles"),
                         F.col("turns.text").alias("texts"))
    id_type = src.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            done = [format_turns(list(zip(r.as_py(), t.as_py()))) for r, t in zip(b.column("roles"), b.column("texts"))]
            spans = pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in done],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("conv_id", "leaf", "rank", "path_score")]
                + [pa.array([x[0] for x in done], pa.string()), spans],
                names=["conv_id", "leaf", "rank", "path_score", "formatted", "loss_spans"])

    return src.mapInArrow(run, f"conv_id {id_type}, leaf long, rank int, path_score double, formatted string, "
                               "loss_spans array<struct<start:bigint,end:bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives, per path."""
    bounded_batches(formatted.sparkSession)
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def run(batches):
        for b in batches:
            out = []
            for f, spans in zip(b.column("formatted"), b.column("loss_spans")):
                f = f.as_py()
                turns = parse_turns(f)
                loss = "".join(unescape(f[s["start"]:s["end"]]) for s in spans.as_py())
                out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(f)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id")] + [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """Format every conversation's best branch, write the texts and return what reading them back gives."""
    nodes = staged(linear_nodes(conversations), "nodes")  # the rounds below read its narrow columns alone
    return digests(staged(format_paths(nodes, best_paths(nodes)), "chat"))
