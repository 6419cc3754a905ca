"""Conversation prefix trie: a z-fast trie built in batches with joins.

A conversation is a sequence of turns; conversations that begin alike share a
path. Every prefix has a signature: the sum of its turns' hashes times powers
of a base, modulo two primes, so signatures come from one segmented scan and a
conversation of any length spreads over tasks.

The trie is compacted. Every distinct conversation is a *path*: it hangs off
its parent path at a depth and goes on from there on its own. Depths where
something hangs or ends cut a path into compacted nodes (a, b], and the table
of handles is keyed by the depth in (a, b] that is divisible by the largest
power of two (the two-fattest) and the signature there.

A batch is located by fat binary search: each round looks up the signature at
the two-fattest depth of what is left of (lower, upper]; found, the search goes
on behind that node, else before the depth. That takes log2(length) lookups and
ends at the node where a conversation leaves the trie, or at its parent; one
lookup by first turn tells, and the node's signatures, held against the
conversation's in one join, give the depth.
Of those that leave at one place by one turn a single one, chosen by hash, is
inserted, the others come again with the next batch, so batches are about as
many as the logarithm of the conversations. Copies are one conversation with
several members throughout.

Values are sums over subtrees. They rise along the tree of paths batch by
batch (the last one first), and one more segmented scan from each path's end
expands its nodes to one row per depth.

Defined cases: turns are ordered by (turn, nulls first; role; text); a null
role or text is empty; rows without a conversation id belong to none and are
left out; a conversation without turns ends at the root; repeated rows are
turns of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.operators.scan import PART, SEQ, Scan, positions, ranged, scanned

from .common import bounded_batches, scratch, staged

# Two primes below 2**61 and a base for each: a signature is 122 bits.
PRIMES = ((1 << 61) - 1, (1 << 61) - 31)
BASES = (1_000_003_000_017, 2_718_281_828_459)
WORDS = r"[^\x20\x09-\x0D]+"
CHUNK_IDS = 1 << 16
# search steps between written tables
STEPS = 6
# a path is cut every 2**STRETCH turns, so that no task meets more cuts of a path
STRETCH = 16


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, hash, words``: every turn's place, the hash of its role and text, the number of its words."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).select(
        "*", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("hash"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    return positions(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], "pos",
                     keep=["conv_id", "hash", "words"])


def _term(k: int):
    prime, base = PRIMES[k], BASES[k]

    @F.pandas_udf("long")
    def term(digest: pd.Series, pos: pd.Series) -> pd.Series:
        power: dict[int, int] = {}

        def one(h, p):
            if p not in power:
                power[p] = pow(base, p, prime)
            return (int(h, 16) % (prime - 1) + 1) * power[p] % prime

        return pd.Series([one(h, p) for h, p in zip(digest, pos)], dtype="int64")

    return term


def signatures(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, s1, s2, words, total``: per prefix its signature, its last turn's words and all its words."""
    rows = ranged(turns.select("conv_id", "pos", "words", *[_term(k)("hash", "pos").alias(f"t{k}") for k in (0, 1)]),
                  ["conv_id"], ["pos"])
    sums = scanned(rows, ["conv_id"], [Scan("total", "sum", F.col("words"))] + [
        Scan(f"h{k}", "sum", F.col(f"t{k}").cast("decimal(19,0)")) for k in (0, 1)])
    return sums.select("conv_id", "pos", *[(F.col(f"h{k}") % F.lit(PRIMES[k]).cast("decimal(19,0)")).cast("long").alias(
        f"s{k + 1}") for k in (0, 1)], "words", "total")


def two_fattest(lower: Column, upper: Column) -> Column:
    """The number in (lower, upper] that the largest power of two divides (0 <= lower < upper)."""
    below = F.length(F.bin(lower.bitwiseXOR(upper))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", upper, below), below)


class Trie:
    """What is inserted so far, over the prefixes of all distinct conversations.

    ``prefixes``: ``x, d, s1, s2, words, total``; ``settled``: ``x, n, parent, start, batch``, the conversations that
    are in the trie: those that go on from their parent path are paths (no parent: the root), the others end on it.
    Its batches are written one by one and read as one table, so a plan has one scan of it, however many there are.
    """

    def __init__(self, prefixes: DataFrame):
        self.prefixes = prefixes
        self.settled = None
        self.folders: list[str] = []

    @property
    def batches(self) -> int:
        return len(self.folders)

    @property
    def paths(self) -> DataFrame:
        return self.settled.where("start < n")

    @property
    def ends(self) -> DataFrame:
        """``x, path, depth``: the node where each distinct conversation ends."""
        return self.settled.select("x", F.when(F.col("start") < F.col("n"), F.col("x")).otherwise(F.col("parent")).alias("path"),
                                   F.col("n").alias("depth"))

    def signature(self, rows: DataFrame, owner: str, depth: str, a: str, b: str) -> DataFrame:
        """``rows`` with the signature (a, b) of the prefix of ``depth`` turns of ``owner`` (null where it has none)."""
        there = self.prefixes.select(F.col("x").alias(owner), F.col("d").alias(depth), F.col("s1").alias(a), F.col("s2").alias(b))
        return rows.join(there, [owner, depth], "left")

    def nodes(self) -> DataFrame:
        """Compacted nodes ``x, lo, hi``: the turns lo + 1 to hi of path x; with the depth and signature of the handle
        (``probe, p1, p2``) and of the first turn (``child, c1, c2``).

        A path is also cut at every multiple of ``2**STRETCH``, so a node begins where the last cut of its stretch is, and
        the cuts of a long path spread over tasks. Such a cut is a node with one child.
        """
        def stretch(turn):
            return F.call_function("shiftright", turn, F.lit(STRETCH))

        def cut(x, d, begins=False):
            return F.struct(x.alias("x"), d.alias("d"), stretch(d if begins else d - 1).alias("stretch"), F.lit(begins).alias("begins"))

        x, n, parent, start = (F.col(c) for c in ("x", "n", "parent", "start"))
        borders = F.when(stretch(start) < stretch(n - 1), F.transform(
            F.sequence(stretch(start) + 1, stretch(n - 1)), lambda k: cut(x, F.call_function("shiftleft", k, F.lit(STRETCH))))).otherwise(
            F.array())
        cuts = F.when(start < n, F.concat(F.array(cut(x, start, begins=True), cut(x, n), cut(parent, start)), borders)).otherwise(
            F.array(cut(parent, start)))
        here = Window.partitionBy("x", "stretch").orderBy("d")
        node = self.settled.select(F.explode(cuts).alias("c")).select("c.*").where("x is not null").distinct().withColumn(
            "before", F.lag("d").over(here)).where("not begins").select(
            "x", F.coalesce("before", F.call_function("shiftleft", F.col("stretch"), F.lit(STRETCH))).alias("lo"), F.col("d").alias("hi")).select(
            "*", two_fattest(F.col("lo"), F.col("hi")).alias("probe"), (F.col("lo") + 1).alias("child"))
        return staged(self.signature(self.signature(node, "x", "probe", "p1", "p2"), "x", "child", "c1", "c2"), "nodes")

    def insert(self, located: DataFrame) -> tuple[DataFrame, int, int]:
        """Insert a batch (``x, n, parent, start``) and return the conversations that must come again (``x, n``), how
        many they are and the most turns of one that left.

        Those that end where they leave the trie are in it. Of all others that leave at one place by one turn, the
        one with the smallest hash is inserted; the place and turn are known by the signature one turn further on.
        """
        spark, located = located.sparkSession, staged(located, "located")
        off = self.signature(located.where("start < n").withColumn("next", F.col("start") + 1), "x", "next", "a", "b")
        first = off.groupBy("next", "a", "b").agg(F.min_by(F.struct("x", "n", "parent", "start"), F.struct(
            F.xxhash64("x"), F.col("x"))).alias("r")).select("r.*")
        settled = located.where("start = n").unionByName(first).withColumn("batch", F.lit(self.batches + 1))
        folder = scratch(spark, "settled")
        settled.write.parquet(folder)
        self.folders.append(folder)
        new = spark.read.schema(settled.schema).parquet(folder).where("start < n")
        self.settled = spark.read.schema(settled.schema).parquet(*self.folders)
        left, longest = located.where("start < n").agg(F.count(F.lit(1)), F.max("n")).first()
        again = located.where("start < n").join(new.select("x"), "x", "left_anti").select("x", "n")
        return again, left - new.count(), longest or 0

    def locate(self, pending: DataFrame, longest: int) -> DataFrame:
        """Where each pending conversation (of at most ``longest`` turns) leaves the trie: ``x, n, parent, start``."""
        nodes = self.nodes()
        handles = nodes.select("probe", "p1", "p2", F.col("x").alias("hit"), F.col("hi").alias("hit_hi"))
        at = pending.select("x", "n", F.lit(0).cast("long").alias("lower"), F.col("n").alias("upper"),
                            F.lit(None).cast("long").alias("node"), F.lit(0).cast("long").alias("node_hi"),
                            F.lit(0).cast("long").alias("good"))
        for step in range(longest.bit_length()):  # fat binary search
            probe = at.withColumn("probe", F.when(F.col("lower") < F.col("upper"), two_fattest(F.col("lower"), F.col("upper"))))
            seen = self.signature(probe, "x", "probe", "p1", "p2").join(handles, ["probe", "p1", "p2"], "left")
            hit = F.col("hit").isNotNull()
            at = seen.select(
                "x", "n", F.when(hit, F.least("hit_hi", "upper")).otherwise(F.col("lower")).alias("lower"),
                F.when(hit | F.col("probe").isNull(), F.col("upper")).otherwise(F.col("probe") - 1).alias("upper"),
                F.when(hit, F.col("hit")).otherwise(F.col("node")).alias("node"),
                F.when(hit, F.col("hit_hi")).otherwise(F.col("node_hi")).alias("node_hi"),
                F.when(hit, F.col("probe")).otherwise(F.col("good")).alias("good"))
            if step % STEPS == STEPS - 1:
                at = staged(at, "search")
        # the next turn may lead into a child of the node, which is only found if the whole node matches
        children = nodes.select("child", "c1", "c2", F.col("x").alias("into"), F.col("hi").alias("into_hi"))
        at = self.signature(at.withColumn("child", F.col("node_hi") + 1), "x", "child", "c1", "c2").join(
            children, ["child", "c1", "c2"], "left")
        enters = F.col("into").isNotNull()
        at = staged(at.select(
            "x", "n", F.when(enters, F.col("into")).otherwise(F.col("node")).alias("parent"),
            F.when(enters, F.col("child")).otherwise(F.col("good")).alias("start"),
            F.least(F.when(enters, F.col("into_hi")).otherwise(F.col("node_hi")), "n").alias("limit")), "search")
        # where in that node it leaves: the last of the node's turns up to which the signatures agree
        own = at.where("start < limit").join(self.prefixes.select("x", "d", "s1", "s2"), "x").where("d > start and d <= limit")
        same = own.join(self.prefixes.select(F.col("x").alias("parent"), "d", "s1", "s2"), ["parent", "d", "s1", "s2"])
        return at.select("x", "n", "parent", "start").unionByName(same.select(
            "x", "n", "parent", F.col("d").alias("start"))).groupBy("x", "n", "parent").agg(F.max("start").alias("start"))


def build(prefixes: DataFrame, contents: DataFrame) -> Trie:
    """The trie of the distinct conversations ``contents`` (``x, n``, at least one turn each)."""
    trie = Trie(prefixes)
    pending, n, longest = trie.insert(contents.select(
        "x", "n", F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("start")))
    while n:
        pending, n, longest = trie.insert(trie.locate(pending, longest))
    return trie


SUMS = ("members", "said", "leaves", "distinct")


def path_totals(trie: Trie, events: DataFrame) -> DataFrame:
    """Per path what is below it and how much of that is its own: ``x, parent, start, first, *SUMS``.

    Paths hang off paths of earlier batches, so totals rise batch by batch from the last one.
    """
    own = events.groupBy(F.col("path").alias("x")).agg(F.min("first").alias("first"), *[F.sum(c).alias(c) for c in SUMS])
    paths = staged(trie.paths.join(own, "x"), "totals")
    done = None
    for batch in range(trie.batches, 0, -1):
        now = paths.where(F.col("batch") == batch)
        if done is not None:
            below = done.groupBy(F.col("parent").alias("x")).agg(
                F.min("first").alias("_first"), *[F.sum(c).alias(f"_{c}") for c in SUMS])
            now = now.join(below, "x", "left").select(
                *[c for c in paths.columns if c != "first" and c not in SUMS], F.least("first", "_first").alias("first"),
                *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in SUMS])
        now = staged(now, "totals")
        done = now if done is None else done.unionByName(now)
    return done


def end_digests(members: DataFrame) -> DataFrame:
    """``x, ends_sha256``: the digest of the comma-joined ids of each conversation's members, in numeric order.

    Ids meet in pieces of at most ``CHUNK_IDS``; a digest reads its pieces one after the other.
    """
    bounded_batches(members.sparkSession)
    rows = ranged(members.select("x", "conv_id"), ["x"], ["conv_id"])
    piece = F.floor(F.col(SEQ).bitwiseAND(F.lit((1 << 33) - 1)) / CHUNK_IDS).alias("piece")
    pieces = rows.groupBy("x", PART, piece).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def run(batches):
        at, digest = None, None
        for b in batches:
            done = []
            for x, ids in zip(b.column("x").to_pylist(), b.column("ids")):
                if x != at:
                    if digest:
                        done.append((at, digest.hexdigest()))
                    at, digest = x, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                             names=["x", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([digest.hexdigest()])], names=["x", "ends_sha256"])

    return pieces.repartition("x").sortWithinPartitions("x", PART, "piece").select("x", "ids").mapInArrow(
        run, "x long, ends_sha256 string")


def trie_nodes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per prefix of the conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns``: ``conv_id, pos, hash, words`` (places 1, 2, ... of each conversation); ``ids``: every ``conv_id`` once.
    """
    known = staged(signatures(turns), "signatures")
    last = known.groupBy("conv_id").agg(F.max(F.struct(F.col("pos").alias("n"), "s1", "s2")).alias("e"))
    whole = staged(ids.select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("e.n", F.lit(0)).alias("n"), F.coalesce("e.s1", F.lit(0)).alias("s1"),
        F.coalesce("e.s2", F.lit(0)).alias("s2")), "whole")
    contents = staged(whole.groupBy("n", "s1", "s2").agg(F.min("conv_id").alias("x"), F.count(F.lit(1)).alias("m")), "contents")
    prefixes = staged(known.withColumnRenamed("conv_id", "x").withColumnRenamed("pos", "d").join(
        contents.select("x"), "x", "left_semi"), "prefixes")
    digests = staged(end_digests(whole.join(contents.drop("m"), ["n", "s1", "s2"]).select("x", "conv_id")), "digests")
    trie = build(prefixes, contents.where("n > 0").select("x", "n"))

    said = prefixes.select("x", F.col("d").alias("depth"), "total")
    zero = F.lit(0).cast("long")
    ended = staged(trie.ends.join(contents.select("x", "m"), "x").join(said, ["x", "depth"]), "ended")
    # a path's end is a leaf unless another path goes on from there
    further = trie.paths.where("parent is not null").select(F.col("parent").alias("x"), F.col("start").alias("n")).distinct()
    leaves = trie.paths.join(further, ["x", "n"], "left_anti").select("x", "n")
    starts = said.select("x", F.col("depth").alias("start"), F.col("total").alias("before"))
    stops = said.select("x", F.col("depth").alias("n"), F.col("total").alias("upto"))
    length = staged(trie.paths.join(stops, ["x", "n"]).join(starts, ["x", "start"], "left").select(
        "x", "n", "start", "parent", "upto", (F.col("upto") - F.coalesce("before", zero)).alias("own")), "length")
    none = F.lit(None).cast("long").alias("first")
    events = ended.select("path", "depth", F.col("x").alias("first"), F.col("m").alias("members"), (F.col("m") * F.col("total")).alias("said"),
                          zero.alias("leaves"), zero.alias("distinct")).unionByName(
        leaves.select(F.col("x").alias("path"), F.col("n").alias("depth"), none, zero.alias("members"), zero.alias("said"),
                      F.lit(1).cast("long").alias("leaves"), zero.alias("distinct"))).unionByName(
        length.select(F.col("x").alias("path"), F.col("n").alias("depth"), none, zero.alias("members"), zero.alias("said"),
                      zero.alias("leaves"), F.col("own").alias("distinct")))
    totals = path_totals(trie, events)

    # a path's own words are not a lump at its end here: they are counted depth by depth
    hanging = totals.where("parent is not null").select(
        F.col("parent").alias("x"), F.col("start").alias("d"), "first", *SUMS, F.lit(1).cast("long").alias("hangs"))
    here = events.withColumn("distinct", zero).select(
        F.col("path").alias("x"), F.col("depth").alias("d"), "first", *SUMS, zero.alias("hangs"))
    at = hanging.unionByName(here).groupBy("x", "d").agg(
        F.min("first").alias("first"), *[F.sum(c).alias(c) for c in (*SUMS, "hangs")])
    ending = ended.join(digests, "x").select(F.col("path").alias("x"), F.col("depth").alias("d"), "ends_sha256")
    rows = prefixes.select("x", "d", "words", "total").join(length.select("x", "n", "start", "parent", "upto"), "x").where(
        "d > start").join(at, ["x", "d"], "left").join(ending, ["x", "d"], "left")
    down = scanned(ranged(rows, ["x"], [F.col("d").desc()]), ["x"], [
        Scan("low", "min", F.col("first"))] + [Scan(f"all_{c}", "sum", F.coalesce(F.col(c), zero)) for c in SUMS])
    before = F.col("total") - F.col("words")
    saved = F.col("all_said") - F.col("all_members") * before - F.col("all_distinct") - (F.col("upto") - before)
    up = F.col("d") - 1 > F.col("start")
    nodes = staged(down.select(
        "x", "d", F.col("low").alias("conv_id"), F.when(up, F.col("x")).otherwise(F.col("parent")).alias("px"), (F.col("d") - 1).alias("pd"),
        F.col("all_members").alias("n_convs"),
        (F.coalesce("hangs", zero) + F.when(F.col("d") < F.col("n"), 1).otherwise(0)).cast("long").alias("n_children"),
        F.col("all_leaves").alias("n_leaves"), saved.alias("saved_tokens"), "ends_sha256"), "trie")
    top = totals.where("parent is null")
    root = contents.agg(F.min("x").alias("conv_id"), F.sum("m").alias("n_convs")).where("conv_id is not null")
    first = root.first()
    if first is None:
        return nodes.select("conv_id", F.col("d").alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_convs", "n_children",
                            "n_leaves", "saved_tokens", "ends_sha256")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    turnless = contents.where("n = 0").join(digests, "x").select("ends_sha256").first()
    root_row = top.agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(1)).cast("long").alias("n_leaves"),
                       F.coalesce(F.sum(F.col("said") - F.col("distinct")), zero).cast("long").alias("saved_tokens")).select(
        F.lit(first["conv_id"]).cast("long").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(first["n_convs"]).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        (F.lit(turnless[0]) if turnless else empty).alias("ends_sha256"))
    above = nodes.select(F.col("x").alias("px"), F.col("d").alias("pd"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, ["px", "pd"], "left").select(
        "conv_id", F.col("d").alias("depth"), F.when(F.col("px").isNull(), F.lit(first["conv_id"])).otherwise(
            F.col("parent_conv_id")).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256")).unionByName(root_row)
