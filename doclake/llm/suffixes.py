"""Repeated passages across a corpus from sparse suffix arrays.

Only suffixes at content-selected positions are kept: the minimisers of all
windows of ``min_words`` words by the hash of ``ANCHOR`` words. Two equal
passages of ``min_words`` words select the same position inside, so every
repeat meets at a kept suffix, and the positions that select a suffix form one
stretch of the text (its phrase: all windows that chose it).

The kept suffixes are sorted by the hash of their first words, then by the
hash of their phrase (a range-partitioned sort: a common passage spreads over
partitions) and compared with their neighbours. Neighbours with equal phrases
match over the whole phrase, left and right. Neighbours that share only their
first words are extended: one suffix per different phrase fetches its text,
lays every window over its position, from furthest left to furthest right, and
equal windows are counted. A partition's first and last suffixes are extended
as well, since their neighbours may lie beyond. So the spans are exactly the
words of all passages of at least ``min_words`` words that occur twice or more
(up to collisions of 64-bit hashes).

A span is ``later_copy`` if its passages also occur at a smaller doc_id or
earlier in the text; those are what ``drop_repeats`` removes.

A row is known by its doc_id and its text's hash (``row``) all the way, so rows
that share an id, or have none, are places of their own and spread over tasks.

Defined cases: a null or short text has no span; a null doc_id sorts first and
comes back null; of rows under one doc_id the one with the smaller hash is the
earlier place, and passages that only they share are not ``across_documents``;
rows equal in id and text are one place (each other's copies, none the later);
repeats inside one text count and are likewise not ``across_documents``; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, staged

MIN_WORDS = 50
ANCHOR = 25
CACHE_WORDS = 1 << 19
# the id under which rows without one are handled
NO_ID = -(1 << 63)
_B = 0x9E3779B97F4A7C15 | 1
_B_INV = pow(_B, -1, 1 << 64)


class _Hasher:
    """64-bit word hashes (cached) and polynomial hashes of any stretch of a text's words."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}
        self.up = self.down = np.ones(1, "uint64")

    def words(self, text: bytes) -> np.ndarray:
        import xxhash

        words = text.split()
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, words), "uint64", len(words))

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _B, "uint64")], dtype="uint64")
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, _B_INV, "uint64")], dtype="uint64")

    def sums(self, h: np.ndarray) -> np.ndarray:
        self.powers(len(h) + 1)
        return np.r_[np.uint64(0), np.cumsum(h * self.up[:len(h)], dtype="uint64")]

    def stretch(self, sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        """Mixed hashes of the words [start, start + length)."""
        x = (sums[start + length] - sums[start]) * self.down[start]
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of every ``width`` neighbours (the last one of equals)."""
    best, span = np.arange(len(x)), 1

    def merge(best, shift):
        a, b = best[:-shift], best[shift:]
        return np.where(x[b] <= x[a], b, a)
    while span * 2 <= width:
        best, span = merge(best, span), span * 2
    return merge(best, width - span) if width > span else best


def _texts(docs: DataFrame) -> DataFrame:
    """``doc, row, t``: id, hash and bytes of every text."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("row"),
                       text.cast("binary").alias("t")).where("t is not null")


def kept_suffixes(docs: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``doc, row, pos, left, right, head, phrase``: a kept suffix starts at word ``pos``; its phrase are the words
    from ``pos - left`` to ``pos + right + min_words`` and ``head`` the hash of its first ``anchor`` words."""
    bounded_batches(docs.sparkSession)
    src = _texts(docs)

    def run(batches):
        hasher = _Hasher()
        for b in batches:
            parts = []
            for doc, row, t in zip(b.column("doc").to_pylist(), b.column("row").to_pylist(), b.column("t")):
                h = hasher.words(t.as_py())
                n = len(h)
                if n < min_words:
                    continue
                sums = hasher.sums(h)
                heads = hasher.stretch(sums, np.arange(n - anchor + 1), anchor)
                chosen = _window_minima(heads, min_words - anchor + 1)
                first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
                last = np.r_[first[1:], len(chosen)] - 1
                pos = chosen[first]
                phrase = hasher.stretch(sums, first, last - first + min_words)
                phrase ^= ((pos - first).astype("uint64") << np.uint64(32)) * np.uint64(_B)
                parts.append((np.full(len(pos), doc), np.full(len(pos), row), pos, pos - first, last - pos, heads[pos], phrase))
            if parts:
                doc, row, pos, left, right, head, phrase = (np.concatenate(c) for c in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc.astype("int64")), pa.array(row.astype("int64")), pa.array(pos.astype("int32")), pa.array(left.astype("int16")),
                     pa.array(right.astype("int16")), pa.array(head.view("int64")), pa.array(phrase.view("int64"))],
                    names=["doc", "row", "pos", "left", "right", "head", "phrase"])

    return src.mapInArrow(run, "doc long, row long, pos int, left short, right short, head long, phrase long")


def neighbours(suffixes: DataFrame) -> DataFrame:
    """Suffixes with a neighbour of equal head: ``whole`` (its phrase occurs again) and ``extend`` (first of its
    phrase in a run whose phrases differ or that touches a partition's border), with the phrase's
    first and last places (``d0, r0, p0, d1``)."""
    parts = max(1, int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = suffixes.repartitionByRange(parts, "head", "phrase", "doc", "row", "pos").sortWithinPartitions(
        "head", "phrase", "doc", "row", "pos")
    names = ["doc", "row", "pos", "left", "right", "head", "phrase"]

    def judge(t: pa.Table, opens: bool, closes: bool):
        """Verdicts on complete runs; ``opens``/``closes``: the first/last run touches the border."""
        head, phrase = t["head"].to_numpy(), t["phrase"].to_numpy()
        doc, row, pos = (t[c].to_numpy() for c in ("doc", "row", "pos"))
        n = len(head)
        new_run = np.r_[True, head[1:] != head[:-1]]
        new_phrase = new_run | np.r_[True, phrase[1:] != phrase[:-1]]
        run = np.cumsum(new_run) - 1
        group = np.cumsum(new_phrase) - 1
        phrases = np.bincount(run, new_phrase)
        border = np.zeros(run[-1] + 1, bool)
        border[0] |= opens
        border[-1] |= closes
        size = np.bincount(group)
        whole = size[group] > 1
        extend = new_phrase & ((phrases > 1) | border)[run]
        at = np.flatnonzero(new_phrase)
        end = np.r_[at[1:], n] - 1
        keep = whole | extend
        g = group[keep]
        cols = [t[c].to_numpy()[keep] for c in names] + [
            whole[keep], extend[keep], doc[at][g], row[at][g], pos[at][g], doc[end][g]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[*names, "whole", "extend", "d0", "r0", "p0", "d1"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        first = True
        for b in batches:
            if not b.num_rows:
                continue
            head = b.column("head").to_numpy()
            if held and head[-1] == held[0].column("head")[0].as_py():
                held.append(b)  # one run goes on through the whole batch
                continue
            cut = int(np.searchsorted(head, head[-1]))
            done = pa.Table.from_batches([*held, b.slice(0, cut)])
            if done.num_rows:
                yield judge(done, first, False)
                first = False
            held = [b.slice(cut)]
        if held:
            yield judge(pa.Table.from_batches(held), first, True)

    return ranged.mapInArrow(run, "doc long, row long, pos int, left short, right short, head long, phrase long, "
                                  "whole boolean, extend boolean, d0 long, r0 long, p0 int, d1 long")


def windows(docs: DataFrame, suffixes: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``doc, row, start, hash, d1, times``: every window that chose one of the given suffixes, and how often it is known
    to occur from this suffix alone (2: its phrase occurs again)."""
    # rows equal in id and text name the same suffixes
    wanted = suffixes.select("doc", "row", "pos", "left", "right", "head", "d1", "whole").distinct().groupBy("doc", "row").agg(
        F.collect_list(F.struct("pos", "left", "right", "head", "d1", "whole")).alias("at"))
    both = _texts(docs).join(wanted, ["doc", "row"]).select("doc", "row", "t", *[
        F.col(f"at.{c}").alias(c) for c in ("pos", "left", "right", "head", "d1", "whole")])

    def run(batches):
        hasher = _Hasher()
        for b in batches:
            parts = []
            for k in range(b.num_rows):
                h = hasher.words(b.column("t")[k].as_py())
                pos, left, right, head, d1, whole = (
                    b.column(c)[k].values.to_numpy(zero_copy_only=False).astype("int64")
                    for c in ("pos", "left", "right", "head", "d1", "whole"))
                ok = pos + right + min_words <= len(h)
                if not ok.any():
                    continue
                sums = hasher.sums(h)
                pos, left, right, head, d1, whole = (x[ok] for x in (pos, left, right, head, d1, whole))
                # a text of an equal hash may have other words there
                ok = hasher.stretch(sums, pos, anchor).view("int64") == head
                pos, left, right, d1, whole = (x[ok] for x in (pos, left, right, d1, whole))
                n = left + right + 1
                start = np.repeat(pos - left - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                parts.append((*(np.full(len(start), b.column(c)[k].as_py()) for c in ("doc", "row")), start,
                              hasher.stretch(sums, start, min_words), np.repeat(d1, n), np.repeat(1 + whole, n)))
            if parts:
                doc, row, start, hashes, d1, times = (np.concatenate(c) for c in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc.astype("int64")), pa.array(row.astype("int64")), pa.array(start.astype("int32")), pa.array(hashes.view("int64")),
                     pa.array(d1.astype("int64")), pa.array(times.astype("int64"))],
                    names=["doc", "row", "start", "hash", "d1", "times"])

    return both.mapInArrow(run, "doc long, row long, start int, hash long, d1 long, times long")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, start_word, end_word (exclusive), later_copy, first_doc, across_documents, row``."""
    if not 0 < anchor <= min_words:
        raise ValueError("the anchor must not be longer than the shortest repeat")
    found = staged(neighbours(staged(kept_suffixes(docs, min_words, anchor), "suffixes")), "neighbours")
    # a phrase's first suffix that is extended as well gets its places from its windows
    over = found.where("whole and not extend").select(
        "doc", "row", (F.col("pos") - F.col("left")).alias("s"), (F.col("pos") + F.col("right") + min_words).alias("e"),
        (F.struct("doc", "row", "pos") != F.struct(F.col("d0").alias("doc"), F.col("r0").alias("row"), F.col("p0").alias("pos"))).alias("later"),
        F.col("d0").alias("first"), (F.col("d0") != F.col("d1")).alias("across"))
    win = staged(windows(docs, found.where("extend"), min_words, anchor), "windows")
    shared = win.groupBy("hash").agg(
        F.sum("times").alias("n"), F.min(F.struct("doc", "row", "start")).alias("p"), F.max("d1").alias("last")).where("n > 1")
    extended = win.join(shared, "hash").select(
        "doc", "row", F.col("start").alias("s"), (F.col("start") + min_words).alias("e"),
        (F.struct("doc", "row", "start") != F.col("p")).alias("later"), F.col("p.doc").alias("first"),
        (F.col("p.doc") != F.col("last")).alias("across"))
    spans = over.unionByName(extended)
    by_place = Window.partitionBy("doc", "row", "later").orderBy("s", "e")
    ended = F.max("e").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(
        by_place.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.withColumn("reach", ended).withColumn("island", island).groupBy("doc", "row", "later", "island").agg(
        F.min("s").alias("start_word"), F.max("e").alias("end_word"), F.min("first").alias("first"),
        F.max("across").alias("across_documents"))
    name = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return merged.select(name("doc").alias("doc_id"), "start_word", "end_word", F.col("later").alias("later_copy"),
                         name("first").alias("first_doc"), "across_documents", "row")


def drop_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` whose texts lack the words of their later copies (blanks after a removed word go with it)."""
    bounded_batches(docs.sparkSession)
    cuts, other, row = fresh(docs, "cuts", "other", "row")
    gone = spans.where("later_copy").groupBy(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(other), F.col("row").alias(row)).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias(cuts))
    joined = docs.withColumn(other, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(
        row, F.xxhash64(F.col("text").cast("string"))).join(gone, [other, row], "left").select(*[F.col(f"`{c}`") for c in docs.columns], cuts)
    names = docs.columns

    def run(batches):
        import re

        for b in batches:
            texts = b.column("text").to_pylist()
            for k, c in enumerate(b.column(cuts).to_pylist()):
                if c and texts[k]:
                    words = list(re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", texts[k]))
                    out = bytearray(b"\1") * len(words)
                    for x in c:
                        out[x["start_word"]:x["end_word"]] = bytes(min(x["end_word"], len(words)) - x["start_word"])
                    head = texts[k][:words[0].start()]
                    texts[k] = head + "".join(w[0] for w, keep in zip(words, out) if keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names], names=names)

    return joined.mapInArrow(run, docs.schema)
