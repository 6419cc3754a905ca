"""Quality rules on repetition inside a text, from suffix arrays over words.

A task reads whole texts in batches of bounded size, lays their words end to
end and builds one suffix array over the batch by prefix doubling (a suffix
ends with its own text, so no match crosses texts). Only suffixes that still
share their prefix with another are sorted again, so the rounds grow with the
longest repeat and the work with the repeated part. Common prefixes of
neighbouring suffixes follow from the ranks of each round. The longer of the
two neighbour prefixes at a position is the longest repeat that starts there:
the spans of all maximal repeated substrings of at least ``min_repeat`` words
are the union of those, and a text passes if that union covers at most
``max_covered`` of its words and no repeat is longer than ``max_longest``.

Defined cases: a null or empty text has no words, zero counts and fails the
word minimum; a text longer than a batch is a batch of its own; rows are
judged one by one, so repeated rows get equal results; an empty table gives no
rows; extra columns are kept by ``drop_repetitive``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh

# Production parameters: a repeat counts from this many words, may cover this
# share of the words, and may be this long.
MIN_REPEAT = 10
MAX_COVERED = 0.3
MAX_LONGEST = 100
MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
WINDOW = 3
# fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"

BATCH_WORDS = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def repeat_lengths(word: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Per position, the words of the longest prefix of its suffix that occurs elsewhere in the same text.

    ``word``: word numbers, already different between texts; ``end``: per
    position, the index after its text.
    """
    n = len(word)
    best = np.zeros(n, "int64")
    if n < 2:
        return best
    sa = np.argsort(word, kind="stable")
    ranks = []
    rank = np.empty(n, "int64")
    head = np.r_[True, word[sa][1:] != word[sa][:-1]]
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    k = 1
    while True:
        ranks.append(rank)
        alone = head & np.r_[head[1:], True]
        slot = np.flatnonzero(~alone)
        if not len(slot):
            break
        i = sa[slot]
        j = i + k
        second = np.where(j < end[i], rank[np.minimum(j, n - 1)] + 1, 0)
        first = rank[i]
        order = np.lexsort((second, first))
        i, first, second = i[order], first[order], second[order]
        sa[slot] = i
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        head = head.copy()
        head[slot] = new
        rank = rank.copy()
        rank[i] = slot[np.maximum.accumulate(np.where(new, np.arange(len(slot)), 0))]
        k *= 2
    # neighbours in the suffix array that share at least a word
    pair = np.flatnonzero(ranks[0][sa[1:]] == ranks[0][sa[:-1]])
    a, b = sa[pair], sa[pair + 1]
    x, y = a.copy(), b.copy()
    for level in range(len(ranks) - 1, -1, -1):
        r = ranks[level]
        inside = (x < end[a]) & (y < end[b])
        same = np.zeros(len(x), bool)
        xi, yi = x[inside], y[inside]
        same[inside] = (r[xi] == r[yi]) & (xi + (1 << level) <= end[a][inside]) & (yi + (1 << level) <= end[b][inside])
        x[same] += 1 << level
        y[same] += 1 << level
    lcp = x - a
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def _covered(best: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a span [i, i + best[i]) of at least ``least``."""
    edge = np.zeros(len(best) + 1, "int64")
    at = np.flatnonzero(best >= least)
    edge[at] += 1
    np.subtract.at(edge, at + best[at], 1)
    return np.cumsum(edge[:-1]) > 0


def _batch_stats(texts: list[bytes], min_repeat: int) -> dict[str, np.ndarray]:
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], "int64")
    chars = np.zeros(len(texts), "int64")
    symbols = np.zeros(len(texts), "int64")
    dup_lines = np.zeros(len(texts), "int64")
    for k, t in enumerate(texts):
        b = np.frombuffer(t, "uint8")
        # code points that start in a word: no continuation byte, no blank
        chars[k] = np.count_nonzero(((b & 0xC0) != 0x80) & ~_BLANK[b])
        symbols[k] = sum(t.count(SYMBOLS[i:i + 1]) for i in range(len(SYMBOLS)))
        lines = [x for x in t.split(b"\n") if x.strip()]
        dup_lines[k] = len(lines) - len(set(lines))
    total = int(n.sum())
    text_of = np.repeat(np.arange(len(texts)), n)
    ends = np.cumsum(n)
    flat = pa.array([w for ws in words for w in ws], pa.large_binary())
    ids = flat.dictionary_encode().indices.to_numpy().astype("int64") if total else np.empty(0, "int64")
    best = repeat_lengths(text_of * (ids.max(initial=0) + 1) + ids, ends[text_of])

    def per_text(mask):
        return np.bincount(text_of[mask], minlength=len(texts)).astype("int64")

    longest = np.zeros(len(texts), "int64")
    np.maximum.at(longest, text_of, best)
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": per_text(_covered(best, WINDOW)), "n_covered_words": per_text(_covered(best, min_repeat)),
            "longest_repeat": longest}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")


def repetition_stats(df: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the seven counts of every row's whole text."""
    bounded_batches(df.sparkSession)
    hidden, = fresh(df, "__text")
    src = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias(hidden))
    schema = src.drop(hidden).select("*", *[F.lit(0).cast("long").alias(c) for c in COUNTS]).schema

    def run(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(hidden)]
            at, parts = 0, []
            while at < len(texts):  # a word takes at least two bytes of a text
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) // 2 <= BATCH_WORDS):
                    size += len(texts[to]) // 2
                    to += 1
                parts.append(_batch_stats(texts[at:to], min_repeat))
                at = to
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [b.column(c) for c in keep] + [pa.array(np.concatenate([p[c] for p in parts])) for c in COUNTS],
                    names=[*keep, *COUNTS])

    return src.mapInArrow(run, schema)


def verdicts(stats: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_WORDS_PERCENT * F.col("n_words"))
    fine = (F.col("n_covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)


def drop_repetitive(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without the rows that the rules reject."""
    kept = tuple(docs.columns)
    names = fresh(docs, *COUNTS, "base_failed", "kept")
    if names != [*COUNTS, "base_failed", "kept"]:
        renamed = docs.select([F.col(f"`{c}`").alias(f"__in_{c}") for c in kept])
        judged = verdicts(repetition_stats(renamed, "__in_text", keep=tuple(renamed.columns)), **limits)
        return judged.where("kept").select([F.col(f"`__in_{c}`").alias(c) for c in kept])
    return verdicts(repetition_stats(docs, "text", keep=kept), **limits).where("kept").select(*kept)
