"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is cut into windows of ``WINDOW`` words (one word shared by
neighbours), lower case, and every window is compressed twice: behind an
ordinary and behind a toxic dictionary. Both hold the same trained base of
ordinary windows; before it stand phrases trained on what is told of one class:
words that occur in many more different contexts there than in the other one
(contexts, since copies of a document repeat theirs). The window's gain is the
bytes that the toxic dictionary saves.

Calibration: how often windows of ordinary documents reach a gain by chance
turns a document's ``TOP`` largest gains into expected numbers of such windows
in a text of its length, and a ridge logistic regression on their logarithms
gives the score. Dictionaries are learned from labelled rows whose crc32 of
the id (mod ``FOLDS``) is above 1, the calibration from those where it is 1;
remainder 0 is held out and never learned from. At most ``MAX_LABELLED``
documents of each class are used for each (those with the smallest hash of
doc_id, the documented bound); all whole texts are scored. Labels, lang,
source and doc_id are no input of a score.

Defined cases: a null text is an empty one and scores as a text without any
gain; several labels of one document make it toxic if one says so, labels with
a null are not used; a null doc_id is not held out and never learned from;
without labels of both kinds no phrase is told and the score is the (smoothed)
share of toxic ones; where the calibration rows lack a class (``FEW`` of it),
all rows that may be learned from calibrate; repeated rows are scored one by
one; a very long text is cut chunk by chunk; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import bounded_batches, staged

WINDOW = 12
FOLDS = 5
MAX_LABELLED = 8192
FEW = 20
TOP = 3
# words that count as told of a class: standard errors and log odds ratio at least
CHANCE = 3.5
RATIO = 1.5
MAX_TOLD = 4096
REPEAT = 50
BASE_BYTES = 30 << 10
TOLD_BYTES = 2 << 10
BASE_WINDOWS = 60_000
LEVEL = 12
MAX_GAIN = 64
CHUNK_BYTES = 1 << 20
RIDGE = 0.1
_SPACE = re.compile(rb"\s")


def windows(text: bytes):
    """The windows of a text's words; a very long text is split chunk by chunk."""
    at, words, first = 0, [], True
    while at < len(text):
        end = at + CHUNK_BYTES
        if end < len(text):
            stop = _SPACE.search(text, end)
            end = stop.start() if stop else len(text)
        words += text[at:end].split()
        at = end
        done = max(0, len(words) - WINDOW + 1)
        used = 0
        for i in range(0, done, WINDOW - 1):
            yield b" " + b" ".join(words[i:i + WINDOW]) + b" "
            used, first = i + WINDOW - 1, False
        words = words[used:]
    if len(words) > (not first):  # the shared word alone is in the window before
        yield b" " + b" ".join(words) + b" "


class Distance:
    """Bytes that the toxic dictionary saves on a window."""

    def __init__(self, base: bytes, ordinary: bytes, toxic: bytes):
        self.made = [self._compressor(told + base) for told in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes):
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=3, write_content_size=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        if not content:
            return zstandard.ZstdCompressor(compression_params=params)
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=known, compression_params=params)

    def histogram(self, text: bytes) -> np.ndarray:
        """How many windows have each gain (0 for none or less, the last for that much or more)."""
        ordinary, toxic = (c.compress for c in self.made)
        out = np.zeros(MAX_GAIN, "int64")
        for w in windows(text):
            out[min(MAX_GAIN - 1, max(0, len(ordinary(w)) - len(toxic(w))))] += 1
        return out


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a zstandard dictionary trained on the samples; too few of them are it themselves."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size + 1024, samples, k=24 if size > TOLD_BYTES else 16, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def labelled(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``toxic, fold, t``: texts that may be learned from, at most ``bound`` documents per class and use."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).withColumn("fold", fold).where("fold > 0").withColumn(
        "h", F.xxhash64("doc_id"))
    few = None
    for toxic in (0, 1):
        for use in ("fold = 1", "fold > 1"):
            part = known.where((F.col("toxic") == toxic) & F.expr(use)).orderBy("h", "doc_id").limit(bound)
            few = part if few is None else few.unionByName(part)
    few = few.select("doc_id", "toxic", "fold")  # at most 4 * bound rows: broadcast, so that no text moves
    return docs.select("doc_id", _text().alias("t")).join(F.broadcast(few), "doc_id").select("toxic", "fold", "t")


def _text() -> Column:
    return F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary")


def context_counts(sample: DataFrame) -> DataFrame:
    """``word, toxic, n``: in how many different contexts (the word before and after) a word occurs in a class."""
    def run(batches):
        import xxhash

        for b in batches:
            for toxic, text in zip(b.column("toxic").to_pylist(), b.column("t")):
                words = text.as_py().split()
                seen = {(w, xxhash.xxh3_64_intdigest(p + b" " + n) - (1 << 63))
                        for p, w, n in zip([b"", *words], words, [*words[1:], b""])}
                for part in _parts(list(seen), 1 << 16):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w for w, _ in part], pa.binary()), pa.array([h for _, h in part], pa.int64()),
                         pa.array([toxic] * len(part), pa.int32())], names=["word", "context", "toxic"])

    return sample.select("toxic", "t").mapInArrow(run, "word binary, context long, toxic int").distinct().groupBy(
        "word", "toxic").agg(F.count(F.lit(1)).alias("n"))


def _parts(rows: list, size: int):
    for i in range(0, len(rows), size):
        yield rows[i:i + size]


def told_words(counts: DataFrame) -> dict[int, list[bytes]]:
    """Per class, samples of the words that tell it (at most ``MAX_TOLD`` words), repeated by how often they do."""
    totals = {r["toxic"]: r["n"] for r in counts.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    if len(totals) < 2:
        return {0: [], 1: []}
    per = counts.groupBy("word").agg(*[F.coalesce(F.sum(F.when(F.col("toxic") == c, F.col("n"))), F.lit(0)).cast(
        "double").alias(f"n{c}") for c in (0, 1)])
    odds = {c: F.log((F.col(f"n{c}") + .5) / (totals[c] - F.col(f"n{c}") + .5)) for c in (0, 1)}
    error = F.sqrt(sum(1 / (F.col(f"n{c}") + .5) + 1 / (totals[c] - F.col(f"n{c}") + .5) for c in (0, 1)))
    out = {}
    for c in (0, 1):
        ratio = odds[c] - odds[1 - c]
        rows = per.where((ratio > RATIO) & (ratio > CHANCE * error)).select(
            "word", F.least(F.col(f"n{c}"), F.lit(float(REPEAT))).cast("int").alias("k"), (ratio / error).alias("z")
        ).orderBy(F.desc("z"), "word").limit(MAX_TOLD).collect()
        words = [b" " + bytes(r["word"]) + b" " for r in rows for _ in range(r["k"])]
        order = np.random.default_rng(7).permutation(len(words))
        out[c] = [b"".join(words[i] for i in part) for part in _parts(list(order), 8)]
    return out


def base_samples(sample: DataFrame) -> list[bytes]:
    """Windows of ordinary texts: those with the smallest hashes, at most ``BASE_WINDOWS``."""
    def run(batches):
        import xxhash

        for b in batches:
            for text in b.column("t"):
                for part in _parts(list(windows(text.as_py())), 1 << 14):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in part], pa.int64()),
                         pa.array(part, pa.binary())], names=["h", "w"])

    rows = sample.where("toxic = 0").select("t").mapInArrow(run, "h long, w binary")
    return [bytes(r["w"]) for r in rows.distinct().orderBy("h").limit(BASE_WINDOWS).collect()]


def with_histograms(texts: DataFrame, base: bytes, ordinary: bytes, toxic: bytes) -> DataFrame:
    """The rows with ``gains`` (windows by gain) in place of their text ``t``."""
    kept = [c for c in texts.columns if c != "t"]

    def run(batches):
        distance = Distance(base, ordinary, toxic)
        for b in batches:
            gains = [distance.histogram(t.as_py()) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(gains, pa.list_(pa.int64()))],
                                             names=[*kept, "gains"])

    return texts.mapInArrow(run, texts.select(*kept).schema.add("gains", ArrayType(LongType())))


def chance_rates(gains: np.ndarray) -> np.ndarray:
    """Share of ordinary windows with at least each gain; beyond the largest one seen it goes on falling."""
    total = gains.sum(0) if len(gains) else np.zeros(MAX_GAIN)
    reach = np.cumsum(total[::-1])[::-1]
    rate = (reach + .5) / (total.sum() + 1)
    rate[0] = 1
    for g in range(1, MAX_GAIN):
        rate[g] = min(rate[g], rate[g - 1]) if reach[g] else rate[g - 1] * .3
    return rate


def evidence(gains: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Per document, for its TOP largest gains, minus the log of the windows expected to reach them by chance."""
    n = np.maximum(1, gains.sum(1))
    reach = np.cumsum(gains[:, ::-1], 1)[:, ::-1]  # windows with at least each gain
    out = np.zeros((len(gains), TOP))
    for k in range(TOP):
        best = (reach > k).sum(1) - 1  # the (k+1)th largest gain, -1 without so many windows
        out[:, k] = -np.log(n * rate[np.maximum(0, best)] / (k + 1))
    return np.maximum(out, -10)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        share = (y.sum() + .5) / (len(y) + 1) if len(y) else .05
        w[-1] = np.log(share / (1 - share))
        return w
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    ridge = np.diag([RIDGE] * (len(w) - 1) + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_windows, best_gain`` of every document."""
    bounded_batches(docs.sparkSession)
    sample = staged(labelled(docs, labels, bound), "labelled")
    learn = sample.where("fold > 1")
    told = told_words(staged(context_counts(learn), "contexts"))
    base = trained(base_samples(learn), BASE_BYTES)
    ordinary, toxic = trained(told[0], TOLD_BYTES), trained(told[1], TOLD_BYTES)
    if told[1] and not ordinary:
        ordinary = base[:len(toxic)]  # nothing tells ordinary text: more of what is common in it
    known = with_histograms(sample, base, ordinary, toxic).toArrow()  # at most 4 * bound rows
    y, fold = (known[c].to_numpy() for c in ("toxic", "fold"))
    gains = np.array(known["gains"].to_pylist(), "int64").reshape(-1, MAX_GAIN)
    use = fold == 1
    if min((use & (y == 1)).sum(), (use & (y == 0)).sum()) < FEW:
        use = fold > 0
    rate = chance_rates(gains[use & (y == 0)])
    w = fit(evidence(gains[use], rate), y[use].astype("float64"))
    scored = with_histograms(docs.select("doc_id", _text().alias("t")), base, ordinary, toxic)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            g = b.column("gains").flatten().to_numpy().reshape(-1, MAX_GAIN)
            z = np.c_[evidence(g, rate), np.ones(len(g))] @ w
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            best = np.where(g > 0, np.arange(MAX_GAIN), 0).max(1) if len(g) else np.zeros(0, "int64")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(score), pa.array((score >= .5).astype("int32")),
                 pa.array(g.sum(1)), pa.array(best.astype("int32"))],
                names=["doc_id", "score", "predicted", "n_windows", "best_gain"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return scored.mapInArrow(run, f"doc_id {id_type}, score double, predicted int, n_windows long, best_gain int").select(
        "doc_id", held.alias("held_out"), "score", "predicted", "n_windows", "best_gain")
