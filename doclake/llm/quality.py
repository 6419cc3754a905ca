"""Quality classifier with site posteriors (hierarchical empirical Bayes).

Document evidence: logistic regression on which words (hashed, lower case),
beginnings of words and shape classes (shares of shouted, symbol, table and
repeated words, length) a text has; one model for quality and one for toxicity, fitted on at
most ``MAX_LABELLED`` labelled documents (those with the smallest hash of
doc_id; the documented bound) and applied to all whole texts.

Site evidence: grouped sums of the document probabilities per path and per
host. The global prior is the mean over all documents; how far hosts differ
from it, and paths from their hosts, beyond what their sizes explain, sets the
weight of the two priors (method of moments). A host's posterior shrinks its
mean towards the global one, a path's towards its host's, the more the fewer
documents they have. A document's score is its own evidence with the prior
odds replaced by its path's posterior.

``kept``: good with at least even odds and toxic with less.

Defined cases: a null text is an empty one; a null host or path is a site of
its own; several labels of one document are all used, labels with a null are
not; without labels of both kinds a model predicts its class share (1 for
quality and 0 for toxicity without any); repeated rows count and are scored
one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, staged

MAX_LABELLED = 8192
BUCKETS = 1 << 18
SHAPES = 64
# besides whole words, their first letters are features: inflected forms share them
BEGINNINGS = (4, 5, 6)
CACHE_WORDS = 1 << 19
ROUNDS = 60
RIDGE = 0.1
# a feature counts from this many standard errors of its log odds ratio
CHANCE = 2.5
MAX_PRIOR = 1e4
_SYMBOL = frozenset(b"#*$%&|<>!")


class _Features:
    """Feature numbers of a text: hashed words, and shape classes above them."""

    def __init__(self):
        self.cache: dict[bytes, tuple[list[int], int]] = {}

    def word(self, w: bytes) -> tuple[list[int], int]:
        """(buckets of the word and its beginnings, shape bits: 1 shouted, 2 symbol, 4 bar)"""
        import xxhash

        s = w.decode("utf-8", "replace")
        a, b = 0, len(s)
        while a < b and not s[a].isalnum():
            a += 1
        while b > a and not s[b - 1].isalnum():
            b -= 1
        core = s[a:b].lower()
        shape = (s.isupper() and len(s) > 1) | (sum(c in _SYMBOL for c in w) > 0) << 1 | (w == b"|") << 2
        parts = [core] + [f"{core[:n]}-" for n in BEGINNINGS if len(core) > n]
        return [xxhash.xxh3_64_intdigest(x.encode()) % BUCKETS for x in parts], shape

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        distinct = set(words)
        for w in distinct.difference(cache):
            cache[w] = self.word(w)
        buckets = np.fromiter({x for w in distinct for x in cache[w][0]}, "int64")
        buckets.sort()
        n = max(1, len(words))
        shape = np.fromiter((cache[w][1] for w in words), "int64", len(words))
        shares = [np.count_nonzero(shape & bit) / n for bit in (1, 2, 4)] + [
            1 - len(distinct) / n, sum(a == b for a, b in zip(words, words[1:])) / n]
        classes = [BUCKETS + 8 * k + int(np.searchsorted([1e-9, .01, .03, .1, .2, .4, .7], x, "right"))
                   for k, x in enumerate(shares)]
        classes.append(BUCKETS + 40 + min(15, len(words).bit_length()))
        return np.r_[buckets, classes]


def labelled_features(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``quality, toxic, feats`` of at most ``bound`` labelled documents."""
    few = labels.where("doc_id is not null and (quality is not null or toxic is not null)").select(
        "doc_id", "quality", "toxic", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(bound).drop("h")
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t")).join(
        few, "doc_id").select("quality", "toxic", "t")

    def run(batches):
        features = _Features()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("quality").cast(pa.int32()), b.column("toxic").cast(pa.int32()),
                 pa.array([features.of(t.as_py()) for t in b.column("t")], pa.list_(pa.int64()))],
                names=["quality", "toxic", "feats"])

    return src.mapInArrow(run, "quality int, toxic int, feats array<long>")


def class_counts(sample: DataFrame) -> dict[str, np.ndarray]:
    """Per class value, the labelled documents that have each feature; the last entry counts all documents."""
    values = [("quality", 1), ("quality", 0), ("toxic", 1), ("toxic", 0)]
    sums = [(F.sum((F.col(c) == v).cast("int")), f"{c}{v}") for c, v in values]
    # every document has the extra feature ALL; at most one row per feature number comes back
    rows = sample.select("quality", "toxic", F.explode(F.array_append("feats", F.lit(BUCKETS + SHAPES))).alias("f"))
    found = rows.groupBy("f").agg(*[F.coalesce(x, F.lit(0)).cast("int").alias(n) for x, n in sums]).toArrow()
    out = {}
    for _, n in sums:
        out[n] = np.zeros(BUCKETS + SHAPES + 1)
        out[n][found["f"].to_numpy()] = found[n].to_numpy()
    return out


def scales(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """How much more often a feature occurs in one class, in log odds, less what chance explains (0: nothing)."""
    (pos, n_pos), (neg, n_neg) = (pos[:-1], pos[-1]), (neg[:-1], neg[-1])
    ratio = np.log((pos + .5) / (n_pos - pos + .5)) - np.log((neg + .5) / (n_neg - neg + .5))
    error = np.sqrt(1 / (pos + .5) + 1 / (n_pos - pos + .5) + 1 / (neg + .5) + 1 / (n_neg - neg + .5))
    return np.where(pos + neg > 0, np.sign(ratio) * np.maximum(0, np.abs(ratio) - CHANCE * error), 0)


def telling_features(sample: DataFrame, used: np.ndarray) -> DataFrame:
    """The sample with only the features marked in ``used``."""
    def run(batches):
        for b in batches:
            feats = b.column("feats")
            flat = feats.values.to_numpy()[feats.offsets[0].as_py():feats.offsets[-1].as_py()]
            keep = used[flat]
            ends = np.r_[0, np.cumsum(keep)][feats.offsets.to_numpy() - feats.offsets[0].as_py()]
            yield pa.RecordBatch.from_arrays(
                [b.column("quality"), b.column("toxic"),
                 pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(flat[keep]))],
                names=["quality", "toxic", "feats"])

    return sample.mapInArrow(run, sample.schema)


def fit(flat: np.ndarray, row: np.ndarray, label: np.ndarray, scale: np.ndarray,
        default: float) -> tuple[np.ndarray, float]:
    """(weights, bias) of a ridge logistic regression on present features (``flat``, of document ``row``), each scaled
    by its log odds ratio between the classes, by adaptive gradient steps."""
    weights = np.zeros(BUCKETS + SHAPES)
    if not len(label) or label.min() == label.max():
        share = label.mean() if len(label) else default
        return weights, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    used = np.flatnonzero(scale)
    number = np.full(len(scale), -1)
    number[used] = np.arange(len(used))
    told = number[flat] >= 0
    col, row = number[flat][told], row[told]
    n = len(label)
    w, bias = np.zeros(len(used)), float(np.log((label > 0).sum() / (label <= 0).sum()))
    second, second_b = np.full(len(used), 1e-8), 1e-8
    x = scale[used][col]
    for _ in range(ROUNDS):
        z = np.bincount(row, w[col] * x, n) + bias
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        g = np.bincount(col, err[row] * x, len(used)) + RIDGE * w
        second += g * g
        second_b += err.sum() ** 2
        w -= 0.3 * g / np.sqrt(second)
        bias -= 0.3 * err.sum() / np.sqrt(second_b)
    weights[used] = w * scale[used]
    return weights, bias


def document_scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
                    bound: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, host, path, quality, toxic``: the classifiers' log odds of every document."""
    bounded_batches(docs.sparkSession)
    sample = staged(labelled_features(docs, labels, bound), "labelled")
    counts = class_counts(sample)
    scale = {c: scales(counts[f"{c}1"], counts[f"{c}0"]) for c in ("quality", "toxic")}
    # at most ``bound`` rows, with the features that tell the classes apart
    told = telling_features(sample, (scale["quality"] != 0) | (scale["toxic"] != 0)).toArrow().combine_chunks()
    models = []
    for name, default in (("quality", 1.0), ("toxic", 0.0)):
        part = told.filter(pc.is_valid(told[name])).combine_chunks()
        size = pc.list_value_length(part["feats"]).to_numpy()
        models.append(fit(pc.list_flatten(part["feats"]).to_numpy(), np.repeat(np.arange(len(size)), size),
                          part[name].to_numpy().astype("float64"), scale[name], default))
    (wq, bq), (wt, bt) = ((w.astype("float32"), b) for w, b in models)
    src = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t"))
    schema = src.drop("t").schema.add("quality", "double").add("toxic", "double")

    def run(batches):
        features = _Features()
        for b in batches:
            feats = [features.of(t.as_py()) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "host", "path")]
                + [pa.array([float(w[f].sum(dtype="float64")) + z for f in feats], pa.float64())
                   for w, z in ((wq, bq), (wt, bt))], names=["doc_id", "host", "path", "quality", "toxic"])

    return src.mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, rate: Column, prior: Column) -> Column:
    """Prior weight, in documents, from the groups' spread around their priors beyond sampling noise."""
    n = F.col("n").cast("double")
    noise = F.sum(prior * (1 - prior))
    spread = F.sum(n * (rate - prior) * (rate - prior)) - noise
    size = F.sum(n) - F.sum(n * n) / F.sum(n)
    between = F.greatest(spread / F.greatest(size, F.lit(1.0)), F.lit(1e-9))
    within = F.sum(n * prior * (1 - prior)) / F.sum(n)
    return F.least(F.greatest(within / between - 1, F.lit(1.0)), F.lit(MAX_PRIOR))


def site_posteriors(scores: DataFrame, column: str) -> DataFrame:
    """``host, path, base, host_post, path_post`` for the probability behind the log odds ``column``."""
    p = 1 / (1 + F.exp(-F.least(F.greatest(F.col(column), F.lit(-30.0)), F.lit(30.0))))
    paths = staged(scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    base = hosts.agg((F.sum("s") / F.sum("n")).alias("base"))
    rate = F.col("s") / F.col("n")
    first = base.first()["base"]
    if first is None:
        return paths.select("host", "path", *[F.lit(None).cast("double").alias(c) for c in ("base", "host_post", "path_post")])
    k_host = hosts.agg(_strength(hosts, rate, F.lit(first)).alias("k")).first()["k"]
    host_post = hosts.select(F.col("host").alias("h"), ((F.col("s") + k_host * first) / (F.col("n") + k_host)).alias("host_post"))
    both = paths.join(host_post, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = both.agg(_strength(both, rate, F.col("host_post")).alias("k")).first()["k"]
    return both.select("host", "path", F.lit(first).alias("base"), "host_post",
                       ((F.col("s") + k_path * F.col("host_post")) / (F.col("n") + k_path)).alias("path_post"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
                     bound: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, host, path``, per class the document's and path's evidence and the combined probability, ``kept``."""
    scores = staged(document_scores(docs, labels, host, path, bound), "scores")
    out = scores
    for c in ("quality", "toxic"):
        sites = staged(site_posteriors(scores, c), "sites").select(
            F.col("host").alias("h"), F.col("path").alias("p"), "base", F.col("host_post").alias(f"{c}_host"),
            F.col("path_post").alias(f"{c}_path"))
        z = F.col(c) + _logit(F.col(f"{c}_path")) - _logit(F.col("base"))
        out = out.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))).withColumn(
            f"p_{c}", 1 / (1 + F.exp(-z))).drop("h", "p", "base")
    return out.select("doc_id", "host", "path", F.col("quality").alias("quality_logit"), "quality_host", "quality_path",
                      "p_quality", F.col("toxic").alias("toxic_logit"), "toxic_host", "toxic_path", "p_toxic",
                      ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("kept"))
