"""Benchmark passages in a corpus by latent semantic retrieval.

The words of the benchmark items and answers are the features. One pass over all texts
turns them into feature numbers (other words cannot match an item) and counts
in how many passages of ``PASSAGE`` words each feature occurs; that gives the
IDF weights. A second pass makes the randomised SVD of the TF-IDF passages:
every task multiplies its passages with a random matrix and the result with
their transpose, the products are summed over all tasks, and the leading
singular vectors of the sum, together with the span of the items' own vectors,
are the latent space. The third pass takes overlapping windows of all texts,
with the words around them that the checks read, and searches the items by
their cosine with these words in the latent space. An item is a candidate if
the cosine is not below the least that a window of that norm can have with an
item of which it holds ``PARAPHRASE``: the space holds the items' span, so other
or repeated words beside a leak, which lower its cosine, cannot hide it.
A candidate is a leak if the longest common subsequence of the item and the
text around the window holds at least ``NEAR_VERBATIM`` of the
item, or, for paraphrases, at least ``PARAPHRASE`` of it and the item's answer
(its last words, or a column of its own) stands there in one piece.

The benchmark is the query set: its items are handled in blocks of
``BLOCK_ITEMS``, which bounds what is sent to the tasks; all texts meet all
items.

Defined cases: words are compared in lower case without punctuation at their
ends; a null text and an item without words have no leak; equal items each
report; rows with equal doc_id and text share their verdict; a null doc_id is
reported as null and dropped with its text; empty tables give no rows; extra
columns are ignored, and kept by ``drop_leaks``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, staged

PASSAGE = 64
STRIDE = 32
RANK = 16
OVERSAMPLE = 8
NEAR_VERBATIM = 0.8
PARAPHRASE = 0.6
ANSWER_WORDS = 5
BLOCK_ITEMS = 512
SEED = 7
CACHE_WORDS = 1 << 19
# words that are projected at a time
CHUNK = 1 << 15
# so many of the most frequent features are counted per row and multiplied as a matrix; the rest are added one by one
FREQUENT = 128
# distinct words of rows are found in a table of flags up to this size, by sorting beyond
FLAGS = 1 << 23
# how much a cosine in single precision may be off
SLACK = 1e-4


def normal(word: bytes) -> str:
    """Lower case, without punctuation and symbols at the ends."""
    s = word.decode("utf-8", "replace").lower()
    a, b = 0, len(s)
    while a < b and not s[a].isalnum():
        a += 1
    while b > a and not s[b - 1].isalnum():
        b -= 1
    return s[a:b]


def words_of(text: str | None) -> list[str]:
    return [w for w in map(normal, (text or "").encode().split()) if w]


class _Items:
    """A block of benchmark items as feature numbers."""

    def __init__(self, rows: list[tuple[int, str, str | None]]):
        self.ids = [r[0] for r in rows]
        words = [words_of(r[1]) for r in rows]
        answers = [words_of(r[2]) for r in rows]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for ws in words + answers for w in ws))}
        self.seqs = [[self.number[w] for w in ws] for ws in words]
        self.answers = [[self.number[w] for w in a] if r[2] else s[-ANSWER_WORDS:]
                        for r, a, s in zip(rows, answers, self.seqs)]

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.seqs), len(self.number)))
        for k, s in enumerate(self.seqs):
            np.add.at(out[k], s, idf[s])
        return out


def common_subsequence(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, by bit operations on a whole column."""
    where: dict[int, int] = {}
    for k, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        m = where.get(w, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _holds(part: list[int], text: list[int]) -> bool:
    n = len(part)
    return n > 0 and any(text[i:i + n] == part for i in range(len(text) - n + 1) if text[i] == part[0])


class _Numbers(dict):
    """Raw word -> feature number (-1: another word, -3: only punctuation), filled as words are met."""

    def __init__(self, number: dict[str, int]):
        self.number = number

    def __missing__(self, word: bytes) -> int:
        w = normal(word)
        n = self[word] = self.number.get(w, -1) if w else -3
        return n


def encode(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """``doc_id, mark, seq``: the texts as feature numbers (-1: other words) and a hash of the text.

    Tokens of punctuation only are no words, as in ``words_of``.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col("text").cast("string").cast("binary").alias("t"))
    schema = src.drop("t").withColumn("seq", F.lit(b"")).schema
    kind = "<i2" if len(number) < 1 << 15 else "<i4"

    def run(batches):
        numbers = _Numbers(number)
        for b in batches:
            seqs = []
            for t in b.column("t"):
                if len(numbers) > CACHE_WORDS:
                    numbers.clear()
                words = (t.as_py() or b"").split()
                seq = np.fromiter(map(numbers.__getitem__, words), kind, len(words))
                seqs.append(seq[seq != -3].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("mark"), pa.array(seqs, pa.binary())], names=["doc_id", "mark", "seq"])

    return src.where("t is not null").mapInArrow(run, schema)


class _Rows:
    """Sums of feature vectors per row (a passage or a block); rows come in ascending order."""

    def __init__(self, seen: np.ndarray):
        self.top = np.argsort(-seen, kind="stable")[:FREQUENT]
        self.slot = np.full(len(seen), -1)
        self.slot[self.top] = np.arange(len(self.top))

    def split(self, word: np.ndarray, row: np.ndarray, n: int):
        """Counts of the frequent features per row, and the other words."""
        k, s = len(self.top), self.slot[word]
        often = s >= 0
        counts = np.bincount(row[often] * k + s[often], minlength=n * k).reshape(n, k).astype("float32")
        return counts, word[~often], row[~often]

    def sums(self, parts, table: np.ndarray) -> np.ndarray:
        counts, word, row = parts
        out = counts @ table[self.top]
        if len(word):
            head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[row[head]] += np.add.reduceat(table[word], head, axis=0)
        return out


def _flat(batch, kind: str):
    """All words of a batch that are features, and their passage; how many passages there are."""
    seqs = [np.frombuffer(s.as_py(), kind) for s in batch.column("seq")]
    size = np.array([len(s) for s in seqs], "int64")
    first = np.r_[0, np.cumsum(-(-size // PASSAGE))]
    word = np.concatenate(seqs) if len(seqs) else np.empty(0, kind)
    start = np.r_[0, np.cumsum(size)[:-1]] if len(seqs) else size
    inside = np.arange(len(word)) - np.repeat(start, size)
    passage = np.repeat(first[:-1], size) + inside // PASSAGE
    ok = word >= 0
    return word[ok].astype("int64"), passage[ok], int(first[-1])


def _once(row: np.ndarray, word: np.ndarray, n_rows: int, n_features: int) -> np.ndarray:
    """The distinct ``row * n_features + word`` in ascending order."""
    pair = row.astype("int64") * n_features + word
    if n_rows * n_features > FLAGS:
        return np.unique(pair)
    flags = np.zeros(n_rows * n_features, bool)
    flags[pair] = True
    return np.flatnonzero(flags)


def _spans(word: np.ndarray, passage: np.ndarray):
    """Whole passages, about ``CHUNK`` words: (words, their passage counted from the first)."""
    at = 0
    while at < len(word):
        to = min(len(word), at + CHUNK)
        to = int(np.searchsorted(passage, passage[to - 1], "right"))
        yield word[at:to], passage[at:to] - passage[at]
        at = to


def passage_counts(coded: DataFrame, n_features: int, kind: str) -> tuple[np.ndarray, int]:
    """Per feature, the passages that hold it; the number of passages."""
    def run(batches):
        count = np.zeros(n_features + 1, "int64")
        for b in batches:
            word, passage, n = _flat(b, kind)
            count[-1] += n
            for w, p in _spans(word, passage):
                count[:-1] += np.bincount(_once(p, w, int(p[-1]) + 1, n_features) % n_features, minlength=n_features)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["f", "n"])

    out = np.zeros(n_features + 1, "int64")
    for r in coded.select("seq").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        out[r.f] = r.n  # one row per feature: bounded by the block of items
    return out[:-1], int(out[-1])


def sketch(coded: DataFrame, idf: np.ndarray, seen: np.ndarray, kind: str) -> np.ndarray:
    """A'A times a random matrix, A being the TF-IDF passages of all texts."""
    width = RANK + OVERSAMPLE
    random = np.random.default_rng(SEED).standard_normal((len(idf), width)).astype("float32")
    weight = idf.astype("float32")
    start = random * weight[:, None]
    rows = _Rows(seen)

    def run(batches):
        total = np.zeros(start.shape, "float64")
        for b in batches:
            word, passage, _ = _flat(b, kind)
            for w, p in _spans(word, passage):
                parts = rows.split(w, p, int(p[-1]) + 1)
                y = rows.sums(parts, start)
                counts, w, p = parts
                total[rows.top] += counts.T @ y
                if len(w):
                    order = np.argsort(w, kind="stable")
                    ws = w[order]
                    heads = np.flatnonzero(np.r_[True, ws[1:] != ws[:-1]])
                    total[ws[heads]] += np.add.reduceat(y[p[order]], heads, axis=0)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some)] + [pa.array(total[some, k]) for k in range(width)],
            names=["f", *[f"c{k}" for k in range(width)]])

    cols = [f"c{k}" for k in range(width)]
    parts = coded.select("seq").mapInArrow(run, "f long, " + ", ".join(f"{c} double" for c in cols))
    out = np.zeros(start.shape)
    for r in parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in cols]).collect():
        out[r.f] = r[1:]
    return out * weight[:, None]


def latent_space(z: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Orthonormal columns: the leading singular vectors of the corpus sketch and the items' own span."""
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    corpus = u[:, :RANK][:, s[:RANK] > 1e-9 * max(s[0], 1e-300)] if len(s) else u
    own = items.T / np.maximum(np.linalg.norm(items, axis=1), 1e-300)
    for _ in range(2):  # twice: what rounding leaves of the corpus part goes as well
        own = own - corpus @ (corpus.T @ own)
    u, s, _ = np.linalg.svd(own, full_matrices=False)
    return np.c_[corpus, u[:, s > 1e-7]]


def least_products(seqs: list[list[int]], idf: np.ndarray) -> np.ndarray:
    """Per item, the least product of its TF-IDF vector with a window that holds ``PARAPHRASE`` of its words: that of
    its lightest words."""
    return np.array([np.sort(idf[s] ** 2)[:math.ceil(PARAPHRASE * len(s) - 1e-9)].sum() for s in seqs])


class _Search:
    """The items in the latent space, and the least cosine that a leak can have there with each.

    A window's vector has at least the IDF weight of each of its words, and the space holds the items' span, so the
    projection leaves the product of window and item as it is: a window with a leak has at least ``least_products``,
    divided by both norms, as its cosine."""

    def __init__(self, space: np.ndarray, idf: np.ndarray, vectors: np.ndarray, seqs: list[list[int]], seen: np.ndarray):
        self.rows = _Rows(seen)
        self.table = (space * idf[:, None]).astype("float32")
        goals = vectors @ space
        norms = np.maximum(np.linalg.norm(goals, axis=1), 1e-300)
        self.goals = (goals / norms[:, None]).astype("float32")
        self.least = (least_products(seqs, idf) / norms).astype("float32")
        # so many blocks on each side of a window hold the words around it
        self.sides = np.array([max(1, -(-len(s) // STRIDE)) for s in seqs], "int64")

    def cosine(self, window: np.ndarray, item: int) -> float:
        x = self.table[window[window >= 0]].sum(axis=0)
        return float(x @ self.goals[item] / max(np.linalg.norm(x), 1e-9))


def _pieces(seqs: list[np.ndarray], margin: int):
    """(text, first and last block whose windows are searched, first and last block read) in groups of about ``CHUNK``
    words; a long text comes in several pieces."""
    step, group, words = max(1, CHUNK // STRIDE), [], 0
    for k, x in enumerate(seqs):
        n = -(-len(x) // STRIDE)
        for a in range(0, n, step):
            b = min(n, a + step)
            lo, hi = max(0, a - margin), min(n, b + margin)
            size = min(len(x), hi * STRIDE) - lo * STRIDE
            if group and words + size > CHUNK:
                yield group
                group, words = [], 0
            group.append((k, a, b, lo, hi))
            words += size
    if group:
        yield group


def candidates(seqs: list[np.ndarray], search: _Search):
    """(text, window start, item) wherever the cosine of the text around a window and an item in the latent space is
    not below what a leak must have. Frequent features count once in all the blocks around, the others once a block.
    Texts are laid end to end, each from a new block of ``STRIDE`` words, and taken about ``CHUNK`` words at a time."""
    rows, table = search.rows, search.table
    margin = int(search.sides.max()) + 1
    for pieces in _pieces(seqs, margin):
        flat = [seqs[k][lo * STRIDE:hi * STRIDE] for k, _, _, lo, hi in pieces]
        size = np.array([len(x) for x in flat], "int64")
        n_blocks = -(-size // STRIDE)
        # ``margin`` empty blocks before each piece and after the last: what is around a window is a run of blocks
        first = margin + np.r_[0, np.cumsum(n_blocks + margin)]
        n = int(first[-1])
        flat = np.concatenate(flat)
        start = np.cumsum(size) - size
        block = np.repeat(first[:-1], size) + (np.arange(len(flat)) - np.repeat(start, size)) // STRIDE
        used = flat >= 0
        once = _once(block[used], flat[used], n, len(table))
        counts, word, block = rows.split(once % len(table), once // len(table), n)
        rare = np.zeros((n, table.shape[1]), "float32")
        if len(word):
            head = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            rare[block[head]] = np.add.reduceat(table[word], head, axis=0)
        # a window is a block and the next one; a text's last block is a window only if it is the only one
        text, a, b, lo, _ = np.array(pieces).T
        total = -(-np.array([len(seqs[k]) for k in text]) // STRIDE)
        piece = np.repeat(np.arange(len(pieces)), n_blocks)
        near = np.arange(len(piece)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        own = near + lo[piece]
        wanted = (own >= a[piece]) & (own < b[piece]) & ((total[piece] == 1) | (own < total[piece] - 1))
        win, piece, own = (near + first[piece])[wanted], piece[wanted], own[wanted]
        counts, rare = np.maximum(counts[:-1], counts[1:]), rare[:-1] + rare[1:]
        for side in np.unique(search.sides).tolist():
            group = np.flatnonzero(search.sides == side)
            # blocks from ``side`` before a window's first to ``side`` after its second, as pairs
            m = n - 2 * side - 1
            held, more = counts[:m].copy(), rare[:m].copy()
            for k in range(2, 2 * side + 1, 2):
                np.maximum(held, counts[k:k + m], out=held)
                more += rare[k:k + m]
            held, more = held[win - side], more[win - side]
            x = held @ table[rows.top] + more
            norm = np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None]
            cosine = x @ search.goals[group].T / norm
            hit, item = np.nonzero(cosine >= search.least[group] / norm - SLACK)
            yield from zip(text[piece[hit]].tolist(), (own[hit] * STRIDE).tolist(), group[item].tolist())


def _block_leaks(docs: DataFrame, items: _Items) -> DataFrame:
    number = items.number
    kind = "<i2" if len(number) < 1 << 15 else "<i4"
    coded = staged(encode(docs, number), "coded")
    seen, passages = passage_counts(coded, len(number), kind)
    idf = np.log((1 + passages) / (1 + seen)) + 1e-6
    vectors = items.vectors(idf)
    space = latent_space(sketch(coded, idf, seen, kind), vectors)
    ids, seqs, answers = items.ids, items.seqs, items.answers
    search = _Search(space, idf, vectors, seqs, seen)
    schema = coded.select("doc_id", "mark").schema.add("item_id", "long").add("cosine", "double").add(
        "lcs_share", "double").add("has_answer", "boolean").add("word", "long")

    def run(batches):
        for b in batches:
            texts = [np.frombuffer(x.as_py(), kind) for x in b.column("seq")]
            best: dict[tuple[int, int], tuple] = {}
            for k, at, i in candidates(texts, search):
                item = seqs[i]
                reach = max(STRIDE, len(item))
                text = texts[k][max(0, at - reach):at + PASSAGE + reach].tolist()
                there = set(text)
                if sum(w in there for w in item) < PARAPHRASE * len(item):
                    continue
                share = common_subsequence(item, text) / len(item)
                answer = share >= PARAPHRASE and _holds(answers[i], text)
                if share >= NEAR_VERBATIM or answer:
                    cos = search.cosine(texts[k][at:at + PASSAGE], i)
                    if (k, i) not in best or (share, cos) > best[k, i][:2]:
                        best[k, i] = (share, cos, answer, at)
            out = [(k, ids[i], cos, share, answer, at) for (k, i), (share, cos, answer, at) in best.items()]
            if out:
                row, item, cos, share, answer, at = zip(*out)
                took = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(took), b.column("mark").take(took), pa.array(item, pa.int64()),
                     pa.array(cos, pa.float64()), pa.array(share, pa.float64()), pa.array(answer, pa.bool_()),
                     pa.array(at, pa.int64())], names=[f.name for f in schema])

    return coded.mapInArrow(run, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """``doc_id, mark (hash of the text), item_id, cosine, lcs_share, has_answer, word`` of every leak."""
    rows = benchmark.select("item_id", "text", (F.col(answer) if answer else F.lit(None)).cast("string").alias("a"))
    found, block = None, []

    def add(block):
        part = _block_leaks(docs, _Items(block))
        return part if found is None else found.unionByName(part)

    for r in rows.where("text is not null").toLocalIterator():
        if words_of(r.text):
            block.append(tuple(r))
        if len(block) == BLOCK_ITEMS:
            found, block = add(block), []
    if block:
        found = add(block)
    if found is None:
        found = docs.sparkSession.createDataFrame([], docs.select("doc_id").schema.add("mark", "long").add(
            "item_id", "long").add("cosine", "double").add("lcs_share", "double").add("has_answer", "boolean").add("word", "long"))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    mark, d, m = fresh(docs, "mark", "d", "m")
    hit = staged(leaks(docs, benchmark, answer).select(F.col("doc_id").alias(d), F.col("mark").alias(m)).distinct(), "leaks")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    same = (F.col(mark) == F.col(m)) & F.col("doc_id").eqNullSafe(F.col(d))
    return marked.join(hit, same, "left_anti").select(*docs.columns)
