"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: 64 bits over the word shingles of the whole text, each bit set
if it is set in more than half of the shingles' XXH64 values.

Links: distinct fingerprints are dealt to buckets by exactly shared bits (two
fingerprints that differ in at most 3 bits agree on one of four 16-bit blocks,
and of the 48 bits left on one of four 12-bit blocks: 16 buckets per
fingerprint, none missed). A bucket is sorted by Gray rank; runs of
neighbours form the nodes of a hierarchical index, which keep the bits that
all their members share (mask and pattern). Two nodes are compared from the
top: the differences on bits that both masks fix add up along the way down, a
pair of nodes over the limit is dropped with all its members, and a pair that
cannot exceed it is linked as a whole. Buckets return a spanning forest of
their links, never all pairs; the forests' union has the same components as
all links.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; fewer words than a shingle
make one shingle; rows with equal texts share a fingerprint; a null doc_id is
linked but never names a group unless the group has no other; an empty table
gives no rows; extra columns are ignored by the fingerprint table and kept by
``drop_near_copies``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, staged
from .components import components

SEED = 42
CHUNK_SHINGLES = 1 << 16
FANOUT = 16
FRONTIER = 1 << 20


# -- fingerprints -------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of one UTF-8 text (ASCII letters lower-cased)."""
    import xxhash

    words = text.lower().split()  # bytes: lower() touches A-Z, split() the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), "int64", len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = max(1, len(words) - shingle + 1)
    last = end[shingle - 1:] if len(words) >= shingle else end[-1:]
    del words
    ones = np.zeros(64, "int64")
    h = xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK_SHINGLES):
        part = slice(k, min(n, k + CHUNK_SHINGLES))
        hashes = np.fromiter((h(line[s:e], SEED) for s, e in zip(start[part].tolist(), last[part].tolist())),
                             "uint64", part.stop - part.start)
        bits = np.unpackbits(hashes.view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="int64")
    set_bits = np.packbits(2 * ones > n, bitorder="little")
    return int(set_bits.view("uint64")[0])


def with_fingerprints(df: DataFrame, text: str = "text", shingle: int = 3,
                      keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint as a signed long)."""
    bounded_batches(df.sparkSession)
    src = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("__t"))
    schema = src.drop("__t").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column("__t")), "uint64", b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(fps.view("int64"))], names=[*keep, "fp"])

    return src.mapInArrow(run, schema)


# -- the index of one bucket --------------------------------------------------

def gray_rank(g):
    """Rank of a code word in Gray order (numpy uint64)."""
    b = g.copy()
    for s in (1, 2, 4, 8, 16, 32):
        b ^= b >> np.uint64(s)
    return b


def _levels(fps: np.ndarray) -> list[tuple]:
    """(mask, pattern, lo, hi) of the nodes, leaves first; a mask has the bits all members share."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    at = np.arange(len(fps), dtype="int64")
    out = [(np.full(len(fps), full), fps, at, at + 1)]
    while len(out[-1][0]) > 1:
        mask, pattern, lo, hi = out[-1]
        first = np.arange(0, len(mask), FANOUT)
        hi_bits = np.bitwise_or.reduceat(pattern | ~mask, first)
        lo_bits = np.bitwise_and.reduceat(pattern & mask, first)
        shared = ~(hi_bits ^ lo_bits)
        last = np.minimum(first + FANOUT, len(mask)) - 1
        out.append((shared, lo_bits & shared, lo[first], hi[last]))
    return out


class _Sets:
    """Union by repeated minimum over index arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n, dtype="int64")

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def bucket_roots(fps: np.ndarray, bits: int) -> np.ndarray:
    """Component (smallest index) of each distinct fingerprint of a bucket sorted by Gray rank."""
    sets = _Sets(len(fps))
    levels = _levels(fps)
    one = np.zeros(1, "int64")
    # (level, a, b, differences so far, bits that both ancestors fixed)
    stack = [(len(levels) - 1, one, one, one.astype("int64"), np.zeros(1, "uint64"))]
    while stack:
        lvl, a, b, diff, fixed = stack.pop()
        mask, pattern, lo, hi = levels[lvl]
        common = mask[a] & mask[b]
        diff = diff + np.bitwise_count((pattern[a] ^ pattern[b]) & common & ~fixed).astype("int64")
        near = diff <= bits
        a, b, diff, common = a[near], b[near], diff[near], common[near]
        if lvl == 0:
            sets.link(a, b)
            continue
        whole = diff + 64 - np.bitwise_count(common).astype("int64") <= bits
        for x, y in zip(a[whole].tolist(), b[whole].tolist()):
            rest = np.r_[lo[x]:hi[x], lo[y]:hi[y]]
            sets.link(np.full(len(rest), lo[x]), rest)
        a, b, diff, common = a[~whole], b[~whole], diff[~whole], common[~whole]
        # members already joined need no further comparison
        low, high = np.minimum.reduceat(sets.root, lo), np.maximum.reduceat(sets.root, lo)
        done = (low == high)[a] & (low == high)[b] & (low[a] == low[b])
        a, b, diff, common = a[~done], b[~done], diff[~done], common[~done]
        width = len(levels[lvl - 1][0])
        step = max(1, FRONTIER // (FANOUT * FANOUT))
        for k in range(0, len(a), step):
            pa_, pb_ = a[k:k + step], b[k:k + step]
            i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
            ca = (pa_[:, None] * FANOUT + i).ravel()
            cb = (pb_[:, None] * FANOUT + j).ravel()
            ok = (ca < width) & (cb < width) & (ca <= cb if lvl > 1 else ca < cb)
            rep = np.repeat(np.arange(len(pa_)), FANOUT * FANOUT)[ok]
            stack.append((lvl - 1, ca[ok], cb[ok], diff[k:k + step][rep], common[k:k + step][rep]))
    return sets.root


def _rotations(fp: str = "fp") -> list[str]:
    """The 16 bucket keys: block number, a 16-bit block, a 12-bit block of the remaining bits."""
    out = []
    for a in range(4):
        turned = f"((shiftleft({fp}, {16 * a}) | shiftrightunsigned({fp}, {64 - 16 * a})))" if a else fp
        for b in range(4):
            out.append(
                f"(shiftleft({4 * a + b}L, 28) | shiftleft(shiftrightunsigned({turned}, 48), 12)"
                f" | (shiftrightunsigned({turned}, {36 - 12 * b}) & 4095L))")
    return out


def fingerprint_links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """``fps(fp)`` distinct -> links ``(u, v)`` whose components are those of all pairs within ``bits``."""
    if not 0 <= bits <= 3:
        raise ValueError("the bucket keys cover a distance of up to 3 bits")
    spark = fps.sparkSession
    bounded_batches(spark)
    ranked = fps.select("fp", F.col("fp").alias("g"))
    for s in (1, 2, 4, 8, 16, 32):
        ranked = ranked.withColumn("g", F.expr(f"g ^ shiftrightunsigned(g, {s})"))
    keyed = ranked.select("fp", F.expr("g ^ (-9223372036854775807L - 1L)").alias("g"),
                          F.explode(F.array(*[F.expr(x) for x in _rotations()])).alias("key"))
    dealt = keyed.repartition("key").sortWithinPartitions("key", "g").select("key", "fp")

    def run(batches):
        key = np.empty(0, "int64")
        fp = np.empty(0, "uint64")

        def solve(key, fp):
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            lo = np.r_[0, cuts]
            hi = np.r_[cuts, len(key)]
            us, vs = [], []
            for l, h in zip(lo[hi - lo > 1].tolist(), hi[hi - lo > 1].tolist()):
                f = fp[l:h]
                root = bucket_roots(f, bits)
                away = root != np.arange(len(f))
                us.append(f[away])
                vs.append(f[root[away]])
            u = np.concatenate(us) if us else np.empty(0, "uint64")
            v = np.concatenate(vs) if vs else np.empty(0, "uint64")
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view("int64")), pa.array(v.view("int64"))], names=["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            key = np.r_[key, b.column("key").to_numpy()]
            fp = np.r_[fp, b.column("fp").to_numpy().view("uint64")]
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if cut:
                yield solve(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield solve(key, fp)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def _grouped(marked: DataFrame, bits: int) -> DataFrame:
    """``marked(..., fp)`` staged -> ``(fp, root)`` for every distinct fingerprint."""
    fps = marked.select("fp").distinct()
    comp = components(fingerprint_links(fps, bits))
    return fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_copy_groups(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id`` of every row."""
    marked = staged(with_fingerprints(docs, "text", shingle), "fingerprints")
    roots = staged(_grouped(marked, bits), "roots")
    # per fingerprint first: a group of copies is one row before the join
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = roots.join(names, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one row of every group: that of the smallest doc_id (null last), then the first row read."""
    rid, fpc = fresh(docs, "__rid", "__fp")
    kept = docs.columns
    rows = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "docs")
    marked = staged(with_fingerprints(rows, "text", shingle, (rid, "doc_id")), "fingerprints")
    roots = _grouped(marked, bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col(rid).alias("r"))).alias("first")
    per_fp = marked.groupBy("fp").agg(first).join(roots, "fp")
    chosen = (per_fp.groupBy("root").agg(F.min("first").alias("first"))
              .select(F.col("first.r").alias(rid)))
    return rows.join(chosen, rid, "left_semi").select(*kept)
