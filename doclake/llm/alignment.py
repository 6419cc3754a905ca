"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over a corpus.

Both tokenizers cut one text. Byte offsets where tokens of both end cut it into
groups; every token of the one side is linked with every token of the other in
its group. A pair of ids counts the documents that hold it linked.

Counting is external. A task turns blocks of documents into pair-document
records (pair, document, times), radix-partitions them into ``CELLS`` cells and
writes each cell's records, sorted side-major (first id, second id, document),
as a run compressed with zstandard. A run's directory (pairs and their numbers
of documents) is apart from its records. Directories of a cell meet in a k-way
heap merge that adds up equal pairs; more than ``FAN_IN`` of them in rounds.
The order makes the pairs of a first id neighbours, so the merge yields its
highest count on the way. Then counts go back: a cell's merged directory is
read once before its runs, every run is streamed past it, and what each
document earns is added up per block.

Bounds: a block has ``BLOCK_RECORDS`` records (and its last document's), a run
is decompressed alone, a merge holds one frame per run and the cell's distinct
pairs, which the vocabularies bound; so are the highest counts per id (at most
one row each), all that is broadcast. A first id's pairs are spread over
``SPREAD`` cells, and a cell's runs over tasks by block, so that neither a very
common id nor copies of a document meet in one task.

Defined cases: a null or empty text, and one that a tokenizer doesn't give back
byte by byte, has no tokens (zeros, empty digest); every row is a document of
its own, repeated rows and null ids as well; special tokens' strings are plain
text; texts longer than ``CHUNK`` characters are tokenized in parts cut where a
space stands between ASCII letters, which no token of a byte-level or
prefix-space vocabulary crosses; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import bounded_batches, staged

CELLS = 64
SPREAD = 8
BLOCK_RECORDS = 1 << 21
BLOCK_DOCS = 1 << 16
ID_BITS = 20
FAN_IN = 64
RUNS_A_TASK = 1024
FRAME = 1 << 13
SLICE = 1 << 20
SLICE_BYTES = 2 << 20
CHUNK = 1 << 20
# Fixed value: where byte-level vocabularies of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_LOW = (1 << ID_BITS) - 1


def byte_level_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others
    follow from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Sides:
    """Two tokenizers: a byte-level one (its JSON) and a sentence-piece one (its model).

    The byte-level vocabulary numbers its entries in the order of their merges,
    so the ids are the ranks that tiktoken merges by (and does so faster).
    """

    def __init__(self, json_text: str, model: bytes):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_level_alphabet()
        file = json.loads(json_text)
        special = {t["id"]: t["content"] for t in file["added_tokens"]}
        entries = {i: bytes(alphabet[c] for c in entry) for entry, i in file["model"]["vocab"].items() if i not in special}
        self.a = tiktoken.Encoding("byte level", pat_str=PATTERN, special_tokens={},
                                   mergeable_ranks={entry: i for i, entry in entries.items()})
        a = [entries.get(i, special.get(i, "").encode()) for i in range(max([*entries, *special]) + 1)]
        b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
             else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        if max(len(a), len(b)) > 1 << ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a, b)]
        self.length = [np.array([len(t) for t in x]) for x in (a, b)]
        # an id as it is written in a digest, with what follows it
        self.written = pa.array([f"{i}{end}" for x, ends in ((a, ",|"), (b, (",", ";", ""))) for end in ends
                                 for i in range(len(x))], pa.large_string())
        self.place = [0, len(a), 2 * len(a), 2 * len(a) + len(b), 2 * len(a) + 2 * len(b)]

    def encode(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both sides' ids of every part; few parts at a time, since a library's own result is far larger."""
        a, b, at = [], [], 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end]) <= CHUNK):
                size += len(parts[end])
                end += 1
            some = parts[at:end]
            a += [np.array(self.a.encode_ordinary(" " + p), "int64") for p in some]
            b += [np.array(x, "int64") for x in self.b.encode(some, num_threads=1)]
            at = end
        return a, b


def parts_of(text: str) -> list[str]:
    """A text's parts; the spaces between them belong to what follows."""
    out, at = [], 0
    while len(text) - at > CHUNK:
        cut = _CUT.search(text, at + CHUNK)
        if not cut:
            break
        out.append(text[at:cut.start()])
        at = cut.start() + 1
    return [*out, text[at:]]


def _flat(ids: list[np.ndarray], owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), "int64", len(ids))
    flat = np.concatenate(ids) if ids else np.zeros(0, "int64")
    return flat, np.bincount(owner, size, n).astype("int64") if n else np.zeros(0, "int64")


def _starts(size: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(size)].astype("int64")


class Aligned:
    """Groups and links of a batch of texts."""

    def __init__(self, sides: Sides, texts: list[str]):
        parts = [parts_of(t) if t else [] for t in texts]
        owner = np.repeat(np.arange(len(texts)), list(map(len, parts)))
        ids = sides.encode([p for x in parts for p in x])
        n = len(texts)
        flat = [_flat(x, owner, n) for x in ids]
        good = np.array([bool(t) for t in texts], bool)
        for (x, size), table in zip(flat, sides.bytes):
            taken = table.take(pa.array(x))
            data = taken.buffers()[2]
            at = np.frombuffer(taken.buffers()[1], "int64")[taken.offset:taken.offset + len(x) + 1]
            begin = at[_starts(size)] if len(x) else np.zeros(n + 1, "int64")
            view = memoryview(data).cast("B") if data is not None else memoryview(b"")
            for i, t in enumerate(texts):
                if good[i]:
                    good[i] = view[begin[i]:begin[i + 1]] == b" " + t.encode()
        self.n = n
        self.ids, self.size, ends = [], [], []
        for (x, size), length in zip(flat, sides.length):
            kept = x[np.repeat(good, size)]
            self.ids.append(kept)
            self.size.append(np.where(good, size, 0))
            ends.append(np.cumsum(length[kept]))
        cuts = np.intersect1d(*ends, assume_unique=True)
        self.group = [np.searchsorted(cuts, e) for e in ends]
        self.per = [np.bincount(g, minlength=len(cuts)) for g in self.group]
        last = _starts(self.size[0])[1:]  # number of tokens up to each document's end
        text_end = np.where(last > 0, np.r_[0, ends[0]][last], 0)
        self.doc = np.searchsorted(text_end, cuts) if len(cuts) else cuts
        self.groups = np.bincount(self.doc, minlength=n)
        self.links = np.zeros(n, "int64")
        np.add.at(self.links, self.doc, self.per[0] * self.per[1])

    def digests(self, sides: Sides) -> list[str]:
        (a, b), (ga, gb) = self.ids, self.group
        sa, sb = _starts(self.per[0]), _starts(self.per[1])
        codes = np.empty(len(a) + len(b), "int64")
        last_a = np.r_[ga[1:] != ga[:-1], True] if len(a) else np.zeros(0, bool)
        last_b = np.r_[gb[1:] != gb[:-1], True] if len(b) else np.zeros(0, bool)
        final = np.r_[self.doc[1:] != self.doc[:-1], True] if len(self.doc) else np.zeros(0, bool)
        codes[np.arange(len(a)) + sb[ga]] = a + np.where(last_a, sides.place[1], sides.place[0])
        codes[np.arange(len(b)) + sa[gb + 1]] = b + np.where(
            last_b, np.where(final[gb], sides.place[4], sides.place[3]), sides.place[2])
        text = sides.written.take(pa.array(codes))
        size = self.size[0] + self.size[1]
        at = np.frombuffer(text.buffers()[1], "int64")[text.offset:text.offset + len(codes) + 1]
        begin = at[_starts(size)] if len(codes) else np.zeros(self.n + 1, "int64")
        view = memoryview(text.buffers()[2]) if len(codes) else memoryview(b"")
        return [hashlib.sha256(view[begin[i]:begin[i + 1]]).hexdigest() if size[i] else "" for i in range(self.n)]

    def records(self) -> tuple[np.ndarray, np.ndarray]:
        """(document << 2 * ID_BITS | pair, times linked), each once, sorted."""
        (a, b), (na, nb) = self.ids, self.per
        sa, sb = _starts(na), _starts(nb)
        volume = _starts(na * nb)
        parts, g = [], 0
        while g < len(na):
            if na[g] * nb[g] > SLICE:  # a very long group: by its distinct ids
                (ua, ca), (ub, cb) = (np.unique(x[s[g]:s[g + 1]], return_counts=True) for x, s in ((a, sa), (b, sb)))
                for i, c in zip(ua, ca):
                    parts.append(((self.doc[g] << 2 * ID_BITS) + (i << ID_BITS) + ub, c * cb))
                g += 1
                continue
            big = np.flatnonzero(na[g:] * nb[g:] > SLICE)[:1]
            end = min(int(np.searchsorted(volume, volume[g] + SLICE, "right")) - 1, g + int(big[0]) if len(big) else len(na))
            end = max(end, g + 1)
            i = np.arange(sa[g], sa[end])
            owner = self.group[0][i]
            times = nb[owner]
            first = np.repeat(i, times)
            second = np.arange(len(first)) - np.repeat(_starts(times)[:-1], times) + np.repeat(sb[owner], times)
            key = (np.repeat(self.doc[owner], times) << 2 * ID_BITS) + (a[first] << ID_BITS) + b[second]
            parts.append(np.unique(key, return_counts=True))
            g = end
        return _added(parts)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sum of their values."""
    if not parts:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    if len(parts) == 1:
        return parts[0]
    keys, values = np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values[order], first)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of non-negative integers as one zstandard frame: narrowest type, byte planes apart."""
    out = [len(columns).to_bytes(1, "little")]
    for c in columns:
        width = max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1
        planes = c.astype("<u8").view("u1").reshape(-1, 8).T[:width]
        out += [len(c).to_bytes(8, "little"), width.to_bytes(1, "little"), np.ascontiguousarray(planes).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(frame: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    out, at = [], 1
    for _ in range(data[0]):
        n, width = int.from_bytes(data[at:at + 8], "little"), data[at + 8]
        wide = np.zeros((n, 8), "u1")
        wide[:, :width] = np.frombuffer(data, "u1", n * width, at + 9).reshape(width, n).T
        out.append(wide.reshape(-1).view("<u8").astype("int64"))
        at += 9 + n * width
    return out


def directory(pairs: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A sorted run of (pair, count) in frames of ``FRAME`` pairs."""
    return [pack(np.diff(pairs[i:i + FRAME], prepend=0), counts[i:i + FRAME]) for i in range(0, len(pairs), FRAME)]


def _frame(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(data)
    return np.cumsum(steps), counts


def merged(runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """k-way merge of sorted runs that adds up equal pairs; one frame of each run is open.

    The heap holds the last pair of every open frame. Up to the smallest of
    them all frames are known, so that much of each is added up and put out.
    """
    todo = [iter(r) for r in runs if r]
    frames = {i: _frame(next(r)) for i, r in enumerate(todo)}
    heap = [(f[0][-1], i) for i, f in frames.items()]
    heapq.heapify(heap)
    out = []
    while heap:
        fence, i = heapq.heappop(heap)
        ready = []
        for j, (pairs, counts) in list(frames.items()):
            if pairs[0] <= fence:
                k = np.searchsorted(pairs, fence, "right")
                ready.append((pairs[:k], counts[:k]))
                if k < len(pairs):
                    frames[j] = (pairs[k:], counts[k:])
                else:  # its turn on the heap, now or next, opens its following frame
                    del frames[j]
        out.append(_added(ready))
        following = next(todo[i], None)
        if following is not None:
            frames[i] = _frame(following)
            heapq.heappush(heap, (frames[i][0][-1], i))
    pairs = np.concatenate([k for k, _ in out]) if out else np.zeros(0, "int64")
    counts = np.concatenate([c for _, c in out]) if out else np.zeros(0, "int64")
    return pairs, counts


def cell_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * 2654435761 >> 11) + b % SPREAD) % CELLS


def aligned_blocks(docs: DataFrame, json_text: str, model: bytes) -> DataFrame:
    """Per document its numbers (``kind`` 0) and per block and cell a run (``kind`` 1), by one pass over the texts.

    ``block, slot`` is the document's place or the run's cell.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select("doc_id", F.col("text").cast("string").alias("t"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = (f"kind int, block long, slot int, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, directory array<binary>, records binary")
    shared = docs.sparkSession.sparkContext.broadcast((json_text, model))  # two vocabulary files
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        sides = Sides(*shared.value)
        base, block, placed, held, size = TaskContext.get().partitionId() << 24, 0, 0, [], 0

        def flush():
            nonlocal block, placed, held, size
            yield from _runs(held, base + block, arrow)
            block, placed, held, size = block + 1, 0, [], 0

        for b in (small for x in batches for small in _slices(x)):
            if placed + b.num_rows > BLOCK_DOCS:
                yield from flush()
            done = Aligned(sides, b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                _filled(arrow, b.num_rows, kind=pa.array([0] * b.num_rows, pa.int32()),
                        block=pa.array([base + block] * b.num_rows, pa.int64()),
                        slot=pa.array(range(placed, placed + b.num_rows), pa.int32()), doc_id=b.column("doc_id"),
                        n_a=pa.array(done.size[0]), n_b=pa.array(done.size[1]), n_groups=pa.array(done.groups),
                        n_links=pa.array(done.links), groups_sha256=pa.array(done.digests(sides))), schema=arrow)
            keys, times = done.records()
            held.append((keys + (placed << 2 * ID_BITS), times))
            placed, size = placed + b.num_rows, size + len(keys)
            if size >= BLOCK_RECORDS:
                yield from flush()
        yield from flush()

    return src.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch):
    """The batch in slices of at most ``SLICE_BYTES`` of text (or one text) and ``BLOCK_DOCS`` rows."""
    size = pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy()
    at = 0
    while at < batch.num_rows:
        n = int(np.searchsorted(np.cumsum(size[at:at + BLOCK_DOCS]), SLICE_BYTES, "right"))
        yield batch.slice(at, max(1, n))
        at += max(1, n)


def _filled(schema: pa.Schema, n: int, **columns) -> list[pa.Array]:
    return [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]


def _runs(held: list[tuple[np.ndarray, np.ndarray]], block: int, schema: pa.Schema):
    """A block's records, dealt to cells and sorted side-major there: one run per cell."""
    keys = np.concatenate([k for k, _ in held]) if held else np.zeros(0, "int64")
    if not len(keys):
        return
    times = np.concatenate([t for _, t in held])
    doc, pair = keys >> 2 * ID_BITS, keys & (1 << 2 * ID_BITS) - 1
    cell = cell_of(pair >> ID_BITS, pair & _LOW)
    order = np.argsort(cell << 56 | pair << 16 | doc)  # documents of a block have 16 bits
    cell, pair, doc, times = cell[order], pair[order], doc[order], times[order]
    for c in np.unique(cell):
        s, e = np.searchsorted(cell, [c, c + 1])
        pairs, counts = np.unique(pair[s:e], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            _filled(schema, 1, kind=pa.array([1], pa.int32()), block=pa.array([block], pa.int64()),
                    slot=pa.array([c], pa.int32()), directory=pa.array([directory(pairs, counts)], pa.list_(pa.binary())),
                    records=pa.array([pack(doc[s:e], times[s:e])], pa.binary())), schema=schema)


def pair_counts(runs: DataFrame) -> DataFrame:
    """``slot, directory, side, top``: every cell's pairs with their numbers of documents, and per first id the highest.

    Directories meet ``FAN_IN`` at a time (on average), in as many rounds as that takes.
    """
    rows = runs.select("slot", "block", "directory")
    groups = rows.agg(F.count_distinct("block")).first()[0]
    while True:
        groups = -(-groups // FAN_IN)
        last = groups <= 1
        dealt = rows.select("slot", F.pmod(F.xxhash64("block"), F.lit(max(1, groups))).alias("block"), "directory").repartition(
            "slot", "block").sortWithinPartitions("slot", "block")
        rows = staged(dealt.mapInArrow(_merger(last), "slot int, block long, directory array<binary>, side array<int>, "
                                                      "top array<long>"), "counts")
        if last:
            return rows.select("slot", "directory", "side", "top")
        rows = rows.select("slot", "block", "directory")


def _merger(last: bool):
    def put(at, runs):
        pairs, counts = merged(runs)
        side, top = np.zeros(0, "int64"), np.zeros(0, "int64")
        if last:  # a first id's pairs are neighbours
            first = np.flatnonzero(np.r_[True, np.diff(pairs >> ID_BITS) > 0]) if len(pairs) else side
            side, top = pairs[first] >> ID_BITS, np.maximum.reduceat(counts, first) if len(first) else top
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()),
             pa.array([directory(pairs, counts)], pa.list_(pa.binary())), pa.array([side], pa.list_(pa.int32())),
             pa.array([top], pa.list_(pa.int64()))], names=["slot", "block", "directory", "side", "top"])

    def run(batches):
        at, runs = None, []
        for b in batches:
            for slot, block, frames in zip(b.column("slot").to_pylist(), b.column("block").to_pylist(), b.column("directory")):
                if (slot, block) != at:
                    if runs:
                        yield put(at, runs)
                    at, runs = (slot, block), []
                runs.append(frames.as_py())
                if len(runs) >= 2 * FAN_IN:  # more than expected met here: merge what there is
                    runs = [directory(*merged(runs))]
        if runs:
            yield put(at, runs)

    return run


def highest_counts(counts: DataFrame, vocabulary: int) -> np.ndarray:
    """Per first id its highest count (0: never linked); at most one row per id of the vocabulary comes back."""
    rows = counts.select(F.explode(F.arrays_zip("side", "top")).alias("x")).groupBy(F.col("x.side").alias("side")).agg(
        F.max("x.top").alias("top")).toArrow()
    out = np.zeros(vocabulary, "int64")
    out[rows["side"].to_numpy()] = rows["top"].to_numpy()
    return out


def earned(runs: DataFrame, counts: DataFrame, top: np.ndarray) -> DataFrame:
    """``block, sums``: what the documents of a block earn in one run (place, links of the highest count, counts)."""
    n = runs.agg(F.count_distinct("block")).first()[0]
    tasks = max(1, -(-n // RUNS_A_TASK))  # a cell's runs are spread over so many tasks, each reads its counts once
    known = counts.select(F.lit(0).alias("kind"), "slot", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("share"),
                          F.lit(None).cast("long").alias("block"), "directory", F.lit(None).cast("binary").alias("records"))
    theirs = runs.select(F.lit(1).alias("kind"), "slot", F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int").alias("share"),
                         "block", "directory", "records")
    dealt = known.unionByName(theirs).repartition("slot", "share").sortWithinPartitions("slot", "share", "kind")
    shared = runs.sparkSession.sparkContext.broadcast(top)  # one number per id of a vocabulary

    def run(batches):
        top = shared.value
        pairs = best = total = None
        for b in batches:
            for kind, block, frames, records in zip(b.column("kind").to_pylist(), b.column("block").to_pylist(),
                                                    b.column("directory"), b.column("records")):
                opened = [_frame(f) for f in frames.as_py()]
                mine = np.concatenate([p for p, _ in opened])
                number = np.concatenate([c for _, c in opened])
                if kind == 0:
                    pairs, total = mine, number
                    best = total == top[pairs >> ID_BITS]
                    continue
                at = np.repeat(np.searchsorted(pairs, mine), number)
                doc, times = unpack(records.as_py())
                sums = np.zeros((2, int(doc.max()) + 1), "int64")
                np.add.at(sums[0], doc, times * best[at])
                np.add.at(sums[1], doc, times * total[at])
                there = np.flatnonzero(sums[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([pack(there, sums[0][there], sums[1][there])], pa.binary())],
                    names=["block", "sums"])

    return dealt.mapInArrow(run, "block long, sums binary")


def aligned_documents(docs: DataFrame, json_path: str, model_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    with open(json_path, encoding="utf-8") as f:
        json_text = f.read()
    with open(model_path, "rb") as f:
        model = f.read()
    blocks = staged(aligned_blocks(docs, json_text, model), "blocks")
    runs = blocks.where("kind = 1").select("slot", "block", "directory", "records")
    counts = pair_counts(runs)
    sums = earned(runs, counts, highest_counts(counts, 1 << ID_BITS))
    own = blocks.where("kind = 0").drop("kind", "directory", "records")
    earnings = sums.select("block", F.lit(-1).alias("slot"), "sums")
    both = own.withColumn("sums", F.lit(None).cast("binary")).unionByName(earnings, allowMissingColumns=True)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    out = own.select(*names).schema.add("n_best", "long").add("count_sum", "long").add("groups_sha256", "string")

    def run(batches):
        at, best, total = None, np.zeros(BLOCK_DOCS, "int64"), np.zeros(BLOCK_DOCS, "int64")
        for b in batches:
            block, slot = b.column("block").to_pylist(), b.column("slot").to_numpy()
            found = []
            for i, x in enumerate(block):
                if x != at:
                    at = x
                    best, total = np.zeros(BLOCK_DOCS, "int64"), np.zeros(BLOCK_DOCS, "int64")
                if slot[i] < 0:
                    doc, n, c = unpack(b.column("sums")[i].as_py())
                    best[doc] += n
                    total[doc] += c
                else:
                    found.append((best[slot[i]], total[slot[i]]))
            rows = b.filter(pa.array(slot >= 0))
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in names]
                + [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)] + [rows.column("groups_sha256")],
                names=[f.name for f in out])

    return both.repartition("block").sortWithinPartitions("block", "slot").mapInArrow(run, out)
