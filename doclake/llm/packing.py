"""Token ids packed into rows of fixed length by best-fit-decreasing.

A task tokenizes its documents, ends each with the end token, splits documents
longer than a row into pieces of one row and a rest (no token is lost), and
packs blocks of at least ``block_tokens`` tokens: pieces in decreasing length
go to the open row with the least room that still fits. A segment tree over
the room values (0 to the row length) finds that room in log2(length) steps.
Blocks are independent, so nothing is shuffled, memory is bounded by a block
and the longest text, and a lost task repeats its own blocks alone.

A packed row holds the ids (little-endian, two bytes if all ids and the
padding fit, else four), the cumulative segment lengths, the positions (which
start again at 0 with each segment) and, per segment, the document, the number
of the piece in it and how many it has.

Defined cases: a null or empty text is the end token alone; equal lengths are
packed in the order they were read and equal rooms filled last opened first;
repeated rows and a null doc_id are packed like others; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

ROW_TOKENS = 2048
BLOCK_TOKENS = 1 << 21


class Rooms:
    """Open rows by the room they have left; a segment tree marks which rooms occur."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at and not self.tree[at]:
            self.tree[at] = 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the smallest room of at least ``least``."""
        tree, at = self.tree, least + self.leaves
        while not tree[at]:
            while at & 1:  # a right child: go up until a right neighbour exists
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            if not tree[at]:
                at += 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            tree[at] = 0
            at >>= 1
            while at and not (tree[2 * at] or tree[2 * at + 1]):
                tree[at] = 0
                at >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of indices into ``lengths`` (each at most ``size``)."""
    rooms, rows = Rooms(size), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            room, row = size, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            rooms.add(room - lengths[i], row)
    return rows


def bpe(ranks: bytes, pattern: str):
    """A tiktoken encoding of a rank file's content."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pack(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, pad_id: int | None = None,
         row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per packed row of ids; the vocabulary is read from ``ranks_path`` once, on the driver."""
    bounded_batches(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks = f.read()  # a vocabulary file: its size doesn't depend on the data
    pad = end_id if pad_id is None else pad_id
    wide = max(end_id, pad, len(ranks.splitlines())) >= 1 << 16
    id_type = "<u4" if wide else "<u2"
    at_type = "<u4" if row_tokens > 1 << 16 else "<u2"
    src = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = ("packed_row long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, positions binary, "
              "doc_ids array<long>, piece_nos array<int>, n_pieces array<int>")

    def run(batches):
        from pyspark import TaskContext

        enc = bpe(ranks, pattern)
        serial = TaskContext.get().partitionId() << 33
        pieces: list[tuple] = []
        held = 0

        def block():
            nonlocal serial
            rows = best_fit_decreasing([len(p[0]) for p in pieces], row_tokens)
            ids = np.full((len(rows), row_tokens), pad, id_type)
            pos = np.zeros((len(rows), row_tokens), at_type)
            step = np.arange(row_tokens, dtype=at_type)
            cuts = []
            for k, row in enumerate(rows):
                at, cu = 0, [0]
                for i in row:
                    n = len(pieces[i][0])
                    ids[k, at:at + n] = pieces[i][0]
                    pos[k, at:at + n] = step[:n]
                    at += n
                    cu.append(at)
                cuts.append(cu)
            columns = [
                pa.array(np.arange(serial, serial + len(rows), dtype="int64")),
                pa.array([c[-1] for c in cuts], pa.int32()), pa.array([len(r) for r in rows], pa.int32()),
                pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(cuts, pa.list_(pa.int32())),
                pa.array([x.tobytes() for x in pos], pa.binary())] + [
                pa.array([[pieces[i][j] for i in row] for row in rows], pa.list_(t))
                for j, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32()))]
            serial += len(rows)
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = np.append(enc.encode_to_numpy(text.as_py(), disallowed_special=()), end_id)
                n = -(-len(ids) // row_tokens)
                pieces.extend((ids[k * row_tokens:(k + 1) * row_tokens], doc, k, n) for k in range(n))
                held += len(ids)
                if held >= block_tokens:
                    yield block()
                    pieces, held = [], 0
        if pieces:
            yield block()

    return src.mapInArrow(run, schema)


def matrix(rows: list, row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """The id matrix of collected rows (read back from the written table)."""
    kind = "<u2" if rows and len(rows[0]["ids"]) == 2 * row_tokens else "<u4"
    return np.stack([np.frombuffer(r["ids"], kind) for r in rows]) if rows else np.empty((0, row_tokens), kind)


def write_packed(packed: DataFrame, path: str) -> None:
    packed.write.parquet(path)
