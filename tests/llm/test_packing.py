import base64
import random

import numpy as np
import pytest

from doclake.llm import packing

from llm_helpers import clash, docs  # noqa: F401

PATTERN = r" ?[a-z]+|\s+|[^a-z\s]+"
END = 300


@pytest.fixture
def ranks(tmp_path):
    """The 256 bytes and a few merges."""
    rows = [bytes([i]) for i in range(256)] + [b"th", b"the", b" t", b" the", b"an", b"and"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % i for i, w in enumerate(rows)))
    return str(path)


def slow_fit(lengths, size):
    rows = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(size - sum(lengths[j] for j in r), k) for k, r in enumerate(rows)
                if sum(lengths[j] for j in r) + lengths[i] <= size]
        if fits:
            rows[min(fits)[1]].append(i)
        else:
            rows.append([i])
    return rows


def test_best_fit_against_brute_force():
    rng = random.Random(0)
    for size in (1, 2, 7, 16, 100):
        for n in (0, 1, 5, 120):
            lengths = [rng.randint(1, size) for _ in range(n)]
            got = packing.best_fit_decreasing(lengths, size)
            want = slow_fit(lengths, size)
            assert sorted(i for r in got for i in r) == list(range(n))
            # equal rooms are interchangeable: the rows' loads are what best fit decides
            assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in want)


def test_rows_give_back_every_token(docs, ranks, spark, tmp_path):
    rng = random.Random(1)
    texts = [None, "", "the and the", "é\n\n the" * 5, "the " * 3000] + [
        "".join(rng.choice(["the", " the", "and", "x", " ", "9"]) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "the")]
    packed = packing.pack(clash(docs(rows), "ids", "n_tokens"), ranks, PATTERN, END, row_tokens=64, block_tokens=1500)
    packing.write_packed(packed, str(tmp_path / "p"))
    got = spark.read.parquet(str(tmp_path / "p")).collect()
    with open(ranks, "rb") as f:
        enc = packing.bpe(f.read(), PATTERN)
    found = {}
    m = packing.matrix(got, 64)
    for r, ids in zip(got, m):
        pos = np.frombuffer(r.positions, "<u2")
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64 and r.n_segments == len(r.doc_ids)
        assert (ids[r.n_tokens:] == END).all()
        for k in range(r.n_segments):
            a, b = r.cu_seqlens[k:k + 2]
            assert pos[a:b].tolist() == list(range(b - a))
            found.setdefault((r.doc_ids[k], r.n_pieces[k]), []).append((r.piece_nos[k], ids[a:b].tolist()))
    for d, text in rows:
        want = enc.encode_ordinary(text or "") + [END]
        n = -(-len(want) // 64)
        pieces = sorted(found[d, n])
        copies = sum(x == d for x, _ in rows)
        assert [p[0] for p in pieces] == sorted(list(range(n)) * copies)
        assert [t for p in pieces[::copies] for t in p[1]] == want
    assert len({r.packed_row for r in got}) == len(got)
    full = sum(r.n_tokens for r in got) / (64 * len(got))
    assert full > 0.9


def test_wide_ids_and_empty(docs, ranks):
    wide = packing.pack(docs([(1, "the")]), ranks, PATTERN, 70000, row_tokens=8).collect()
    assert packing.matrix(wide, 8).tolist() == [[257, 70000, *[70000] * 6]]
    assert packing.pack(docs([]), ranks, PATTERN, END).collect() == []
