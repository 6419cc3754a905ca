import random

import numpy as np

from doclake.llm import decontaminate as dc


def setup(seed):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    word = lambda: rng.choice(common) if rng.random() < .5 else f"w{rng.randrange(400)}"
    bench = [(i, " ".join(word() for _ in range(rng.choice([1, 9, 18, 40, 70]))), None) for i in range(20)]
    bench.append((20, bench[3][1], None))  # an item that is there twice
    items = dc._Items(bench)
    texts = []
    for k in range(40):
        t = [word() for _ in range(rng.choice([0, 5, 33, 64, 300, 900]))]
        at = rng.randint(0, len(t))
        t[at:at] = rng.choice(bench)[1].split()
        texts.append(np.array([items.number.get(w, -1) for w in t], "<i2"))
    seen = np.bincount(np.concatenate([np.unique(x[x >= 0]) for x in texts]), minlength=len(items.number))
    idf = np.log((1 + len(texts)) / (1 + seen)) + 1e-6
    vectors = items.vectors(idf)
    z = np.random.default_rng(seed).standard_normal((len(idf), dc.RANK + dc.OVERSAMPLE))
    return items, texts, seen, idf, vectors, dc.latent_space(z, vectors)


def test_the_space_holds_every_item():
    _, _, _, _, vectors, space = setup(1)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-9)
    assert np.allclose(vectors @ space @ space.T, vectors, atol=1e-6)


def test_candidates_are_chosen_by_their_cosine(monkeypatch):
    items, texts, seen, idf, vectors, space = setup(2)
    monkeypatch.setattr(dc, "FREQUENT", len(idf))  # every word counts once around a window
    search = dc._Search(space, idf, vectors, items.seqs, seen)
    got = set(dc.candidates(texts, search))
    chosen = pairs = 0
    for k, x in enumerate(texts):
        for at in range(0, max(1, len(x) - dc.STRIDE), dc.STRIDE):
            for i, item in enumerate(items.seqs):
                reach = dc.STRIDE * max(1, -(-len(item) // dc.STRIDE))
                part = x[max(0, at - reach):at + dc.PASSAGE + reach]
                w = np.zeros(len(idf))
                w[part[part >= 0]] = idf[part[part >= 0]]
                near, goal = w @ space, vectors[i] @ space
                cosine = near @ goal / max(np.linalg.norm(near) * np.linalg.norm(goal), 1e-9)
                light = sorted(idf[w] ** 2 for w in item)[:-(-len(item) * 6 // 10)]
                least = sum(light) / max(np.linalg.norm(near) * np.linalg.norm(goal), 1e-9)
                if abs(cosine - least) > 3e-4:
                    assert ((k, at, i) in got) == (cosine > least)
                chosen, pairs = chosen + ((k, at, i) in got), pairs + 1
                there = set(part.tolist())
                if sum(w in there for w in item) >= dc.PARAPHRASE * len(item):
                    assert (k, at, i) in got
    assert 0 < chosen < .7 * pairs


def test_a_text_in_pieces_has_the_same_candidates(monkeypatch):
    items, texts, seen, idf, vectors, space = setup(3)
    search = dc._Search(space, idf, vectors, items.seqs, seen)
    whole = sorted(dc.candidates(texts, search))
    monkeypatch.setattr(dc, "CHUNK", 100)
    monkeypatch.setattr(dc, "FLAGS", 0)
    assert whole and sorted(dc.candidates(texts, search)) == whole
