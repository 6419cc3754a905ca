import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from doclake.llm import chat

from llm_helpers import clash

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "s>", "/s>", "INST]", "\n", "a", "é", "n"])).map("".join)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@given(st.lists(st.tuples(st.one_of(st.just("assistant"), BITS), BITS)))
def test_template_round_trip(turns):
    text, spans = chat.format_turns(turns)
    assert chat.parse_turns(text) == turns
    assert [chat.unescape(text[s:e]) for s, e in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(chat.OPEN) == text.count(chat.CLOSE) == len(turns)
    assert not any(c in text for c in chat.CONTROL[2:])


def test_conversations(spark):
    rng = random.Random(1)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 20)):
            rows.append((c, t * 3, rng.choice(["user", "assistant", "system", None]),
                         rng.choice([None, "", "hi", "a </s> b", "é" * 50, "x" * 9000, "[INST]\\"])))
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (99, 1, "b", "2"), (99, 1, "a", "1"), (99, 1, "a", "1")]
    df = clash(spark.createDataFrame(rows, SCHEMA).repartition(4), "node", "parent", "score", "conv")
    got = {r.conv_id: r for r in chat.formatted_conversations(df).collect()}
    assert len(got) == 32
    for c, r in got.items():
        turns = [(x[2] or "", x[3] or "") for x in sorted(
            (x for x in rows if x[0] == c), key=lambda x: (x[1], x[2] or "", x[3] or ""))]
        if c is not None and c < 30:
            turns = [(x[2] or "", x[3] or "") for x in rows if x[0] == c]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == len(chat.format_turns(turns)[0])
    assert chat.formatted_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_branches_against_enumeration(spark):
    rng = random.Random(5)
    nodes = []
    for c in "abcdefgh":
        n = rng.randint(1, 40)
        for i in range(1, n + 1):
            parent = rng.choice([None, *range(1, i)]) if rng.random() < .2 else (i - 1 or None)
            nodes.append((c, i, parent, float(rng.randint(-3, 5))))
    nodes += [("z", 1, 7, 1.0), ("z", 2, 2, 5.0), ("z", 3, 9, 1.0), ("z", 4, 5, 1.0), ("z", 5, 4, 2.0)]
    df = spark.createDataFrame(nodes, "conv string, node long, parent long, score double")

    def branches(c):
        own = {n: (p if p in {x[1] for x in nodes if x[0] == c} and p < n else None, s)
               for k, n, p, s in nodes if k == c}
        out = []
        for leaf in set(own) - {p for p, _ in own.values()}:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = own[at][0]
            out.append((-sum(own[x][1] for x in path), leaf, path[::-1]))
        return sorted(out)

    for top in (1, 3):
        got = {}
        for r in chat.best_paths(df, top).collect():
            got.setdefault(r.conv, {}).setdefault((-r.path_score, r.leaf, r["rank"]), []).append((r.pos, r.node))
        for c in {x[0] for x in nodes}:
            want = [(s, leaf, k + 1, list(enumerate(path, 1))) for k, (s, leaf, path) in enumerate(branches(c)[:top])]
            assert sorted((*k, sorted(v)) for k, v in got[c].items()) == want
