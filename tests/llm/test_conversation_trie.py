"""The trie against a plain dictionary of prefixes: long and hot conversations, cut stretches, nulls, ties, repeats."""

import hashlib
import zlib

import numpy as np
import pytest

from planmatch.llm import conversation_trie as T
from planmatch.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, node string, TEXT string"


def brute(rows, shared=True):
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(c, []).append(((turn is not None, turn or 0), d, (role, text)))
    own = {c: [t for _, _, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    head = lambda c: zlib.crc32(str(c).encode()) % 4 if shared else 0
    cut = lambda c: int(np.fmod(c, 20))
    built = {c: own.get(c - cut(c), [])[: head(c)] + v[head(c) :] for c, v in own.items()}
    nodes: dict = {}
    for c, p in built.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    kids: dict = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, cs in nodes.items():
        leaves = saved = 0
        todo = [p]
        while todo:
            q = todo.pop()
            todo += kids.get(q, [])
            leaves += q not in kids
            saved += (len(nodes[q]) - 1) * len([w for w in q[-1][1].translate({i: 32 for i in range(9, 14)}).split(" ") if w]) if q else 0
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(built[c]) == len(p)))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some(seed, convs, most):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-45, 400), convs, replace=False).tolist():
        for k in range(int(rng.integers(1, most))):
            rows.append((c, k, "user" if k % 2 == 0 else "assistant", f"t{rng.integers(0, 2 if k < 12 else 40)} \x0b w" * int(rng.integers(1, 3))))
    return rows


def get(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("stretch", [1 << 18, 5])
def test_against_prefixes(spark, stretch):
    prepare(spark)
    rows = some(1, 60, 20)
    rows += [(500, k, "user", f"long {k // 2}") for k in range(90)] + [(501, k, "user", f"long {k // 2}") for k in range(70)]  # over many stretches
    rows += [(c, k, "u", "copy") for c in range(520, 560) for k in range(3)]  # one frequent conversation
    rows += [(700, None, None, None), (700, None, "", "x"), (700, 3, "user", None), (700, 3, "user", None), (700, 3, "user", "a"), (None, 1, "user", "lost"), (721, 0, "user", "only"), (701, 2, "", "x")]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    assert get(T.prefix_trie(docs, T.Heads(), 4, stretch)) == brute(rows)
    if stretch == 5:
        assert get(T.prefix_trie(docs, None, 3, stretch)) == brute(rows, shared=False)


def test_empty_and_turnless(spark):
    prepare(spark)
    rows = spark.createDataFrame([(None, 1, "user", "x", "", "")], SCHEMA)
    assert T.prefix_trie(rows, T.Heads()).count() == 0
    one = [(c, 0, "user", "a b") for c in (21, 22, 23, 24, 25)]  # some lose their only turn, and 20 is not there
    assert get(T.prefix_trie(spark.createDataFrame([(*r, "", "") for r in one], SCHEMA), T.Heads())) == brute(one)


def test_summary_carries_on():
    rng = np.random.default_rng(2)
    digests, words = [int(x) for x in rng.integers(0, 1 << 62, 30)], rng.integers(0, 9, 30).tolist()
    head = [(5, 1), (6, 2), (7, 3)]
    for skip in range(4):
        plain = T.Path(skip, 4, head)
        for g, w in zip(digests, words):
            if plain.own(g, w):
                plain.take()
        for cut in (1, 3, 4, 9):
            path = T.Path(skip, 4, head)
            for a, z in ((0, cut), (cut, 30)):
                path.carry_on(T.summary(digests[a:z], words[a:z], 4, 4))
            assert vars(path) == vars(plain)


def test_ids_are_hashed_from_pieces(spark):
    prepare(spark)
    rows = spark.createDataFrame([(b"%d" % (c % 3), c) for c in range(-50, 1000)], "node binary, conv_id long").repartition(5)
    got = {bytes(r.node): r.sha for r in T.digest_of_ids(rows, 7).collect()}
    assert got == {b"%d" % k: hashlib.sha256(",".join(str(c) for c in range(-50, 1000) if b"%d" % (c % 3) == b"%d" % k).encode()).hexdigest() for k in {c % 3 for c in range(-50, 1000)}}
