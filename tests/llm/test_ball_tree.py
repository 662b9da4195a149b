"""Ranked search against plain loops over all documents; bounds that are never too small; what the bounds skip."""

import math
import re

import numpy as np
import pytest

from planmatch.llm import ball_tree as B
from planmatch.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    words = [(i, WORD.findall((t or "").translate(LOW))) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df: dict = {}
    for _, w in words:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        own, scored = set(WORD.findall((text or "").translate(LOW))), []
        for doc, w in words:
            m = 100 - 90 + (90 * len(w) * n_docs) // n_terms if w else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * w.count(x)) // (1000 * w.count(x) + 8 * m)) for x in own if x in w)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def get(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


@pytest.mark.parametrize("leaf, items_a_batch", [(32, 4096), (2, 2)])
def test_against_all_documents(spark, monkeypatch, leaf, items_a_batch):
    prepare(spark)
    monkeypatch.setattr(B, "CHUNK_DOCS", 40)
    rng = np.random.default_rng(0)
    say = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.4, n) % 300)
    docs = [(i, say(int(rng.integers(1, 60)))) for i in range(150)]
    docs += [(i, docs[3][1]) for i in range(200, 260)]  # copies: ties by doc_id
    docs += [(None, None), (None, docs[3][1]), (None, docs[3][1]), (300, ""), (301, "  ,;-"), (302, "ÄÖ w1'W2 日本 é_x w1"), (303, say(20_000)), (7, say(5)), (7, "w1 w2")]
    items = [(1, docs[3][1]), (2, say(30)), (2, say(30)), (None, "w1 日本 É x"), (5, None), (6, ""), (7, "zzz unknown"), (8, "W1 w1 w1"), (9, docs[100][1])]
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score long, TEXT string").repartition(3)
    bench = spark.createDataFrame([(d, t, 1) for d, t in items], "item_id long, text string, rank long")
    assert get(B.search(table, bench, leaf_docs=leaf, batch_items=items_a_batch)) == brute(docs, items)
    if leaf == 2:
        assert B.search(table, bench.limit(0)).count() == 0 and B.search(table.limit(0), bench).count() == 0


def some_tree(rng, n, leaf=8, width=400, groups=1):
    size = rng.integers(1, 40, n)
    term = [np.sort(rng.choice(width // groups, s, replace=False)) + (i % groups) * (width // groups) for i, s in enumerate(np.minimum(size, width // groups))]
    ptr = np.concatenate([[0], np.cumsum([len(t) for t in term])])
    x = rng.integers(1, 10**6, ptr[-1])
    weight = rng.integers(0, 20_000, width)
    return B.BallTree.build(np.arange(n) * 3, ptr, np.concatenate(term).astype(np.int32), x, weight, leaf), weight


def test_bounds_hold_and_search_is_exact():
    rng = np.random.default_rng(4)
    for n in (1, 7, 8, 9, 100, 333):
        tree, weight = some_tree(rng, n)
        tree = B.BallTree.from_bytes(tree.to_bytes())
        for _ in range(5):
            own = np.sort(rng.choice(400, 25, replace=False)).astype(np.int32)
            dense = np.zeros(400, np.int64)
            dense[own] = weight[own]
            exact = [(int((dense[tree.term[a:z]] * tree.x[a:z]).sum()), int(i)) for i, a, z in zip(tree.ids, tree.ptr, tree.ptr[1:])]
            bound = tree.bounds(own, weight[own])
            for node in range(len(tree.lo)):
                if tree.hi[node] > tree.lo[node]:
                    assert bound[node] >= max(s for s, _ in exact[tree.lo[node] : tree.hi[node]])
            want = sorted(((s, i) for s, i in exact if s > 0), key=lambda p: (-p[0], p[1]))[:10]
            assert sorted(tree.search(own, weight[own], dense, 10)[0], key=lambda p: (-p[0], p[1])) == want
            # identical documents: the ball is a point, its bound the score
    same = B.BallTree.build(np.arange(4), np.arange(5) * 2, np.array([1, 5] * 4, np.int32), np.array([10, 999_999] * 4), np.ones(9, np.int64), 2)
    assert (same.radius < 2).all() and np.allclose(same.bounds(np.array([1, 5], np.int32), np.array([3, 7])), 30 + 7 * 999_999)


def test_bounds_skip_leaves():
    """Documents in groups with words of their own: most leaves are never scored."""
    rng = np.random.default_rng(5)
    tree, weight = some_tree(rng, 2_000, 16, 4_000, groups=20)
    scored = total = 0
    for g in range(20):
        own = np.sort(rng.choice(200, 25, replace=False) + g * 200).astype(np.int32)
        dense = np.zeros(4_000, np.int64)
        dense[own] = weight[own]
        scored += tree.search(own, weight[own], dense, 10)[1]
        total += 128
    assert scored < total / 5


def test_registered_query(spark):
    prepare(spark)
    rows = B.query(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").select(c, "text").collect()]
    assert get(rows) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
