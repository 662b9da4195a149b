"""Packing: ids of the plain library, whole coverage, all limits, padding, nulls, ties, repeats, long and empty texts."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from planmatch.llm import vector_packing as V
from planmatch.llm.common import prepare
from planmatch.llm.wavelet import tokenizer_path

PATH = tokenizer_path(V.TOKENIZER)
TEXTS = ["The Quick brown fox's don't 12 34!! ", None, "", "日本語 テキスト   x", "a <|endoftext|> b <|startoftext|>", "İstanbul ΣΑΣ é ŉ ǅ ſ",
         "same text", "same text", " ".join(f"w{i * 7919 % 997}" for i in range(6_000)), "x" * 9_000, "\t\n \r", "été ÀÉ ÿ ı \x1c \x85 \xa0z", "'s 't'll  'm--__ñ"]


def whole(pieces, want):
    """Every document's ids, once each and in place; sequences gapless and under the limits."""
    by, sequences = {}, {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by) == set(want)
    for doc, own in by.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert b"".join(bytes(p.ids) for p in own) == want[doc].tobytes() and {p.doc_tokens for p in own} == {len(want[doc])}
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
    return {s: sum(n for _, n in parts) for s, parts in sequences.items()}


def padded(sizes, full):
    return sum(0 if n & (n - 1) == 0 else full - n for n in sizes.values())


def test_texts(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, length long, TEXT string").coalesce(2)
    lib = Tokenizer.from_file(PATH)
    want = {i: np.array([*lib.encode(t or "", add_special_tokens=False).ids, V.END_ID], "<u4") for i, t in enumerate(TEXTS)}
    for limits in (V.Limits(), V.Limits(tokens=64, segments=3, loss=64), V.Limits(tokens=64, segments=2, loss=48)):
        pieces = V.pack_texts(docs, PATH, limits).collect()
        sizes = whole(pieces, want)
        assert max(sizes.values()) <= min(limits.tokens, limits.loss) and padded(sizes, limits.tokens) == 0
        assert max(sum(p.sequence_id == s for p in pieces) for s in sizes) <= limits.segments
    assert V.pack_texts(docs.limit(0), PATH).count() == 0


def test_null_and_repeated_ids(spark):
    prepare(spark)
    rows = spark.createDataFrame([(None, "one"), (None, "one"), (3, "two"), (3, "two")], "doc_id long, text string")
    got = V.pack_texts(rows, PATH).collect()
    assert sorted([str(p.doc_id) for p in got if p.start == 0]) == ["3", "3", "None", "None"] and sum(p.length for p in got) == 8


def test_instruction_limits(spark):
    """Prompts bear no loss: three limits hold at once, and the spans' loss is counted by brute force."""
    prepare(spark)
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for i in range(400):
        n = int(rng.integers(1, 300))
        cut = sorted(rng.integers(0, n + 1, 4).tolist())
        want[i] = rng.integers(0, 40_000, n).astype("<u4")
        rows.append((i, want[i].tobytes(), [(cut[0], cut[1]), (cut[2], cut[3])] if i % 9 else None))
    rows += [(900, None, None), (901, b"", [])]
    limits = V.Limits(tokens=256, segments=5, loss=100)
    examples = spark.createDataFrame(rows, "doc_id long, ids binary, loss array<struct<a:int,z:int>>").repartition(3)
    pieces = V.pack_examples(examples, limits).collect()
    sizes = whole(pieces, want)
    assert max(sizes.values()) <= 256 and padded(sizes, 256) == 0
    spans = {r[0]: r[2] for r in rows}
    seqs: dict = {}
    for p in pieces:
        bears = np.zeros(p.doc_tokens, bool)
        for a, z in spans[p.doc_id] if spans[p.doc_id] is not None else [(0, p.doc_tokens)]:
            bears[a:z] = True
        assert p.n_loss == bears[p.start : p.start + p.length].sum()
        seqs.setdefault(p.sequence_id, []).append(p.n_loss)
    assert max(map(sum, seqs.values())) <= 100 and max(map(len, seqs.values())) <= 5


def test_dot_product_choice():
    """Of what fits, the greatest dot product with what is left; by brute force over the pool."""
    rng = np.random.default_rng(1)
    limits = V.Limits(tokens=1000, segments=50, loss=500)
    sizes = rng.integers(50, 900, 40)
    spans = [[(0, int(n * f))] for n, f in zip(sizes, rng.random(40) * 0.55)]
    pool = V.Pool(limits)
    pool.add([(i, int(n), V.merged(s, int(n))) for i, (n, s) in enumerate(zip(sizes, spans))])
    left, t, loss = dict(enumerate(zip(sizes.tolist(), [s[0][1] for s in spans]))), 1000, 500
    for payload, start, n, own in pool.sequence():
        fits = {i: (a / 1000) * (t / 1000) + (b / 500) * (loss / 500) for i, (a, b) in left.items() if a <= t and b <= loss}
        if not fits:
            assert payload == max(left, key=lambda i: left[i][0])
            break
        best = max(fits.values())
        assert start == 0 and np.isclose(fits[payload], best) and left.pop(payload) == (n, own)
        t, loss = t - n, loss - own


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 3000, 77])
def test_powers(n):
    got = V.at_powers([("a", 5, n, n)], lambda p: None, 4096)
    lengths = [sum(x[2] for x in s) for s in got]
    assert sum(lengths) == n and all(x & (x - 1) == 0 for x in lengths) and len(lengths) == n.bit_count()


def test_registered_query(spark):
    prepare(spark)
    rows = V.query(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema][:7] == ["doc_id bigint", "start bigint", "length bigint", "ids_crc32 bigint", "doc_tokens bigint", "sequence_id bigint", "offset bigint"]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    lib = Tokenizer.from_file(PATH)
    got = rows.collect()
    for r in got:
        ids = np.array([*lib.encode(docs[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values()) and set(docs) == {r.doc_id for r in got}
