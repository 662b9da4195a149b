"""Registered queries: against plain loops on the smallest tables, and over empty, null-ridden and clashing tables."""

import hashlib
import re
import tempfile
import zlib

import numpy as np
import pytest

from planmatch.llm import context_tree, hyper_language, sentencepieces, simhash_tiles
from planmatch.llm.common import prepare
from planmatch.llm.entry import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    prepare(spark)
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def out_of_fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus == 2


def test_sentencepiece(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.model_path())
    got = {r.doc_id: r for r in sentencepieces.query(spark, SF).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        ids = np.array(sp.encode(t), "<u4")
        assert (got[d].n_ids, got[d].ids_crc32, got[d].round_trip) == (len(ids), zlib.crc32(ids.tobytes()), True)


def simhash_by_loops(text):
    import xxhash

    words = WORD.findall(text.translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, texts):
    got = {r.doc_id: r for r in simhash_tiles.query(spark, SF).collect()}
    fps = {d: simhash_by_loops(t) for d, t in texts.items()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    least = {}
    for d in sorted(fps):  # flood from the smallest id
        if d not in least:
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in least:
                    least[x] = d
                    todo += [y for y in fps if y not in least and (fps[x] ^ fps[y]).bit_count() <= 3]
    assert {d: r.component_id for d, r in got.items()} == least
    for t in ("", "one", "one two", "A b\x0bc D", "x " * 50, "É é é"):
        assert simhash_tiles.fingerprint(t) == simhash_by_loops(t)


def test_context_tree(spark, texts):
    got = {r.doc_id: r for r in context_tree.query(spark, SF).collect()}
    train = [w for d, t in texts.items() if not out_of_fold(d, 7) for w in [*WORD.findall(t.translate(LOW)), None]]
    count = {}
    for w in train:
        count[w] = count.get(w, 0) + 1
    for d, t in texts.items():
        words, r = [*WORD.findall(t.translate(LOW)), None], got[d]
        base = sum(np.log10((count.get(w, 0) + 1) / (len(train) + len(count) + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out_of_fold(d, 7), len(words), sum(w in count for w in words), len(train))
        assert np.isclose(r.base_score, base) and r.score < 0
        assert np.isclose(r.code_length, -r.score / np.log10(2) / (len(t.encode()) + 1))
    assert np.mean([r.code_length for r in got.values() if r.held_out]) < 4


def bundle_by_loops(text, dims):
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    line = " " + " ".join(kept.split(" ")) + " "
    line = re.sub(" +", " ", line)
    out = np.zeros(dims)
    for a, b, c in zip(line, line[1:], line[2:]) if line.strip() else ():
        out += np.roll(hyper_language.letter_vector(ord(a), dims).astype(int), 2) * np.roll(hyper_language.letter_vector(ord(b), dims).astype(int), 1) * hyper_language.letter_vector(ord(c), dims)
    return out


def test_language(spark, texts):
    """Bundles, prototypes and cosines by plain loops."""
    dims = hyper_language.DIMENSIONS
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    some = {d: t for d, t in texts.items() if len(t) < 4_000}
    rows = spark.createDataFrame([(d, t, langs[d]) for d, t in some.items()], "doc_id long, text string, lang string")
    names, prototypes = hyper_language.learn(rows)
    sums = {n: sum(bundle_by_loops(t, dims) for d, t in some.items() if langs[d] == n) for n in names}
    assert names == sorted({v for v in langs.values() if v is not None})
    for n, p in zip(names, prototypes):
        assert np.allclose(p, sums[n] / np.linalg.norm(sums[n]), atol=1e-4)
    got = {r.doc_id: r.p for r in rows.select("doc_id", hyper_language.language(rows.text, (names, prototypes)).alias("p")).collect()}
    for d, t in list(some.items())[:60]:
        v = bundle_by_loops(t, dims)
        if not v.any():
            assert tuple(got[d]) == ("und", 0.0)
            continue
        cos = [float(v @ sums[n] / np.linalg.norm(v) / np.linalg.norm(sums[n])) for n in names]
        assert got[d].lang_pred == names[int(np.argmax(cos))] and abs(got[d].score - max(0.0, max(cos))) < 1e-3
    full = hyper_language.query(spark, SF)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in full.schema] == ["doc_id bigint", "held_out boolean", "lang_pred string", "score double"]
    assert all(r.held_out == out_of_fold(r.doc_id, 4) and 0 <= r.score <= 1 for r in full.collect())


SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
#: Further columns, named like ones that the operators make themselves.
CLASH = "block long, rid long, th string, words string, score string, rank string, node string, row long, n_bytes string, id2 long"
ROWS = {
    "documents": [(1, "Some words here, and some more.", "en", "s", 1), (1, "Some words here, and some more.", "en", "s", 1), (2, None, None, None, None), (None, "x", None, "s", 0), (3, "", "fr", "", 0),
                  (4, "w " * 4_000, "en", "s", 9), (None, None, None, None, None)],
    "embeddings": [(0, [1.0, 2.0], 1), (50, [0.5, None], 1), (None, [1.0, 1.0], None), (100, None, 1), (100, [2.0, 2.0], 1), (100, [2.0, 2.0], 1)],
    "pages": [(1, None, None), (None, "u", "h"), (2, "u", "h"), (2, "u", "h")],
    "benchmark": [(1, "some words here"), (None, None), (2, ""), (1, "some words here")],
    "labels": [(1, None, None), (None, 1, 1), (1, 0, 1), (2, 1, 0), (3, 0, 0)],
    "conversations": [(None, None, None, None), (1, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (20, 0, "", "b c")],
}


@pytest.fixture(scope="module", params=["empty", "ragged"])
def tables(request, spark):
    prepare(spark)
    base = tempfile.mkdtemp(prefix=f"tables-{request.param}-")
    extra = len(CLASH.split(", "))
    for name, schema in SCHEMAS.items():
        rows = [(*r, *[None] * extra) for r in ROWS[name]] if request.param == "ragged" else []
        own = [c for c in CLASH.split(", ") if c.split()[0] not in schema.replace(",", " ").split()]
        df = spark.createDataFrame([r[: len(schema.split(", ")) + len(own)] for r in rows], f"{schema}, {', '.join(own)}")
        df.write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_ragged_tables(spark, tables, name):
    got = QUERIES[name](spark, tables).collect()
    if "empty" in tables:
        assert got == []
    elif name.startswith(("op1_", "op2_", "op3_", "op5_", "op6_", "op7_", "op8_", "op9_")):
        assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in ROWS["documents"]), key=str)
    elif name.startswith("op13_"):
        assert sum(r["offset"] >= 0 and r["start"] == 0 for r in got) == len(ROWS["documents"])
    elif name.startswith("op4_"):
        assert sorted((r["page_id"] for r in got), key=str) == sorted((r[0] for r in ROWS["pages"]), key=str)
    else:
        assert got


def test_kept_bytes_hash(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op9_suffix_dedup"](spark, SF).collect()}
    for d, t in texts.items():
        if got[d].n_removed == 0:
            assert got[d].kept_sha256 == hashlib.sha256(t.encode()).hexdigest() and got[d].n_spans == 0
