"""Operators against brute force, round trips and held-out accuracy, with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest

from planmatch.llm import context_tree, decontaminate, hyper_language, sentencepieces, simhash_tiles, suffix_dedup, topk_blocks, toxicity, warc, wavelet
from planmatch.llm.common import prepare, scratch

LONG = " ".join(f"w{i * 7919 % 997}" for i in range(3_000))
SHARED = "a passage of well over fifty bytes that several of the documents have in common"
DOCS = [(0, "The quick brown fox. " + SHARED, "en"), (1, "The quick brown fox. " + SHARED, "en"), (2, None, "en"), (3, "", None), (4, LONG, "en"), (5, "x " + SHARED + " é😀 " + SHARED, "fr"),
        (6, "日本語 テキスト\n\n  spaces   everywhere ", None), (7, "The quick brown fox. " + SHARED, "en"), (7, "The quick brown fox. " + SHARED, "en"), (None, SHARED, "en"), (8, LONG + " tail", "en"), (9, "12 34 --", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(d, t, lang, "s", None, 1, "clash") for d, t, lang in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words long, TEXT string").coalesce(2)


@pytest.fixture(scope="module")
def none(spark):
    prepare(spark)
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_wavelet(spark, docs, none):
    folder = scratch(spark, "t")
    assert wavelet.write_shards(docs, folder, wavelet.tokenizer_path(), shard_tokens=500).count() >= 1
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.with_starts(wavelet.read_shards(spark, folder)).collect())
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(wavelet.tokenizer_path())
    want = sorted(((d, len(i), zlib.crc32(i.tobytes())) for d, t, _ in DOCS for i in [np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")]), key=str)
    assert sorted(((d, n, c) for _, d, n, c in got), key=str) == want
    assert [d for _, d, _, _ in got] == sorted([d for d, _, _ in DOCS], key=lambda d: (d is not None, d or 0))
    assert all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:])) and got[0][0] == 0
    assert wavelet.write_shards(none, scratch(spark, "t"), wavelet.tokenizer_path()).count() == 0


def test_wavelet_ids_are_the_librarys():
    """Added tokens' text, white space of all kinds beside spaces, other scripts, control characters, new lines."""
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>x <|endoftext|", "a\nb  c\n d \u00a0e\u3000 f\x1c g", "", " ", "x ", "\n", "don't I'LL 12 3x ,,. \x00\x01 \x00",
             "\u00e9\u0301 \u0130 \u1e9e \u00aa\u00ba\u00b2 \u00d7\u00f7", "\t\ta b\t c", "\r\n x", "日本 語", LONG, "a\n\n\nb c\n\n"]
    own, lib = wavelet.Pieces(wavelet.tokenizer_path()), Tokenizer.from_file(wavelet.tokenizer_path())
    for _ in range(2):  # learnt, and remembered
        assert [np.frombuffer(r, "<u4").tolist() for r in own.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_wavelet_registered_query(spark):
    from tokenizers import Tokenizer

    lib, start = Tokenizer.from_file(wavelet.tokenizer_path()), 0
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in wavelet.query(spark, "/root/testdata/sf0.001").collect()}
    for d, t in docs:
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert got.pop((d, start)) == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_wavelet_matrix():
    ids = np.random.default_rng(0).integers(0, 300, 3_000).astype(np.uint32)
    m = wavelet.from_bytes(wavelet.to_bytes(ids, np.array([3_000]), [1], 0, 0))[4]
    assert (m.ids() == ids).all() and [m.access(i) for i in (0, 511, 512, 2_999)] == ids[[0, 511, 512, 2_999]].tolist()
    assert m.count(7, 100, 2_000) == (ids[100:2_000] == 7).sum() and m.occurrences(7) == np.flatnonzero(ids == 7).tolist() and m.count(5_000) == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(10, SHARED), (11, "Quick BROWN fox"), (12, None), (13, ""), (None, "w0 w940"), (11, "Quick BROWN fox"), (14, LONG)], "item_id long, text string")
    word, low = re.compile(decontaminate.WORD), str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
    windows = {}
    for i, t in [(10, SHARED), (11, "Quick BROWN fox"), (None, "w0 w940"), (14, LONG)]:
        w = word.findall(t.translate(low))
        for k in range(max(1, len(w) - 9)):
            windows.setdefault(tuple(w[k : k + 10]), set()).update({i} - {None})
    want = []
    for d, t, _ in DOCS:
        w = word.findall((t or "").translate(low))
        at = [(k, len(x), windows[tuple(w[k : k + len(x)])]) for x in {n: () for n in map(len, windows)} and {len(y): y for y in windows}.values() for k in range(len(w) - len(x) + 1) if tuple(w[k : k + len(x)]) in windows]
        want.append((d, len(w), len({p for k, n, _ in at for p in range(k, k + n)}), tuple(sorted(set().union(*[i for _, _, i in at])))))
    for rows in (decontaminate.BROADCAST_ROWS, 0):  # broadcast, and the way beyond it
        got = decontaminate.contamination(docs, items, broadcast_rows=rows).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r.item_ids))) for r in got), key=str) == sorted(want, key=str)
    assert decontaminate.contamination(none, items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def test_sentencepiece_equals_the_library(spark, docs, none):
    import sentencepiece

    path = sentencepieces.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted(np.array(sp.encode(t or ""), "<u4").tobytes() for _, t, _ in DOCS)
    for chunk in (sentencepieces.CHUNK, 80):  # whole, and by max-plus matrices
        assert sorted(bytes(r.ids) for r in sentencepieces.encode(docs, path, chunk).collect()) == want
        assert all(r.round_trip for r in sentencepieces.digests(docs, path, chunk).collect())
    assert sentencepieces.digests(none, path).count() == 0
    for text in ("a" * 500, "=-" * 300, "\n \t x", " ", "a▁b"):
        assert np.frombuffer(sentencepieces.encode_all(path, [sentencepieces.cut_words(sentencepieces.plain(text))])[0], "<u4").tolist() == sp.encode(text)


def test_max_plus_is_associative():
    a, b, c = (np.random.default_rng(k).normal(size=(4, 4)) for k in range(3))
    assert np.allclose(sentencepieces.max_plus(sentencepieces.max_plus(a, b), c), sentencepieces.max_plus(a, sentencepieces.max_plus(b, c)))


def test_warc(spark):
    prepare(spark)
    pages = [(3, "http://a/ b", "same"), (1, None, "same"), (2, "http://c", None), (4, "http://d", ""), (None, "x", "same"), (5, "u", "\x1f\x8b\x08 not a member " * 50), (1, None, "same"), (6, "u", LONG)]
    folder = scratch(spark, "t")
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), folder, file_bytes=600)
    want = sorted((len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if i in (1, 2, 5, 6) else "revisit", None if i in (1, 2, 5, 6) else {3: 1, 4: 2, None: 1}[i]) for i, _, h in pages)
    for split in (64, 1 << 20):
        got = warc.read_warc(spark, folder, split).collect()
        assert sorted((r.payload_bytes, r.payload_digest, r.record_type, warc.page_of(r.refers_to)) for r in got) == want
        assert LONG.encode() in {bytes(r.payload) for r in got if r.payload is not None}


def test_toxicity(spark, none):
    prepare(spark)
    rng = np.random.default_rng(1)
    say = lambda: " ".join(rng.choice([f"w{a}{b}rd" for a in "abcdefgh" for b in "klmnopqr"], 20))
    rows = [(i, say() + (" blorf " + say() if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(900, None), (None, 1)], "doc_id long, toxic int")
    machine = toxicity.fit(docs.filter("doc_id < 150 or doc_id is null"), labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    assert len(got) == 202 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == bool(t) for i, _, t in rows if i >= 150)
    assert machine.scores(["so b.l.o.r.f here", "b l o r f", "bl0rf", "plain words"]).round(1).tolist()[:3] != [0, 0, 0]
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_toxicity_takes_all_insult_roots(spark):
    prepare(spark)
    rng = np.random.default_rng(2)
    roots = ["".join(rng.choice(list("bcdfghjklmnpqrstvxz"), 6)) for _ in range(40)]
    say = lambda: " ".join(rng.choice([f"w{a}{b}ea" for a in "abcdefgh" for b in "klmnopqr"], 8))
    rows = [(i, say() + (f" {roots[i // 4 % 40]} " if i % 4 == 0 else " ") + say(), int(i % 4 == 0)) for i in range(1_760)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 1_600], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    assert set(roots) <= set(machine.landmarks)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in rows if i >= 1_600)


def kernel_by_loops(one, two):
    def weights(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN + 1)):
                    out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxicity.LAMBDA ** (k - i + 1)
        return out

    a, b = weights(one), weights(two)
    return sum(v * b.get(u, 0) for u, v in a.items()) / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5


def test_subsequence_kernel():
    words = ["abcab", "abc", "xyz", "blorf", "blxorf", "абвгд", "абвжгд", "漢字語文", "漢字文語", "éabcé"]
    landmarks = ["abc", "blorf", "абвгд", "漢字語文", "xyzzy"]
    got = toxicity.Profiles(landmarks).kernels(words)
    assert np.allclose(got, [[kernel_by_loops(w, m) for m in landmarks] for w in words], atol=1e-6)


def test_scripts_are_told_apart():
    """Unrelated words of other alphabets are as unlike as Latin ones: letters share no codes."""
    rng = np.random.default_rng(4)
    for first, size in ((0x61, 26), (0x430, 32), (0x3B1, 24), (0x4E00, 500)):
        words = ["".join(chr(first + int(c)) for c in rng.integers(0, size, 7)) for _ in range(300)]
        got = toxicity.Profiles(words[:30]).kernels(words[30:])
        assert (got > toxicity.FLOOR).mean() < 0.002


def test_long_words_teach_all_their_letters():
    word = "z" * 40 + "blorf"
    assert any("blorf" in part for part, _ in toxicity.neighbourhoods(f"so {word} said")) and "blorf" in toxicity.forms_of(word)[-1][-8:] + toxicity.stretches(word)[-1]


def test_toxicity_registered_query(spark):
    """Columns, folds and threshold; scores by plain loops over every word, stem and landmark; copies score alike."""
    base = "/root/testdata/sf0.001"
    got = toxicity.query(spark, base)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["doc_id bigint", "held_out boolean", "score double", "predicted int"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    machine = toxicity.fit(docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"), spark.read.parquet(f"{base}/labels.parquet"))
    for r in docs.collect():
        assert rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert rows[r.doc_id].predicted == int(rows[r.doc_id].score >= 0.3)
    for r in [x for x in docs.collect() if x.text and len(x.text) < 600][:6]:
        best = dict.fromkeys(machine.landmarks, 0.0)
        for form in {f for t in r.text.lower().split() for f in toxicity.forms_of(t)}:
            for m in best:
                k = kernel_by_loops(form, m)
                best[m] = max(best[m], k if k >= toxicity.FLOOR else 0.0)
        margin = sum(a * best[m] ** toxicity.POWER for a, m in zip(machine.alpha, machine.landmarks)) + machine.bias
        assert np.isclose(rows[r.doc_id].score, 1 / (1 + np.exp(-(machine.curve[0] * margin + machine.curve[1]))), atol=1e-4)


def test_simhash(spark, docs, none):
    got = simhash_tiles.simhash_components(docs, tile=2).collect()
    fps = [simhash_tiles.fingerprint(t) for _, t, _ in DOCS]
    up = list(range(len(DOCS)))
    for _ in DOCS:
        for i in range(len(DOCS)):
            for j in range(len(DOCS)):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    up[i] = up[j] = min(up[i], up[j])
    least = {r: min([DOCS[i][0] for i in range(len(DOCS)) if up[i] == r and DOCS[i][0] is not None], default=None) for r in up}
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == sorted(((d, f, least[u]) for (d, _, _), f, u in zip(DOCS, fps, up)), key=str)
    assert simhash_tiles.simhash_components(none).count() == 0


def test_simhash_tiles_miss_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(1 << 5), base ^ np.uint64((1 << 60) | (1 << 33) | 2), rng.integers(0, 1 << 63, 700, np.uint64)]))
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3]
    stars = simhash_tiles.forest_of(fps, None, 3)
    label = {int(m): int(r) for m, r in stars}
    assert all(label.get(i, i) == label.get(j, j) for i, j in near) and len(label) == 80


def test_context_tree(spark, none):
    prepare(spark)
    rows = [(0, "abra Cadabra", True), (1, "abracad  abra", True), (2, "banana cadabra", False), (3, None, True), (4, "zé", False), (5, "", False), (None, "abra Cadabra", True)]
    depth, edge = 3, context_tree.EDGE
    for block in (1 << 20, 6):  # whole texts, and pieces
        got = context_tree.score(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), depth, block).collect()
        counts: dict = {}

        def bits(text):
            b = [edge] * depth + list((text or "").encode()) + [edge]
            for i in range(depth, len(b)):
                node = 1
                for s in range(7, -1, -1):
                    yield [(tuple(b[i - k : i][::-1]), node) for k in range(depth + 1)], b[i] >> s & 1
                    node = node * 2 + (b[i] >> s & 1)

        for _, t, train in rows:
            for path, x in bits(t) if train else ():
                for k in path:
                    counts.setdefault(k, [0, 0])[x] += 1
        one = np.array([[0.0]])
        own = lambda k: float(context_tree.log_kt(one + counts[k][0], one + counts[k][1])[0, 0])

        def pw(k):
            if len(k[0]) == depth:
                return own(k)
            below = sum(pw(c) for c in counts if len(c[0]) == len(k[0]) + 1 and c[0][:-1] == k[0] and c[1] == k[1])
            return float(np.logaddexp(own(k), below) - np.log(2))

        def chance(path, d, x):
            k = path[d]
            if k not in counts:
                return 0.5
            kt = (counts[k][x] + 0.5) / (sum(counts[k]) + 1)
            w = 1.0 if d == depth else float(np.exp(own(k) - np.log(2) - pw(k)))
            return w * kt + (0 if d == depth else (1 - w) * chance(path, d + 1, x))

        want = {t: sum(np.log10(chance(path, 0, x)) for path, x in bits(t)) for t in ("banana cadabra", "zé", "")}
        by = {r.doc_id: r for r in got}
        assert len(got) == 7 and np.allclose([by[2].score, by[4].score, by[5].score], list(want.values()), rtol=2e-3)
        train = [w for _, t, tr in rows if tr for w in [*(t or "").lower().split(), None]]
        base = sum(np.log10((train.count(w) + 1) / (len(train) + len(set(train)) + 1)) for w in ["banana", "cadabra", None])
        assert np.isclose(by[2].base_score, base) and (by[2].n_tokens, by[2].n_known, by[2].train_tokens) == (3, 2, len(train))
    assert context_tree.score(none.select("doc_id", "text").selectExpr("*", "true as train")).count() == 0


def test_language(spark, docs, none):
    model = hyper_language.learn(spark.createDataFrame([("the cat and the hat that the man has", "en"), ("le chat et la souris que les hommes ont", "fr"), (None, "en"), ("x", None)], "text string, lang string"))
    got = [r.p for r in docs.select(hyper_language.language(docs.toDF("a", "b", "c", "d", "e", "f", "g").columns and docs["doc_id"].cast("string"), model).alias("p")).collect()]
    assert {p.lang_pred for p in got} == {"und"}  # digits and nulls have no letters
    rows = spark.createDataFrame([("the man and the cat",), ("les souris et le chat",), (None,), ("",), ("1 2",), ("the " * 5_000,)], "text string")
    got = [(r.p.lang_pred, 0 <= r.p.score <= 1) for r in rows.select(hyper_language.language(rows.text, model).alias("p")).collect()]
    assert got == [("en", True), ("fr", True), ("und", True), ("und", True), ("und", True), ("en", True)]
    assert hyper_language.learn(none)[0] == []


def test_language_held_out(spark):
    out = hyper_language.query(spark, "/root/testdata/sf0.001").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert out.filter("lang = lang_pred").count() >= 0.95 * out.count() > 0


def test_suffix_dedup(spark, docs, none):
    first: dict = {}
    rank = lambda d: 1 << 62 if d is None else d
    for d, t, _ in DOCS:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(rank(d), first.get(b[k : k + 50], 1 << 62))
    want = []
    for d, t, _ in DOCS:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < rank(d):
                gone[k : k + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    for block in (suffix_dedup.BLOCK_BYTES, 300):  # whole texts, and pieces
        got = suffix_dedup.dedup(docs, block_bytes=block).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)
    assert suffix_dedup.dedup(none).count() == 0


def test_suffix_names_that_collide_are_told_apart():
    data = np.frombuffer(b"abcdefgh" * 3 + b"abcdefgx", np.uint8)
    at = np.array([0, 8, 16, 24, 1, 9])
    for name in (np.zeros(6, np.uint64), np.array([7, 7, 7, 7, 3, 3], np.uint64)):  # all one name, or two strings of one
        order, new = suffix_dedup.equal_strings(name, data, at, 8)
        kinds = [data[at[i] : at[i] + 8].tobytes() for i in order]
        assert new.tolist() == [True, *[a != b for a, b in zip(kinds, kinds[1:])]] and len(set(kinds)) == new.sum()


def brute_top(rows, k=5):
    f = lambda v: [int(np.floor(256 * float(x))) for x in v]
    ok = [(i, f(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block, batch", [(16, 100), (512, topk_blocks.BATCH_BYTES)])
def test_topk(spark, block, batch):
    """Ties, repeats, unequal lengths, clashing columns, large components, everything that takes no part."""
    prepare(spark)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(120)]
    rows[7] = (7, rows[3][1])
    rows += [(50, [1.0] * 6), (12, rows[12][1]), (201, [0.5, 2.0]), (250, []), (300, None), (350, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (400, [float("nan")] * 6), (450, [float("inf")] * 6), (None, [1.0] * 6)]
    large = [(500, [300_000.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (501, [-4e9, 3e5, 0.0, 0.0, 0.0, 0.0]), (502, [262_144.0] * 6)]
    for more in ([], large):
        table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + more], "vec_id long, embedding array<double>, score long, EMBEDDING string")
        ints = topk_blocks.integers(table)
        got = topk_blocks.top_k(ints, ints.filter("vec_id % 50 = 0"), 5, block, batch).collect()
        assert sorted(tuple(r) for r in got) == brute_top(rows + more)
    assert topk_blocks.top_k(ints.limit(0), ints.limit(0)).count() == 0
    with pytest.raises(Exception, match="does not fit a long"):
        far = topk_blocks.integers(spark.createDataFrame([(0, [1e17]), (1, [1e17])], "vec_id long, embedding array<double>"))
        topk_blocks.top_k(far, far.filter("vec_id = 0")).collect()


def test_topk_bounds_hold_and_skip_blocks():
    """Successive ids of one cluster: most (query, block) pairs are never scored; no bound is too small."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 3_000
    blocks = [(np.arange(64) + 64 * b, np.floor(c + rng.normal(size=(64, 16)) * 100)) for b, c in enumerate(centres)]
    q = np.floor(centres[rng.integers(0, 40, 50)] + rng.normal(size=(50, 16)) * 100)
    bounds = topk_blocks.bounds_of(q, blocks)
    assert all((bounds[:, b] >= (q @ m.T).max(1)).all() for b, (_, m) in enumerate(blocks))
    got, scored = topk_blocks.search_group((np.full(50, -1), q), blocks, 5)
    assert scored < 50 * 40 / 2
    ids, m = np.concatenate([i for i, _ in blocks]), np.concatenate([m for _, m in blocks])
    for r, top, _ in got:
        assert top.tolist() == ids[np.lexsort((ids, -(m @ q[r])))[:5]].tolist()


def test_pipeline(spark, docs, none):
    import corpus_pipeline as C

    rows = docs
    for k, (_, stage) in enumerate(C.STAGES):
        rows = stage(spark, rows, "/root/testdata/sf0.001")
        path = scratch(spark, "stage")
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
        if k < 4:
            assert set(rows.columns) == set(C.COLUMNS)
        ids = sorted([r.doc_id for r in rows.select("doc_id").collect()], key=str)
        assert ids == sorted([[0, 1, 4, 5, 6, 7, 7, None, 8], [0, 4, 5, 6, None], [0, 4, 5, 6], [0, 4, 5, 6], [0, 4, 5, 6]][k], key=str), C.STAGES[k][0]
        if k == 0:  # a null language is filled, the others stay
            assert {r.doc_id: r.lang for r in rows.collect() if r.doc_id in (0, 5)} == {0: "en", 5: "fr"} and rows.filter("lang is null").count() == 0
        if k == 2:  # the text after the cut, and the columns that travelled with it
            at = {r.doc_id: r for r in rows.collect()}
            assert at[5].text.replace(" ", "") == "xé😀" and at[5].n_chars == len(at[5].text) and (at[5].lang, at[5].source) == ("fr", "s")
            assert at[0].text == DOCS[0][1] and at[0].n_chars is None
    assert all(r.round_trip for r in rows.collect())
    for _, stage in C.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0


def test_context_tree_reads_six_bytes(spark):
    prepare(spark)
    text = {k: f"{'PQ'[k]}abcde{k + 1}" for k in (0, 1)}  # the last byte hangs on the sixth before it
    rows = [(i, text[i % 2], True) for i in range(40)] + [(40, text[0], False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    at = lambda *depth: context_tree.score(docs, *depth).filter("doc_id = 40").first().score
    assert np.isclose(at(), at(6)) and at() > at(5) + 0.1


def test_pipeline_keeps_texts_when_no_language_is_learned(spark):
    import corpus_pipeline

    prepare(spark)
    rows = [(1, "clean words here", None), (2, None, None), (3, "12 34 --", None), (4, "日本語", None)]
    docs = spark.createDataFrame([(d, t, lang, "s", 1) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()} == {1, 4}


def test_wavelet_worker_holds_few_pieces(monkeypatch):
    """Slices of a batch are encoded one after the other; what is remembered stays bounded, and the ids are the library's."""
    from planmatch.llm import wavelet

    monkeypatch.setattr(wavelet, "CACHED_PIECES", 20)
    monkeypatch.setattr(wavelet, "SLICE_CHARS", 50)
    lib = wavelet.Pieces(wavelet.tokenizer_path())
    texts = ["", *[" ".join(f"word{i * k}" for k in range(i)) for i in range(30)], "", "x" * 200, "ó ö  a  b"]
    got = lib.encode(texts)
    assert len(lib.number) <= 20
    assert got == [ids.tobytes() for ids in lib.whole(texts)]


def test_wavelet_looks_up_a_recurring_piece_once(monkeypatch):
    """Work on pieces goes by the distinct ones of a slice, and only new pre-tokens reach the library's model."""
    looked, encoded = [], []

    class Counted(wavelet.Numbers):
        def of(self, keys):
            looked.append(len(keys))
            return super().of(keys)

    class Model:
        def tokenize(self, word):
            encoded.append(word)
            return lib.lib.model.tokenize(word)

    monkeypatch.setattr(wavelet, "Numbers", Counted)
    lib = wavelet.Pieces(wavelet.tokenizer_path())
    texts = ["the same words, again and again; the same"] * 1_000
    looked.clear()
    got = lib.encode(texts)
    assert sum(looked) < 40
    assert got == [lib.whole(texts[:1])[0].tobytes()] * 1_000
    lib.clear()
    lib.model = Model()
    assert lib.encode(texts) == got
    assert len(encoded) == len(set(encoded)) == 8  # ``the`` with and without a space in front
    assert lib.encode(["again; the same", "words, and"]) == [i.tobytes() for i in lib.whole(["again; the same", "words, and"])] and len(encoded) == 10  # ``again`` and ``words`` without one


def test_wavelet_mixed_texts_are_the_librarys():
    """All kinds of white space, zero characters, scripts and added tokens beside each other."""
    from tokenizers import Tokenizer

    parts = [" ", " ", " ", "  ", "\n", "\t", "\0", "'s", "'LL", "re", "word", "é", "слово", "日本", "\u00a0", "\u3000", "\x1c", "\x85", "\r", "<|endoftext|>", "<|endof", "12", "!", "..", "×", "ɏ", "ɐ", "😀", "\u200b", "\x7f", "\xad", "½"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3_000)] + ["\0", "\0\0", "\0 ", " \0 a"]
    own, lib = wavelet.Pieces(wavelet.tokenizer_path()), Tokenizer.from_file(wavelet.tokenizer_path())
    want = [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want and own.encode(texts[::-1]) == want[::-1]
    assert own.encode([]) == [] and own.encode([None, ""]) == [b"", b""]
