"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; the context of a decision is the byte's bits so far and the bytes before.
Each context of 0 to ``DEPTH`` bytes keeps a Krichevsky-Trofimov estimate from its counts, and every node
weighs its own estimate against its children's: Pw = (Pkt + product of the children's Pw) / 2.  A frozen
tree predicts a bit by mixing along its path: at a node, w * KT + (1 - w) * child, with w the node's share
Pkt / (2 Pw); a context never seen predicts one half.  A text is its bytes and one end symbol.

The counts are those of (DEPTH + 1)-byte strings.  Blocks of documents send their distinct strings to buckets
by the two bytes nearest to the predicted one, so that all deeper contexts of a string lie in its bucket;
contexts of 0 and 1 bytes (257 at most) are summed over the buckets.  A bucket scores exactly the strings
that blocks sent, trained on or not, and each block gets its strings' scores back.  The words of the base
score travel the same way, by 64-bit name.

Null text counts as empty (the end symbol only).  A null doc_id is never held out.  Repeated rows each get
their row, and count as often as they come in training.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import BLOBS, NO_ID, beside, blob_rows, bucketed, buckets, documents, held_out, mix, pack, read, saved, squeeze, unsqueeze

DEPTH = 6
BLOCK_BYTES = 4 << 20
#: Stands before a text and ends it; no byte of UTF-8.
EDGE = 0xFF
SHAPE = f"kind int, {BLOBS}"
STRINGS, WORDS = 0, 1
#: Of a word's name: two of 10 million words share one with a chance below 1 in 1,000.
WORD_BITS = 56
#: How a string's score travels back to the blocks: 11 bits of precision, which even out over a text's bytes.
SCORE = "<f2"


# ------------------------------------------------------------------- a block


def edged(row: dict, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes with ``depth`` edges before each piece and one after each text's end; which are predicted; whose piece."""
    data, at, parts, size, own = row["data"], 0, [], [], []
    for n, skip, mine, last in zip(row["size"], row["skip"], row["own"], row["last"]):
        parts += [bytes([EDGE]) * depth, data[at : at + skip + mine], bytes([EDGE]) * last]
        size.append((depth + skip, mine + last))
        own.append(depth + skip + mine + last)
        at += n
    lead = np.array(size, np.int64).reshape(-1, 2)
    mask = np.repeat(np.tile([False, True], len(lead)), lead.ravel())
    return np.frombuffer(b"".join(parts), np.uint8), mask, np.repeat(np.arange(len(own)), own)


def strings(data: np.ndarray, depth: int) -> np.ndarray:
    """At each byte: the ``depth`` bytes before it, the nearest in front, then the byte, as one number."""
    key = data.astype(np.uint64)
    for j in range(1, depth + 1):
        key[j:] |= data[:-j].astype(np.uint64) << np.uint64(8 * (depth + 1 - j))
    return key


_table = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_base = np.uint64(0x9E3779B97F4A7C15)
_unbase = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_low = np.arange(256, dtype=np.uint8)
_low[65:91] += 32


@functools.cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, _base, np.uint64)), np.cumprod(np.full(n, _unbase, np.uint64))


def words(data: np.ndarray, mask: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words among the predicted bytes, and the place of each (its piece)."""
    inside = mask & (data != EDGE) & (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, back = powers(1 << (len(data) + 1).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_table[_low[data]] * power[: len(data)], dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * back[start], (end - start).astype(np.uint64)) >> np.uint64(64 - WORD_BITS), piece[start]


def distinct(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (of 63 bits at most), and how often each comes in training."""
    both = np.sort(keys << np.uint64(1) | train)
    bare = both >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], bare[1:] != bare[:-1]])) if len(bare) else np.zeros(0, np.int64)
    count = np.add.reduceat((both & np.uint64(1)).astype(np.int64), first) if len(first) else first
    return bare[first], count


def spread(kinds: np.ndarray, value: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each key, from the values of its kind.  Keys and kinds are sorted by a hash that shares a
    word with the position, which is quick; should two kinds share a hash, they are sorted as they are."""
    bits = np.uint64(max(1, len(keys).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    tagged = lambda x: np.sort(mix(x, x) >> bits << bits | np.arange(len(x), dtype=np.uint64))
    own, all_ = tagged(kinds), tagged(keys)
    hashes, at = all_ >> bits, (all_ & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else at
    order = (own & low).astype(np.int64)
    if len(first) != len(kinds):
        return value[np.unique(keys, return_inverse=True)[1]]
    out = np.empty(len(keys), value.dtype)
    out[at] = np.repeat(value[order], np.diff(np.append(first, len(keys))))
    return out


def dealt(bucket: np.ndarray):
    """(bucket, indexes) of keys, by the number of each one's bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(order)).tolist()):
        yield int(bucket[order[lo]]), order[lo:hi]


def buckets_of(kind: int, kinds: np.ndarray, depth: int, n: int) -> np.ndarray:
    """Strings go by the two bytes nearest to the predicted one, words by ranges of their names."""
    if kind == WORDS:
        return ((kinds >> np.uint64(WORD_BITS - 16)) * np.uint64(n) >> np.uint64(16)).astype(np.int32)
    near = kinds >> np.uint64(8 * (depth - 1))
    of = (mix(np.arange(65_536, dtype=np.uint64), np.arange(65_536, dtype=np.uint64)) % np.uint64(n)).astype(np.int32)
    return of[near]


class Parts:
    """What a block sends, and what comes back for it."""

    def __init__(self, row: dict, depth: int, n: int):
        data, mask, piece = edged(row, depth)
        train = np.asarray(row["train"], bool)
        self.piece = {STRINGS: piece[mask]}
        keys = {STRINGS: strings(data, depth)[mask]}
        keys[WORDS], self.piece[WORDS] = words(data, mask, piece)
        self.keys = keys
        self.found = {k: distinct(keys[k], train[self.piece[k]]) for k in keys}
        self.dealt = {k: dict(dealt(buckets_of(k, u, depth, n))) for k, (u, _) in self.found.items()}

    def sent(self):
        for k, (kinds, count) in self.found.items():
            cut = self.dealt[k]
            yield k, list(cut), [squeeze(np.diff(kinds[i], prepend=np.uint64(0)), count[i].astype("<u4")) for i in cut.values()]

    def back(self, kind: int, sides: list[dict]) -> np.ndarray:
        """A value for each occurrence."""
        kinds, _ = self.found[kind]
        value = np.zeros(len(kinds), np.float64)
        for side in sides:
            value[self.dealt[kind][side["bucket"]]] = unsqueeze(side["blob"], SCORE if kind == STRINGS else "<u4")[0]
        return spread(kinds, value, self.keys[kind])


# --------------------------------------------------------------- the tree's math


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps up."""
    y, down = x + 8, np.ones_like(x)
    for k in range(8):
        down = down * (x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(down)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the KT probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def weighted(log_own: np.ndarray, log_children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log Pw, and the node's share w."""
    pw = np.logaddexp(log_own, log_children) - math.log(2)
    return pw, np.exp(log_own - math.log(2) - pw)


def levels(symbol: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Decision number (1 to 255) and bit of symbols at a level."""
    return (np.uint64(1) << np.uint64(level)) | symbol >> np.uint64(8 - level), symbol >> np.uint64(7 - level) & np.uint64(1)


def subtree(kinds: np.ndarray, count: np.ndarray, depth: int, top: int) -> list[list[tuple]]:
    """For depths ``depth`` down to ``top`` and each level: sorted keys (context, decision), zeros, ones, log Pw, share."""
    kinds, count = kinds[count > 0], count[count > 0].astype(np.float64)
    symbol = kinds & np.uint64(255)
    out: list[list[tuple]] = []
    for d in range(depth, top - 1, -1):
        context = kinds >> np.uint64(8 * (depth + 1 - d)) << np.uint64(8)
        row = []
        for level in range(8):
            node, bit = levels(symbol, level)
            keys, of = np.unique(context | node, return_inverse=True)
            ones = np.bincount(of, count * bit, len(keys))
            zeros = np.bincount(of, count, len(keys)) - ones
            own = log_kt(zeros, ones)
            if d == depth:
                pw, share = own, np.ones(len(keys))
            else:
                below = out[-1][level]
                parent = (below[0] >> np.uint64(16) << np.uint64(8)) | (below[0] & np.uint64(255))
                pw, share = weighted(own, np.bincount(np.searchsorted(keys, parent), below[3], len(keys)))
            row.append((keys, zeros, ones, pw, share))
        out.append(row)
    return out


def merged(blobs) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Distinct keys of all blobs, their summed counts, each entry's index among them, entries of each blob."""
    got = [unsqueeze(b, "<u8", "<u4") for b in blobs]
    keys = [np.cumsum(k, dtype=np.uint64) for k, _ in got]
    kinds, of = np.unique(np.concatenate(keys), return_inverse=True)
    return kinds, np.bincount(of, np.concatenate([c for _, c in got]), len(kinds)).astype(np.int64), of, [len(k) for k in keys]


def bucket_sums(depth: int):
    def sums(part: pd.DataFrame) -> pd.DataFrame:
        """For each nearest byte: counts of the byte that follows, and the log Pw of its two-byte contexts by decision."""
        kinds, count, _, _ = merged(part.blob)
        near = (kinds >> np.uint64(8 * depth)).astype(np.int64)
        follow = np.bincount(near * 256 + (kinds & np.uint64(255)).astype(np.int64), count, 65_536).reshape(256, 256)
        below = np.zeros(65_536)
        if count.any():
            for keys, _, _, pw, _ in subtree(kinds, count, depth, 2)[-1]:
                below += np.bincount(((keys >> np.uint64(16)) * np.uint64(256) + (keys & np.uint64(255))).astype(np.int64), pw, 65_536)
        below = below.reshape(256, 256)
        used = np.flatnonzero(follow.any(1))
        lists = lambda x: pd.Series([x[c].tolist() for c in used], dtype=object)
        return pd.DataFrame({"near": used, "follow": lists(follow), "below": lists(below)})

    return sums


def top_of(rows) -> tuple[np.ndarray, np.ndarray]:
    """(257, 256) shares and probabilities of a one: contexts of one byte, and in row 256 the empty context."""
    zeros, ones, below = (np.zeros((257, 256)) for _ in range(3))
    for r in rows:
        follow, symbol = np.array(r.follow), np.arange(256, dtype=np.uint64)
        below[r.near] = r.below
        for level in range(8):
            node, bit = (x.astype(np.int64) for x in levels(symbol, level))
            ones[r.near] += np.bincount(node, follow * bit, 256)
            zeros[r.near] += np.bincount(node, follow * (1 - bit), 256)
    zeros[256], ones[256] = zeros[:256].sum(0), ones[:256].sum(0)
    pw, share = weighted(log_kt(zeros, ones), below)
    seen = (zeros + ones) > 0
    root, root_share = weighted(log_kt(zeros[256], ones[256]), np.where(seen[:256], pw[:256], 0).sum(0))
    share[256] = root_share
    return np.where(seen, share, 0.0), (ones + 0.5) / (zeros + ones + 1)


def string_scores(kinds: np.ndarray, count: np.ndarray, depth: int, top: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 of the tree's probability of each string's last byte."""
    share, one = top
    tree = subtree(kinds, count, depth, 2) if count.any() else []
    symbol, near = kinds & np.uint64(255), (kinds >> np.uint64(8 * depth)).astype(np.int64)
    total = np.zeros(len(kinds))
    for level in range(8):
        node, bit = levels(symbol, level)
        p = np.full(len(kinds), 0.5)
        for d, row in zip(range(depth, 1, -1), tree):
            keys, zeros, ones, _, own = row[level]
            want = (kinds >> np.uint64(8 * (depth + 1 - d)) << np.uint64(8)) | node
            i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            kt = (np.where(bit == 1, ones[i], zeros[i]) + 0.5) / (zeros[i] + ones[i] + 1)
            p = np.where(keys[i] == want, own[i] * kt + (1 - own[i]) * p, 0.5)
        at = node.astype(np.int64)
        for row_ in (near, 256):
            kt, w = np.where(bit == 1, one[row_, at], 1 - one[row_, at]), share[row_, at]
            seen = w > 0
            p = np.where(seen, w * kt + (1 - w) * p, p)
        total += np.log10(p)
    return total


def bucket_scores(depth: int, top):
    def scores(part: pd.DataFrame) -> pd.DataFrame:
        """Strings: their scores; words: their counts.  ``v`` and ``n`` sum up the trained words, distinct and all."""
        kind = int(part.kind.iloc[0])
        kinds, count, of, size = merged(part.blob)
        value = string_scores(kinds, count, depth, top).astype(SCORE) if kind == STRINGS else count.astype("<u4")
        blobs = [squeeze(x) for x in np.split(value[of], np.cumsum(size)[:-1])]
        v, n = (int((count > 0).sum()), int(count.sum())) if kind == WORDS else (0, 0)
        rest = [0] * (len(part) - 1)
        return pd.DataFrame({"kind": part.kind, "block": part.block, "bucket": part.bucket, "blob": blobs, "v": [v, *rest], "n": [n, *rest]})

    return scores


# ------------------------------------------------------------------------ jobs


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """From rows (doc_id, text, train): doc_id, train, n_bytes, n_tokens, n_known, train_tokens, base_score, score."""
    if depth < 2 or depth > 6:
        raise ValueError("depth: 2 to 6 bytes")
    blocks = pack(docs, "context", block_bytes, before=depth)
    n = buckets(blocks)
    fields = blocks.select("block", "skip", "own", "size", "last", "train", "data")

    def send(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                for kind, bucket, blobs in Parts(row, depth, n).sent():
                    rows = blob_rows(row["block"], bucket, blobs)
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(blobs), pa.int32()), *rows.columns], names=["kind", "block", "bucket", "blob"])

    sent = bucketed(fields.mapInArrow(send, SHAPE), "counts", "kind", "bucket")
    by_near = (sent.filter(F.col("kind") == STRINGS).groupBy("kind", "bucket").applyInPandas(bucket_sums(depth), "near int, follow array<double>, below array<double>"))
    summed = by_near.groupBy("near").agg(*[F.array(*[F.sum(F.col(c)[i]) for i in range(256)]).alias(c) for c in ("follow", "below")])
    top = top_of(summed.collect())  # 256 rows at most
    found = saved(sent.groupBy("kind", "bucket").applyInPandas(bucket_scores(depth, top), f"{SHAPE}, v long, n long"), "scores")
    sums = found.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = docs.filter("train").count()  # the end token's count
    v, total = sums.v + (ends > 0), sums.n + ends

    def whole(batches):
        import pyarrow as pa

        names = ["rid", "doc_id", "train", "n_bytes", "n_tokens", "n_known", "base", "score"]
        for batch in batches:
            for row in batch.to_pylist():
                parts, k = Parts(row, depth, n), len(row["rid"])
                p = parts.back(STRINGS, row["side0"] or [])
                c = parts.back(WORDS, row["side1"] or [])
                by = lambda kind, x=None: np.bincount(parts.piece[kind], x, k)
                doc = [None if d == NO_ID else d for d in row["doc"]]
                out = [pa.array(row["rid"], pa.int64()), pa.array(doc, pa.int64()), pa.array(row["train"]), pa.array(row["own"], pa.int64()),
                       pa.array(by(WORDS).astype(np.int64)), pa.array(by(WORDS, c > 0).astype(np.int64)), pa.array(by(WORDS, np.log10(c + 1)).astype(float)), pa.array(by(STRINGS, p).astype(float))]
                yield pa.RecordBatch.from_arrays(out, names=names)

    fields = blocks.select("block", "rid", "doc", "skip", "own", "size", "last", "train", "data")
    sides = [found.filter(F.col("kind") == k).select("block", "bucket", "blob") for k in (STRINGS, WORDS)]
    pieces = beside(fields, *sides).mapInArrow(whole, "rid long, doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base double, score double")
    rows = pieces.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("train").alias("train"), *[F.sum(c).alias(c) for c in ("n_bytes", "n_tokens", "n_known", "base", "score")])
    tokens = F.col("n_tokens") + 1
    return rows.select("doc_id", "train", "n_bytes", tokens.alias("n_tokens"), (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                       (F.col("base") + math.log10(ends + 1) - tokens * math.log10(total + v + 1)).alias("base_score"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op7; code_length is in bits per byte, the end symbol counted as one."""
    docs = documents(read(spark, sf_dir, "documents"))
    out = score(docs.withColumn("train", ~held_out(F.col("doc_id"), 7)))
    bits = -F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", bits.alias("code_length"))
