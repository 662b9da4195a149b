"""Removal of byte strings that occur in an earlier document, by prefix doubling over sampled suffixes.

Positions are named by 64-bit names of their prefixes, doubled from 8 to 16 to 32 to 50 bytes: the name of a
longer prefix is made from the pair of names at a position and at a growing offset.

1.  Every 50-byte string contains 27 places of 24-byte prefixes; the one with the least name stands for it
    (its anchor), so equal strings have equal anchors at equal offsets.  Only anchors are ranked first.  Blocks
    of documents send the distinct anchor names to buckets by name; an anchor that only one document has is
    unique, and with it all strings that it stands for: they leave.
2.  What stays is named at the full 50 bytes, in buckets by anchor name, and each name's least document is
    found.  A block sends equal stretches once, for its least document: copies in that block's later documents
    are covered by it already, so a passage of any number of documents comes in at most once a block.
3.  Each block gets back which strings start in a smaller document, and cuts the bytes they cover.

Null text counts as empty.  A null doc_id is larger than any id (and no smaller than another null).  Rows of
one doc_id are never compared with each other.  Repeated rows each get their row.  A text longer than a block is
cut into pieces that overlap by 49 bytes and put together again; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import BLOBS, NO_ID, beside, blob_rows, buckets, give_back, mix, pack, pick, read, squeeze, unsqueeze

LENGTH = 50
ANCHOR = 24
BLOCK_BYTES = 4 << 20
STRETCH = 1 << 15


# -------------------------------------------------------------- names in a block


def names8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position, as a number (zeros behind the end)."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data), np.uint64)
    for o in range(8):
        part = out[o::8]
        part[:] = padded[o : o + 8 * len(part)].view("<u8")
    return out


def shifted(a: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([a[by:], np.zeros(min(by, len(a)), a.dtype)])


def _names(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    have, name, short = 8, names8(data), None
    while have < length:
        if short is None and have * 2 > anchor:
            short = mix(name, shifted(name, anchor - have))
        step = min(have, length - have)
        name, have = mix(name, shifted(name, step)), have + step
    return short, name


def names(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the ``anchor`` and of the ``length`` bytes at each position, stretch by stretch to stay in the cache."""
    short, full = np.empty(len(data), np.uint64), np.empty(len(data), np.uint64)
    for lo in range(0, len(data), STRETCH):
        hi = min(len(data), lo + STRETCH)
        a, z = _names(data[lo : hi + 2 * length], length, anchor)
        short[lo:hi], full[lo:hi] = a[: hi - lo], z[: hi - lo]
    return short, full


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        a, have = np.minimum(a[:-step], a[step:]) if step < len(a) else a[:0], have + step
    return a


class Block:
    """A block's windows (strings of ``length`` bytes inside a piece), in runs that share an anchor."""

    def __init__(self, row: dict, length: int = LENGTH, anchor: int = ANCHOR):
        self.data = np.frombuffer(row["data"], np.uint8)
        self.size = np.asarray(row["size"], np.int64)
        self.start = np.cumsum(self.size) - self.size
        short, self.full = names(self.data, length, anchor)
        n = len(self.data)
        order = (short & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        least = sliding_min(order, length - anchor + 1).astype(np.uint32) if n >= length else np.zeros(0, np.uint32)
        edge = np.zeros(n + 1, np.int8)
        long = self.size >= length
        edge[self.start[long]] += 1
        edge[(self.start + self.size - length + 1)[long]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8)[: len(least)] > 0  # where windows start
        same = np.zeros(len(least) + 1, bool)  # the window before has the same anchor
        same[1:-1] = inside[1:] & inside[:-1] & (least[1:] == least[:-1])
        self.lo = np.flatnonzero(inside & ~same[:-1])
        self.count = np.flatnonzero(inside & ~same[1:]) + 1 - self.lo
        self.name = short[least[self.lo]]
        self.doc = np.asarray(row["doc"], np.int64)[np.searchsorted(self.start, self.lo, "right") - 1] if len(self.lo) else np.zeros(0, np.int64)

    def sources(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs over equal bytes: a run of the least document, and that document."""
        a, z = self.full[self.lo], self.full[self.lo + self.count - 1]  # overlap, so they name all of a run's bytes
        name = mix(mix(a, z), self.count.astype(np.uint64))
        order = np.argsort(name, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]])) if len(order) else order
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        least = np.minimum.reduceat(self.doc[order], first) if len(order) else self.doc
        head = np.flatnonzero(self.doc[order] == least[group])
        head = order[head[np.concatenate([[True], group[head][1:] != group[head][:-1]])]] if len(order) else order
        source = np.empty(len(order), np.int64)
        source[order] = head[group]
        return source, self.doc[source]


def anchor_keys(name: np.ndarray, n: int) -> np.ndarray:
    """Bucket and 32 bits of the name; equal keys of different names only keep a few unique strings in."""
    return ((name >> np.uint64(32)) % np.uint64(n)) << np.uint64(32) | (name & np.uint64(0xFFFFFFFF))


def distinct_anchors(block: Block, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, whether two documents of the block have it, and each run's index in them."""
    key = anchor_keys(block.name, n)
    kinds, of = np.unique(key, return_inverse=True)
    some = np.empty(len(kinds), np.int64)
    some[of] = block.doc
    many = np.zeros(len(kinds), bool)
    many[of[block.doc != some[of]]] = True
    return kinds, many, of


def slices(key: np.ndarray):
    """(bucket, slice) of sorted keys."""
    bucket = (key >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(key) else np.zeros(0, int)
    for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(key)).tolist()):
        yield int(bucket[lo]), slice(lo, hi)


# -------------------------------------------------------------------- the passes


def rank_anchors(part: pd.DataFrame) -> pd.DataFrame:
    """A bucket's anchors from all blocks: for each block, which of its anchors other documents have too."""
    got = [unsqueeze(b, "<u4", np.uint8) for b in part.blob]
    value = np.concatenate([v for v, _ in got])
    many = np.concatenate([np.unpackbits(m, count=len(v)) for v, m in got])
    kinds, of, count = np.unique(value, return_inverse=True, return_counts=True)
    shared = count > 1
    shared[of[many > 0]] = True
    alive = np.split(shared[of], np.cumsum([len(v) for v, _ in got])[:-1])
    some = [a.any() for a in alive]
    return pd.DataFrame({"block": part.block[some], "bucket": part.bucket[some], "blob": [np.packbits(a).tobytes() for a, s in zip(alive, some) if s]})


def equal_strings(name: np.ndarray, data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows ordered so that equal ones lie together, and where a new one begins.

    Names only bring equal windows together; the bytes themselves are compared, and order those that share a name.
    """
    order = np.argsort(name, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = name[order][1:] != name[order][:-1]
    same = np.flatnonzero(~new)
    a, b = at[order[same - 1]], at[order[same]]
    for lo in range(0, len(same), STRETCH):
        part = slice(lo, lo + STRETCH)
        differ = np.zeros(len(same[part]), bool)
        for k in range(length):
            differ |= data[a[part] + k] != data[b[part] + k]
        if differ.any():  # two strings of one name
            window = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[at]).view(f"V{length}").ravel()
            kinds = np.unique(window, return_inverse=True)[1]
            order = np.lexsort((kinds, name))
            new[1:] = kinds[order][1:] != kinds[order][:-1]
            break
    return order, new


def rank_strings(length: int):
    def ranked(part: pd.DataFrame) -> pd.DataFrame:
        """A bucket's surviving strings: for each block, the runs' windows that start in a smaller document."""
        got = [unsqueeze(b, "<u4", "<i8", np.uint8, np.uint8) for b in part.blob]
        count = np.concatenate([c for _, _, c, _ in got]).astype(np.int64)
        doc = np.concatenate([d for _, d, _, _ in got])
        data = np.concatenate([x for _, _, _, x in got])
        size = count + length - 1
        start = np.cumsum(size) - size
        at = stretches(start, count)
        name, own = names(data, length, ANCHOR)[1][at], np.repeat(doc, count)
        order, new = equal_strings(name, data, at, length)
        least = np.minimum.reduceat(own[order], np.flatnonzero(new))
        covered = np.empty(len(order), bool)
        covered[order] = own[order] > least[np.cumsum(new) - 1]
        out, run, window = [], 0, 0
        for block, bucket, (index, _, c, _) in zip(part.block, part.bucket, got):
            n = int(c.sum(dtype=np.int64))
            bits = covered[window : window + n]
            if bits.any():
                out.append((block, bucket, squeeze(index, c, np.packbits(bits))))
            run, window = run + len(index), window + n
        return pd.DataFrame(out, columns=["block", "bucket", "blob"]).astype({"block": "int64", "bucket": "int32"})

    return ranked


def cut_blocks(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, with_kept: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Per piece of a document row, and apart (if there are any) from blocks with pieces of long documents: rid, doc_id, th, off, last, n_bytes, n_removed, n_spans, head, tail, kept, kept_sha256.

    ``head``/``tail`` tell whether the piece's first and last byte are removed.  ``kept`` is null for whole
    documents unless ``with_kept``.
    """
    more = {"extra": "string"} if "extra" in docs.columns else {}
    blocks = pack(pick(docs, doc_id="long", text="string", **more).withColumn("train", F.lit(False)), "suffix", block_bytes, length - 1, length - 1)
    n = buckets(blocks)
    fields = blocks.select("block", "doc", "size", "data")

    def send_anchors(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, length)
                kinds, many, _ = distinct_anchors(block, n)
                cut = list(slices(kinds))
                yield blob_rows(row["block"], [b for b, _ in cut], [squeeze((kinds[s] & np.uint64(0xFFFFFFFF)).astype("<u4"), np.packbits(many[s])) for _, s in cut])

    shared = fields.mapInArrow(send_anchors, BLOBS).groupBy("bucket").applyInPandas(rank_anchors, BLOBS)

    def send_strings(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if not row["side0"]:
                    continue
                block = Block(row, length)
                kinds, many, of = distinct_anchors(block, n)
                cut, alive = dict(slices(kinds)), np.zeros(len(kinds), bool)
                for side in row["side0"]:
                    s = cut[side["bucket"]]
                    alive[s] = np.unpackbits(np.frombuffer(side["blob"], np.uint8), count=s.stop - s.start) > 0
                source, _ = block.sources()
                sent = np.flatnonzero(alive[of] & (source == np.arange(len(source))))
                bucket = (block.name[sent] >> np.uint64(20)) % np.uint64(n)
                sent = sent[np.argsort(bucket, kind="stable")]
                bucket = np.sort(bucket).astype(np.int64)
                edges = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(sent) else np.zeros(0, int)
                blobs = []
                for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(sent)).tolist()):
                    runs = sent[lo:hi]
                    at = stretches(block.lo[runs], block.count[runs] + length - 1)
                    blobs.append(squeeze(runs.astype("<u4"), block.doc[runs], block.count[runs].astype(np.uint8), block.data[at]))
                yield blob_rows(row["block"], bucket[edges], blobs)
        give_back()

    strings = beside(fields, shared).mapInArrow(send_strings, BLOBS)
    covered = strings.groupBy("bucket").applyInPandas(rank_strings(length), BLOBS)

    def cut(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.bool_()] + [pa.int64()] * 3 + [pa.bool_()] * 2 + [pa.binary(), pa.string()] + [pa.string()] * len(more)
        names_ = ["rid", "doc_id", "th", "off", "last", "n_bytes", "n_removed", "n_spans", "head", "tail", "kept", "kept_sha256", *more]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, length)
                gone = removed_bytes(block, row["side0"] or [], length)
                out = []
                for i, at in enumerate(block.start.tolist()):
                    lo = at + row["skip"][i]
                    hi = lo + row["own"][i]
                    mask = gone[lo:hi]
                    kept = block.data[lo:hi][~mask].tobytes()
                    whole = row["last"][i] and row["off"][i] == 0
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if hi > lo else 0
                    doc = row["doc"][i]
                    out.append((row["rid"][i], None if doc == NO_ID else doc, row["th"][i], row["off"][i], row["last"][i], hi - lo, int(mask.sum()), spans, bool(hi > lo and mask[0]), bool(hi > lo and mask[-1]),
                                kept if with_kept or not whole else None, hashlib.sha256(kept).hexdigest() if whole else None, *[row[m][i] for m in more]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names_)
        give_back()

    fields = blocks.select("block", "rid", "doc", "th", "off", "skip", "own", "size", "last", *more, "data")
    shape = "rid long, doc_id long, th long, off long, last boolean, n_bytes long, n_removed long, n_spans long, head boolean, tail boolean, kept binary, kept_sha256 string" + "".join(f", {m} {t}" for m, t in more.items())
    long = F.exists("off", lambda x: x > 0) | F.exists("last", lambda x: ~x)
    some = blocks.select("off", "last").filter(long).head(1)
    return beside(fields, covered).mapInArrow(cut, shape), beside(fields.filter(long), covered).mapInArrow(cut, shape) if some else None


def stretches(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions lo, lo + 1, ... of stretches."""
    return np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)


def removed_bytes(block: Block, sides: list[dict], length: int) -> np.ndarray:
    """Which bytes of a block are covered, from what the buckets found for its runs."""
    source, doc = block.sources()
    edge = np.zeros(len(block.data) + 1, np.int32)
    later = block.doc > doc  # equal bytes in a smaller document of the block
    edge[block.lo[later]] += 1
    edge[(block.lo + block.count + length - 1)[later]] -= 1
    if sides:
        got = [unsqueeze(side["blob"], "<u4", np.uint8, np.uint8) for side in sides]
        index = np.concatenate([i for i, _, _ in got]).astype(np.int64)
        count = np.concatenate([c for _, c, _ in got]).astype(np.int64)
        bits = np.concatenate([np.unpackbits(x, count=int(c.sum(dtype=np.int64))) for _, c, x in got])
        starts = np.zeros(len(block.data), bool)
        starts[stretches(block.lo[index], count)] = bits
        known = np.zeros(len(source), bool)
        known[index] = True
        twins = np.flatnonzero((source != np.arange(len(source))) & ~later & known[source])
        if len(twins):  # the same bytes again in the same document: as at their source
            starts[stretches(block.lo[twins], block.count[twins])] = starts[stretches(block.lo[source[twins]], block.count[twins])]
        at = np.flatnonzero(starts)
        edge[at] += 1
        edge[at + length] -= 1
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def dedup(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, with_kept: bool = True) -> DataFrame:
    """Per document row, with ``extra`` if docs has it: rid, doc_id, th, n_bytes, n_removed, n_spans, kept (bytes; null if not wanted), kept_sha256."""
    pieces, long = cut_blocks(docs, length, block_bytes, with_kept)
    more = ["extra"] if "extra" in pieces.columns else []
    names_ = ["rid", "doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", *more]
    whole = F.col("last") & (F.col("off") == 0)

    def together(part: pd.DataFrame) -> pd.DataFrame:
        """One long document's pieces."""
        part = part.sort_values("off")
        kept = b"".join(part.kept)
        over = int((part["head"].to_numpy()[1:] & part["tail"].to_numpy()[:-1]).sum())  # spans that go on in the next piece
        return pd.DataFrame({"rid": part.rid[:1], "doc_id": part.doc_id[:1], "th": part.th[:1], "n_bytes": [part.n_bytes.sum()], "n_removed": [part.n_removed.sum()],
                             "n_spans": [part.n_spans.sum() - over], "kept": [kept if with_kept else None], "kept_sha256": [hashlib.sha256(kept).hexdigest()], **{m: part[m][:1].to_numpy(object) for m in more}})

    done = pieces.filter(whole).select(*names_)
    if long is None:
        return done
    split = long.filter(~whole).groupBy("rid").applyInPandas(together, "rid long, doc_id long, th long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string" + "".join(f", {m} string" for m in more))
    return done.unionByName(split)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op9."""
    return dedup(read(spark, sf_dir, "documents"), with_kept=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
