"""SimHash near-duplicates: exact comparison in tiles, and connected components of the links.

Fingerprints are made once per document, then only distinct ones are compared.  They are sorted by
population count (of the whole, then of its quarters) and cut into tiles; two tiles are compared only if
their population counts come within the radius, since fingerprints at d differing bits differ by at most d in
population count.  Within a pair of tiles the same rule on the quarters' counts skips smaller blocks; what is
left is compared by exclusive-or and bit counts.  A pair of tiles yields a star for each component of its
links, which joins the same fingerprints as all links do, so a large group costs no pairs.

Null text counts as empty: no words, fingerprint zero, linked like any other.  A null doc_id sorts after all
ids (a component of such rows only has a null id).  Repeated rows each get their row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import documents, hot_key_join, partitions, read, saved, text_key

SHINGLE = 3
DISTANCE = 3
SEED = 42
TILE = 16_384
BLOCK = 256
#: Of component edges.
ROWS_A_FILE = 500_000


# ----------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority vote over the XXH64 of word shingles, repeats included."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:z], SEED) for a, z in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(h), 65_536):
        votes += np.unpackbits(h[k : k + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th (hash of the text), fp (as a signed long)."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "th", "fp"])

    return documents(docs).select("doc_id", text_key().alias("th"), "text").mapInArrow(rows, "doc_id long, th long, fp long")


# ------------------------------------------------------------------------ tiles


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def forest_of(left: np.ndarray, right: np.ndarray | None, distance: int) -> np.ndarray:
    """What the links between two tiles of distinct fingerprints (or within one) join: (member, least member) rows."""
    both = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))

    def boxes(fp):
        q = _quarters(fp)
        at = np.arange(0, len(fp), BLOCK)
        return np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)

    (llo, lhi), (rlo, rhi) = boxes(left), boxes(other)
    label = np.arange(len(both))
    for i in range(len(llo)):
        # population counts of the quarters: how far apart they are at least, summed
        gap = np.maximum(0, np.maximum(rlo - lhi[i], llo[i] - rhi)).sum(1)
        a = left[i * BLOCK : (i + 1) * BLOCK]
        for j in np.flatnonzero(gap <= distance):
            if right is None and j < i:
                continue
            near = np.bitwise_count(a[:, None] ^ other[None, j * BLOCK : (j + 1) * BLOCK]) <= distance
            if right is None and j == i:
                near &= np.tri(len(a), near.shape[1], -1, bool).T
            x, y = np.nonzero(near)
            x, y = x + i * BLOCK, y + j * BLOCK + shift
            while len(x):
                new = label[x] != label[y]  # links inside a tree add nothing
                x, y = x[new], y[new]
                if len(x):
                    u, v = label[x[0]], label[y[0]]
                    label[label == max(u, v)] = min(u, v)
    member = np.flatnonzero(label != np.arange(len(both)))
    return np.stack([member, label[member]], 1)


def tiles_of(distinct: DataFrame, tile: int) -> DataFrame:
    """Rows (no, lo, hi, fps): fingerprints in order of population count, cut into tiles; lo and hi bound the counts."""
    n = max(1, distinct.count())
    order = ["pop", "q", "fp"]
    q = [F.bit_count(F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(0xFFFF))) for s in (0, 16, 32)]
    keyed = distinct.select("fp", F.bit_count("fp").alias("pop"), (q[0] * 10_000 + q[1] * 100 + q[2]).alias("q"))
    parts = keyed.repartitionByRange(max(1, -(-n // tile)), *order).sortWithinPartitions(*order)

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq, held = TaskContext.get().partitionId(), 0, np.zeros(0, np.uint64)
        names = ["no", "lo", "hi", "fps"]

        def row(fps):
            pop = np.bitwise_count(fps)
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + seq]), pa.array([int(pop.min())]), pa.array([int(pop.max())]), pa.array([fps.tobytes()], pa.binary())], names=names)

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)])
            while len(held) >= 2 * tile:
                yield row(held[:tile])
                held, seq = held[tile:], seq + 1
        if len(held):
            yield row(held)

    return saved(parts.select("fp").mapInArrow(cut, "no long, lo long, hi long, fps binary"), "tiles")


def links(distinct: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """Stars (a, b) of what is linked among distinct fingerprints, pair of tiles by pair of tiles."""
    tiles = tiles_of(distinct, tile)
    spark = tiles.sparkSession
    # each population count that a tile spans, give or take the radius, meets the tiles that span that count
    spans = tiles.select("no", "lo", "hi")
    wide = spans.select(F.col("no").alias("a"), F.explode(F.sequence(F.col("lo") - distance, F.col("hi") + distance)).alias("pop"))
    own = spans.select(F.col("no").alias("b"), F.explode(F.sequence("lo", "hi")).alias("pop"))
    pairs = wide.join(own, "pop").filter("a <= b").select("a", "b").distinct()
    left = tiles.select(F.col("no").alias("a"), F.col("fps").alias("left"))
    right = tiles.select(F.col("no").alias("b"), F.col("fps").alias("right"))
    met = pairs.join(left, "a").join(right, "b").repartition(max(partitions(spark), 24), "a", "b")

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, x, y in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "left", "right")]):
                x, y = np.frombuffer(x, np.uint64), None if a == b else np.frombuffer(y, np.uint64)
                both = (x if y is None else np.concatenate([x, y])).view(np.int64)
                found = forest_of(x, y, distance)
                yield pa.RecordBatch.from_arrays([pa.array(both[found[:, 0]]), pa.array(both[found[:, 1]])], names=["a", "b"])

    return met.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


# ------------------------------------------------------------------- components


def _flat(edges: DataFrame, rows: int) -> DataFrame:
    """Written in files of a useful size, whatever the number of shuffle partitions."""
    return saved(edges.distinct().coalesce(1 + rows // ROWS_A_FILE), "edges")


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of ``edges`` (a, b) with the least node of its component, by alternating large and small stars.

    A large star points a node's larger neighbours to the least node around; a small star does so for the
    node's smaller neighbours.  Both leave fewer, flatter edges until every node points to its component's
    least node.  The joins read written tables on both sides, so that Spark splits a node with very many
    neighbours.
    """
    edges = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    sign = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = sign(edges)
    while True:
        before, rows = now, now[0]
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).coalesce(1 + rows // ROWS_A_FILE), "stars")
        large = _flat(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), rows)
        down = saved(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(1 + rows // ROWS_A_FILE), "stars")
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = _flat(small.unionByName(down.select("a", F.col("m").alias("b"))), rows)
        now = sign(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Per document row: doc_id, th, fp, component_id (least doc_id reachable), keeps (whether the row is its component's first)."""
    rows = saved(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")
    groups = saved(rows.groupBy("fp").agg(first, F.count("*").alias("n")), "groups")
    roots = saved(components(links(groups.select("fp"), distance, tile)), "roots")
    total = max(1, groups.count())
    led = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    led = saved(led, "led")
    best = saved(led.groupBy("root").agg(F.min("first").alias("best"), F.count("*").alias("members")), "best")
    each = saved(hot_key_join(led, best, "root", "members", total).select("fp", "n", "best"), "classes")
    out = hot_key_join(rows, each, "fp", "n", max(1, rows.count()))
    keeps = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    return out.select("doc_id", "th", "fp", F.col("best.doc_id").alias("component_id"), keeps.alias("keeps"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op6."""
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
