"""Ranked lexical search: exact sparse inner products by best-first descent through ball trees.

Documents and items are sparse vectors over the items' terms (other terms cannot add to a score).  Documents lie in
chunks of CHUNK_DOCS; a chunk's ball tree halves them along the line between two distant ones.  A node has its
documents' centroid, the ball's radius, and the radius of every term by itself (how far a document exceeds the
centroid there).  Two bounds follow, of which the lesser holds: query times centroid plus query norm times radius,
and query times centroid plus term radii.  Centroids are stored first and radii measured from what was stored, all
rounded up, and sums get a margin far above their rounding error, so no bound is ever too small.

A query opens the nodes of a tree by falling bound and stops where the bound is below its kth score; leaves are
scored in 64-bit integers.  While the trees are built each query scores its most promising leaf of every tree; the
kth of all these scores is where the search begins, so most trees are left at or near their roots.  Queries come
in batches of bounded bytes, each with a vocabulary of its own; trees never move.

Null text has no terms.  Null doc_ids are documents like others and come last among equals; repeated rows are
documents, and items, of their own; an item without terms gets no rows, nor does any item where no document has
terms; texts of any length go whole; equal scores go by doc_id; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planmatch.llm.common import NO_ID, documents, pick, read, saved, squeeze, unsqueeze

K = 10
CHUNK_DOCS, CHUNK_POSTINGS, LEAF_DOCS = 4096, 1 << 20, 32
BATCH_ITEMS, BATCH_BYTES = 4096, 8 << 20
SKETCH = 64
#: Far above the relative rounding error of a sum of doubles.
MARGIN = 1 + 1e-9
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: maximal runs of ASCII letters and digits and of all other characters, A-Z lower-cased."""
    return raw.translate(_TABLE).split(b" ") if raw else []


def term_counts(raw: bytes) -> dict[bytes, int]:
    from collections import Counter

    counts = Counter(terms(raw))
    counts.pop(b"", None)
    return counts


# ------------------------------------------------------------------- document vectors


CHUNKS = "no long, docs long, terms long, own array<int>, df array<int>, blob binary"


def chunks_of(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Chunks of documents: how many have terms and how many terms there are, document frequencies, and term counts."""
    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"))

    def vectors(batches):
        import pyarrow as pa

        task, seq, find = TaskContext.get().partitionId(), 0, vocabulary.get
        ids, lengths, sizes, term, tf, n_docs, n_terms = [], [], [], [], [], 0, 0

        def row():
            own, df = np.unique(np.array(term, np.int32), return_counts=True)
            blob = squeeze(np.array(ids, "<i8"), np.array(lengths, "<i8"), np.array(sizes, "<i4"), np.array(term, "<i4"), np.array(tf, "<i4"))
            return pa.RecordBatch.from_arrays([pa.array([(task << 24) + seq], pa.int64()), pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()),
                                               pa.array([own], pa.list_(pa.int32())), pa.array([df], pa.list_(pa.int32())), pa.array([blob], pa.binary())],
                                              names=["no", "docs", "terms", "own", "df", "blob"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(raw.as_py() or b"")
                n = sum(counts.values())
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                known = [(t, c) for w, c in counts.items() if (t := find(w)) is not None]
                if known:
                    known.sort()
                    ids.append(NO_ID if doc is None else doc)
                    lengths.append(n)
                    sizes.append(len(known))
                    term += [t for t, _ in known]
                    tf += [c for _, c in known]
                if len(ids) == CHUNK_DOCS or len(term) >= CHUNK_POSTINGS:
                    yield row()
                    ids, lengths, sizes, term, tf, n_docs, n_terms, seq = [], [], [], [], [], 0, 0, seq + 1
        if n_docs:
            yield row()

    return rows.mapInArrow(vectors, CHUNKS)


# --------------------------------------------------------------------------- the tree


class BallTree:
    """Documents in the order of the leaves, and the nodes level by level, as flat arrays.

    ids, ptr, term, x: documents and their vectors.  lo, hi: each node's documents; node n has the children 2n+1
    and 2n+2 if ``hi - lo`` is over a leaf's size.  The nodes' centroids are kept by term: for term ``terms[i]``,
    entries ``at[i]`` to ``at[i + 1]`` of node, centre, spread (the term's radius).
    """

    KINDS = ("<i8", "<i8", "<i4", "<i8", "<i4", "<i4", "<f8", "<i4", "<i8", "<i4", "<f4", "<f4")

    def __init__(self, *arrays: np.ndarray):
        self.arrays = arrays
        self.ids, self.ptr, self.term, self.x, self.lo, self.hi, self.radius, self.terms, self.at, self.node, self.centre, self.spread = arrays

    @classmethod
    def build(cls, ids, ptr, term, x, weight, leaf_docs: int = LEAF_DOCS) -> BallTree:
        n = len(ids)
        doc = np.repeat(np.arange(n), np.diff(ptr))
        # a sketch of the weighted vectors decides only who lies near whom
        mixed = term.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        sign = 1.0 - 2.0 * ((mixed >> np.uint64(20)) & np.uint64(1)).astype(np.float64)
        cell = doc * SKETCH + (mixed >> np.uint64(58)).astype(np.int64) % SKETCH
        sketch = np.bincount(cell, sign * x * weight[term], n * SKETCH).reshape(n, SKETCH)

        order, lo, hi, level = np.arange(n), [0], [n], [(0, 0, n)]
        levels = []
        while level:
            levels.append([node for node, _, _ in level])
            below = []
            for node, a, z in level:
                if z - a > leaf_docs:
                    own = order[a:z]
                    near = sketch[own]
                    one = near[np.argmax(((near - near.mean(0)) ** 2).sum(1))]
                    two = near[np.argmax(((near - one) ** 2).sum(1))]
                    order[a:z] = own[np.argsort(near @ (two - one), kind="stable")]
                    mid = (a + z) // 2
                    below += [(2 * node + 1, a, mid), (2 * node + 2, mid, z)]
            for node, a, z in below:
                lo += [0] * (node + 1 - len(lo))
                hi += [0] * (node + 1 - len(hi))
                lo[node], hi[node] = a, z
            level = below
        lo, hi = np.array(lo, np.int32), np.array(hi, np.int32)

        size = np.diff(ptr)[order]
        first = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(ptr[:-1][order] - first[:-1], size) + np.arange(first[-1])
        ids, ptr, term, x = ids[order], first, term[take], x[take]
        doc, value = np.repeat(np.arange(n), size), x.astype(np.float64)
        radius, parts = np.zeros(len(lo)), []
        for nodes in levels:
            nodes = np.array(nodes)
            nodes = nodes[np.argsort(lo[nodes])]
            of = np.full(n, -1)  # which of this level's nodes has the document; a shallower leaf's has none
            for k, node in enumerate(nodes):
                of[lo[node] : hi[node]] = k
            here = of[doc] >= 0
            key = of[doc[here]] * np.int64(1 << 32) + term[here]
            keys, inverse = np.unique(key, return_inverse=True)
            k, t = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32)
            count = (hi - lo)[nodes]
            centre = (np.bincount(inverse, value[here]) / count[k]).astype(np.float32)
            most = np.zeros(len(keys))
            np.maximum.at(most, inverse, value[here])
            c = centre.astype(np.float64)
            spread = np.nextafter((np.maximum(most - c, 0) * MARGIN).astype(np.float32), np.float32(np.inf))
            # squared distance: all of the centroid, corrected at the document's own terms
            whole = np.bincount(k, c * c, len(nodes))
            own = np.bincount(doc[here], (value[here] - c[inverse]) ** 2 - c[inverse] ** 2, n)
            slack = np.bincount(doc[here], value[here] ** 2 + c[inverse] ** 2, n)
            ok = of >= 0
            far = np.zeros(len(nodes))
            np.maximum.at(far, of[ok], np.maximum(own[ok] + whole[of[ok]], 0) + 1e-12 * (slack[ok] + whole[of[ok]]))
            radius[nodes] = np.sqrt(far) * MARGIN
            parts.append((nodes[k].astype(np.int32), t, centre, spread))
        node, t, centre, spread = (np.concatenate(p) for p in zip(*parts))
        by = np.argsort(t, kind="stable")
        own, count = np.unique(t, return_counts=True)
        at = np.concatenate([[0], np.cumsum(count)])
        return cls(ids, ptr, term, x, lo, hi, radius, own.astype(np.int32), at, node[by], centre[by], spread[by])

    def to_bytes(self) -> bytes:
        return squeeze(*[np.ascontiguousarray(a, k) for a, k in zip(self.arrays, self.KINDS)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> BallTree:
        return cls(*unsqueeze(raw, *cls.KINDS))

    def bounds(self, query: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """At least the greatest score in each node, for ascending query terms and their weights."""
        i = np.searchsorted(self.terms, query)
        hit = np.flatnonzero((i < len(self.terms)) & (self.terms[np.minimum(i, len(self.terms) - 1)] == query))
        if not len(hit):
            return np.zeros(len(self.lo))
        i = i[hit]
        size = self.at[i + 1] - self.at[i]
        take = np.repeat(self.at[i] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        w, node = np.repeat(weights[hit].astype(np.float64), size), self.node[take]
        centre = np.bincount(node, w * self.centre[take], len(self.lo))
        spread = np.bincount(node, w * self.spread[take], len(self.lo))
        norm = math.sqrt(float((weights.astype(np.float64) ** 2).sum())) * MARGIN
        return (centre + np.minimum(spread, norm * self.radius)) * MARGIN

    def scores(self, leaf: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and exact scores of a leaf's documents; ``dense`` has the query's weight of every term."""
        a, z = self.lo[leaf], self.hi[leaf]
        p = self.ptr[a : z + 1]
        return self.ids[a:z], np.add.reduceat(dense[self.term[p[0] : p[-1]]] * self.x[p[0] : p[-1]], p[:-1] - p[0])

    def search(self, query: np.ndarray, weights: np.ndarray, dense: np.ndarray, k: int, least: int = 1, leaves: int | None = None) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id) of ``least`` and more, ties to the smaller id; and how many leaves were scored.

        With ``leaves`` the search ends after so many.
        """
        bound = self.bounds(query, weights)
        best: list[tuple[int, int]] = []  # a heap of (score, -id): its top is the kth
        todo, scored = [(-bound[0], 0)], 0
        while todo and scored != leaves:
            top, node = heapq.heappop(todo)
            if -top < least:
                break
            if 2 * node + 2 < len(self.lo) and self.hi[2 * node + 2] > 0:
                for child in (2 * node + 1, 2 * node + 2):
                    if bound[child] >= least:
                        heapq.heappush(todo, (-bound[child], child))
                continue
            scored += 1
            ids, scores = self.scores(node, dense)
            for i in np.flatnonzero(scores >= least).tolist():
                found = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in best], scored


# -------------------------------------------------------------------------------- jobs


class Queries:
    """A batch's items over its vocabulary: (row, ascending terms, weights)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weight: np.ndarray):
        self.items = [(row, own, weight[own]) for row, own in items]
        self.weight = weight

    def run(self, tree: BallTree, k: int, least=None, leaves: int | None = None):
        """(row, score, id) of each query's best in the tree, and the leaves scored."""
        out, scored, dense = [], 0, np.zeros(len(self.weight), np.int64)
        for row, own, weights in self.items:
            dense[own] = weights
            found, n = tree.search(own, weights, dense, k, (least or {}).get(row, 1), leaves)
            dense[own] = 0
            out += [(row, s, i) for s, i in found]
            scored += n
        return out, scored


def trees_of(chunks: DataFrame, queries: Queries, n_docs: int, n_terms: int, k: int, leaf_docs: int) -> DataFrame:
    """A ball tree for each chunk, and what the queries' first leaves hold (row, score)."""

    def build(batches):
        import pyarrow as pa

        schema = pa.schema([("tree", pa.binary()), ("leaves", pa.int64()), ("seeds", pa.list_(pa.struct([("row", pa.int64()), ("score", pa.int64())])))])
        for batch in batches:
            for blob in batch.column(0):
                ids, lengths, sizes, term, tf = unsqueeze(blob.as_py(), "<i8", "<i8", "<i4", "<i4", "<i4")
                if not len(ids):
                    continue
                m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)  # Python's integers: no overflow
                tf, m = tf.astype(np.int64), np.repeat(m, sizes)
                x = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                tree = BallTree.build(ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), term, x, queries.weight, leaf_docs)
                seeds = [{"row": r, "score": s} for r, s, _ in queries.run(tree, k, leaves=1)[0]]
                leaves = len(ids) and int((tree.hi > tree.lo).sum() + 1) // 2
                yield pa.RecordBatch.from_arrays([pa.array([tree.to_bytes()], pa.binary()), pa.array([leaves], pa.int64()), pa.array([seeds], schema.field(2).type)], schema=schema)

    return chunks.select("blob").mapInArrow(build, "tree binary, leaves long, seeds array<struct<row:long,score:long>>")


def found_in(trees: DataFrame, queries: Queries, least: dict[int, int], k: int) -> DataFrame:
    """row, score, doc_id of each query's best in every tree; with the number of its scored leaves a tree has a null row."""

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column(0):
                out, scored = queries.run(BallTree.from_bytes(raw.as_py()), k, least)
                rows, scores, ids = (list(c) for c in zip(*out, (None, scored, None)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, scores, ids)], names=["row", "score", "doc_id"])

    return trees.select("tree").mapInArrow(search, "row long, score long, doc_id long")


def weights_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def search_batch(docs: DataFrame, items: list[tuple[int, dict]], k: int, leaf_docs: int) -> tuple[DataFrame, dict]:
    """row, score, doc_id of a batch's best in every tree, and how much of the trees was scored."""
    vocabulary: dict[bytes, int] = {}
    vectors = [(row, np.unique([vocabulary.setdefault(w, len(vocabulary)) for w in own]).astype(np.int32)) for row, own in items if own]
    chunks = saved(chunks_of(docs, vocabulary), "ball-chunks")
    n_docs, n_terms = (v or 0 for v in chunks.agg(F.sum("docs"), F.sum("terms")).first())
    df = np.zeros(len(vocabulary), np.int64)
    shares = chunks.select(F.explode(F.arrays_zip("own", "df")).alias("z")).groupBy("z.own").agg(F.sum("z.df").alias("df"))
    for r in shares.collect():  # the batch's vocabulary at most
        df[r["own"]] = r["df"]
    queries = Queries(vectors, weights_of(df, n_docs))
    trees = saved(trees_of(chunks, queries, n_docs, n_terms, k, leaf_docs), "ball-trees")
    seeds = trees.select(F.explode("seeds").alias("s")).select("s.row", "s.score")
    nth = F.row_number().over(W.partitionBy("row").orderBy(F.col("score").desc()))
    least = {r["row"]: r["score"] for r in seeds.withColumn("nth", nth).filter(F.col("nth") <= k).filter(F.col("nth") == k).collect()}  # one a query
    found = saved(found_in(trees, queries, least, k), "ball-found")
    scored = found.filter("row is null").agg(F.sum("score")).first()[0] or 0
    return found.filter("row is not null"), {"scored": scored, "pairs": (trees.agg(F.sum("leaves")).first()[0] or 0) * len(vectors)}


def search(docs: DataFrame, benchmark: DataFrame, k: int = K, leaf_docs: int = LEAF_DOCS, batch_items: int = BATCH_ITEMS, batch_bytes: int = BATCH_BYTES, stats: list | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents.

    ``stats`` receives, for each batch, the (query, leaf) pairs there are and those scored.
    """
    spark = docs.sparkSession
    items = saved(pick(benchmark, item_id="long", text="string").withColumn("row", F.monotonically_increasing_id()), "ball-items")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    batches = max(1, -(-n // batch_items), -(-size // batch_bytes))
    found = None
    for b in range(batches if n else 0):
        own = items.filter(F.pmod(F.xxhash64("row"), F.lit(batches)) == b).select("row", F.col("text").cast("binary").alias("text")).collect()
        rows, told = search_batch(docs, [(r["row"], term_counts(bytes(r["text"] or b""))) for r in own], k, leaf_docs)
        found = rows if found is None else found.unionAll(rows)
        if stats is not None:
            stats.append(told)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.col("score").desc(), "doc_id"))
    best = found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
    return best.join(items.select("row", "item_id"), "row").select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op11."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
