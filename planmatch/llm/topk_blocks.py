"""Exact top-k by inner product with block-at-a-time pruning.

Candidates lie in blocks of successive ids, each with a forward index (its integer vectors), the least and
greatest value of every component, and its centre and radius.  For a query, a block's bound is the lesser of two:
the greatest product that the components' ranges allow, and query times centre plus query norm times radius.
Blocks stay where they are: queries come to them in batches of bounded bytes.  A task takes the blocks of a batch
of rows in order of their bounds and stops for a query once the next bound is below its kth score.  The tasks'
best are then merged.

Vectors that are null, or hold a null or non-finite component, take no part.  Integers of over 26 bits are kept
apart in blocks of their own and scored in Python's integers; a score that does not fit a long is an error.
Vectors of different lengths are compared over the components that both have.  A query's own vec_id is never its
candidate; repeated rows are candidates, and queries, of their own.  Null vec_ids take no part.  Equal scores go
to the smaller vec_id; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planmatch.llm.common import pick, read, saved

K = 5
SCALE = 256
QUERY_EVERY = 50
BLOCK_ROWS = 512
#: Bytes of queries that come to the blocks at once, and queries searched together there.
BATCH_BYTES, SEARCHED = 16 << 20, 1024
MAX_BITS = 26
LONG = 1 << 63


def integers(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component; wide: whether one has over MAX_BITS bits."""
    v = pick(rows, vec_id="long", embedding="array<double>").filter("vec_id is not null and embedding is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    wide = F.exists("embedding", lambda x: F.abs(x) * scale >= float(1 << MAX_BITS))
    whole = lambda x: F.floor(F.when(F.abs(x) * scale < float(LONG), x).otherwise(F.raise_error(F.lit("a component does not fit a long"))) * F.lit(float(scale)))
    return v.filter(~bad).select("vec_id", F.transform("embedding", lambda x: whole(x).cast("long")).alias("v"), F.coalesce(wide, F.lit(False)).alias("wide"))


def _matrix(vectors, kind) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


BLOCK = "wide boolean, width int, ids binary, vectors binary"


def blocks_of(rows: DataFrame, block_rows: int) -> DataFrame:
    """wide, width, ids, vectors (flat): document-range blocks."""
    n = max(1, rows.count())
    ranges = rows.repartitionByRange(max(1, -(-n // (block_rows * 4))), "wide", "vec_id").sortWithinPartitions("wide", "vec_id").select("wide", "vec_id", "v")

    def cut(batches):
        held = pd.DataFrame({"wide": [], "vec_id": [], "v": []})
        for batch in batches:
            held = pd.concat([held, batch]) if len(held) else batch
            while len(held) >= block_rows:
                yield from rows_of(held[:block_rows])
                held = held[block_rows:]
        if len(held):
            yield from rows_of(held)

    def rows_of(held):
        for wide, own in held.groupby("wide"):
            m = _matrix(list(own.v), "<i8" if wide else "<i4")
            yield pd.DataFrame({"wide": [bool(wide)], "width": [m.shape[1]], "ids": [own.vec_id.to_numpy("<i8").tobytes()], "vectors": [m.tobytes()]})

    return ranges.mapInPandas(cut, BLOCK)


def unpack(block) -> tuple[np.ndarray, np.ndarray]:
    """ids and vectors of a block."""
    ids = np.frombuffer(block["ids"], "<i8")
    return ids, np.frombuffer(block["vectors"], "<i8" if block["wide"] else "<i4").reshape(len(ids), block["width"])


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def bounds_of(q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each query and block at least the greatest score; both bounds rounded up."""
    up, down, norm = np.maximum(q, 0), np.minimum(q, 0), np.sqrt((q * q).sum(1)) * (1 + 1e-9)
    out = []
    for _, m in blocks:
        ranges = up @ m.max(0) + down @ m.min(0)  # integers below 2^53: exact
        centre = m.mean(0)
        radius = np.sqrt(((m - centre) ** 2).sum(1).max()) * (1 + 1e-9)
        ball = q @ centre + norm * radius
        ball += 1e-9 * (np.abs(q) @ np.abs(centre)) + 1e-6
        out.append(np.minimum(ranges, ball))
    return np.stack(out, 1)


def search_group(queries: tuple[np.ndarray, np.ndarray], blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[list, int]:
    """(query row, ids, scores) of each query's k best among the blocks; how many (query, block) pairs were scored."""
    qid, q = queries
    width = max([q.shape[1], *[m.shape[1] for _, m in blocks]])
    q, blocks = _fit(q, width).astype(np.float64), [(ids, _fit(m, width).astype(np.float64)) for ids, m in blocks]
    bounds = bounds_of(q, blocks)
    order = np.argsort(-bounds, axis=1, kind="stable")
    top_id = np.full((len(q), k), np.iinfo(np.int64).max)
    top = np.full((len(q), k), -np.inf)
    scored, live = 0, np.arange(len(q))
    for step in range(len(blocks)):
        # a block whose bound is below the kth score cannot matter, and neither can later ones
        live = live[bounds[live, order[live, step]] >= top[live, -1]]
        if not len(live):
            break
        for b in np.unique(order[live, step]):
            own = live[order[live, step] == b]
            ids, m = blocks[b]
            got = q[own] @ m.T
            got[ids[None, :] == qid[own, None]] = -np.inf
            scored += len(own)
            cut = min(k, got.shape[1])
            # all that reach the block's kth score, so that ties go to the smaller id
            floor = np.maximum(np.partition(got, -cut, axis=1)[:, -cut], top[own, -1])
            for i, r in enumerate(own):
                near = np.flatnonzero((got[i] >= floor[i]) & (got[i] > -np.inf))
                if len(near):
                    both, s = np.concatenate([top_id[r], ids[near]]), np.concatenate([top[r], got[i, near]])
                    best = _best(both, s, k)
                    top_id[r], top[r] = both[best], s[best]
    return [(r, top_id[r][top[r] > -np.inf], top[r][top[r] > -np.inf]) for r in range(len(q))], scored


def search_wide(queries: tuple[np.ndarray, np.ndarray], blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> list:
    """The same with Python's integers, without bounds: for vectors of large components."""
    found = []
    for r, (own, q) in enumerate(zip(queries[0], queries[1].tolist())):
        scored = []
        for ids, m in blocks:
            scored += [(sum(a * b for a, b in zip(q, v)), i) for i, v in zip(ids.tolist(), m.tolist()) if i != own]
        best = sorted(scored, key=lambda x: (-x[0], x[1]))[:k]
        found.append((r, [i for _, i in best], [s for s, _ in best]))
    return found


def batches_of(queries: DataFrame, block_rows: int, batch_bytes: int):
    """Batches of packed queries of about ``batch_bytes`` (a block at least), each numbered by its first query."""
    packed = saved(blocks_of(queries, block_rows), "query-blocks")
    sizes = packed.select(F.sum(F.octet_length("vectors"))).first()[0] or 0
    n = max(1, -(-sizes // batch_bytes))
    first = 0
    for b in range(n if sizes else 0):
        got = [r.asDict() for r in packed.filter(F.pmod(F.xxhash64("ids"), F.lit(n)) == b).collect()]
        yield first, got
        first += sum(len(r["ids"]) // 8 for r in got)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS, batch_bytes: int = BATCH_BYTES, stats: list | None = None) -> DataFrame:
    """query_id, rank, vec_id, score from integer vectors (vec_id, v, wide).

    ``stats`` receives, for each batch, the frame's (query, block) pairs and those scored.
    """
    blocks = saved(blocks_of(vectors, block_rows), "vector-blocks")
    spark, found = blocks.sparkSession, None
    for first, held in batches_of(queries, SEARCHED, batch_bytes):

        def search(batches, first=first, held=held):
            from decimal import Decimal

            import pyarrow as pa

            schema = pa.schema([*[(c, pa.int64()) for c in ("query_id", "row", "vec_id", "score")], ("big", pa.decimal128(38, 0))])

            for batch in batches:
                rows = batch.to_pylist()
                narrow, wide = ([unpack(r) for r in rows if r["wide"] is w] for w in (False, True))
                at, out = first, []
                pairs = scored = 0
                for h in held:
                    own = unpack(h)
                    if not h["wide"] and narrow:
                        # a product of 26-bit integers over few enough components is exact in doubles
                        exact = max(np.abs(m).max(initial=0) for _, m in narrow) * int(np.abs(own[1]).max(initial=0)) * own[1].shape[1] < 1 << 53
                        got, n = search_group(own, narrow, k) if exact else (search_wide(own, narrow, k), len(own[0]) * len(narrow))
                        pairs, scored = pairs + len(own[0]) * len(narrow), scored + n
                        out += [(int(own[0][r]), at + int(r), int(i), int(s)) for r, ids, scores in got for i, s in zip(ids, scores)]
                    for blocks_ in ([wide] if not h["wide"] else [narrow, wide]):
                        if blocks_:
                            out += [(int(own[0][r]), at + r, i, s) for r, ids, scores in search_wide(own, blocks_, k) for i, s in zip(ids, scores)]
                    at += len(own[0])
                out.append((None, None, pairs, scored))
                *cols, scores = map(list, zip(*out))
                far = [None if -LONG <= s < LONG else Decimal(s) for s in scores]
                cols += [[s if f is None else None for s, f in zip(scores, far)], far]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        own = saved(blocks.mapInArrow(search, "query_id long, row long, vec_id long, score long, big decimal(38,0)"), "topk-found")
        if stats is not None:
            stats.append(tuple(own.filter("row is null").agg(F.sum("vec_id"), F.sum("score")).first()))
        found = own if found is None else found.unionAll(own)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.coalesce("big", F.col("score").cast("decimal(38,0)")).desc(), "vec_id"))
    best = found.filter("row is not null").withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
    score = F.when(F.col("big").isNull(), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return best.select("query_id", "rank", "vec_id", score.alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op10."""
    rows = integers(read(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter(F.col("vec_id") % QUERY_EVERY == 0))
