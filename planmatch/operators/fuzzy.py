"""Exact best-first fuzzy search over a packed catalog: no pair is ever a row of a plan.

``fuzzy_top_k``   the k best names per text at or above a threshold (ratio, ties by catalog position).
``best_match``    the single best name per text, with no threshold (ratio) or with one (partial ratio).

The catalog's names are packed into shards of at most SHARD_ROWS names: sorted by length, in blocks, with character
counts and codes.  A shard's size is proven before it is collected and broadcast; a larger catalog has several
shards, whose best are merged.  Only the texts move, spread over ``spark.sql.shuffle.partitions``.

A pair's score is bounded by the characters that both sides share (no common subsequence is longer), by the same
floating-point operations as the score, so the bound is never below it.  Each text takes its best-bounded names
first; the bar of its kth score rises, and names bounded below the bar are never scored.  Rounds of falling bounds
go on until no name is left at or above the bar, so the search is exact at every threshold, also with none.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmatch.functions import similarity as S
from planmatch.operators.joins import PLAN_FACTOR, plan_bytes, proven_size

#: Names in one broadcast shard, names in one of its blocks, texts searched together.
SHARD_ROWS, BLOCK_ROWS, BATCH_TEXTS = 200_000, 2048, 128
#: Candidates a text takes in its first round; four times as many in each one after.
FIRST_ROUND = 8


class NameIndex:
    """Names in order of position, packed for search.  ``search`` gives row numbers in that order."""

    def __init__(self, names: list):
        points, _, length = S.flat_codes(names)
        self.names, self.alphabet = names, np.unique(points)
        self.blocks = []
        by_length = np.argsort(length, kind="stable")
        for k in range(0, len(names), BLOCK_ROWS):
            rows = by_length[k : k + BLOCK_ROWS]
            own = [names[r] for r in rows]
            points, first, size = S.flat_codes(own)
            self.blocks.append((rows, S.char_counts(own), np.searchsorted(self.alphabet, points), first, size))

    def search(self, texts: list, k: int, floor: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        """(text, row, score) of each text's k best at or above ``floor``, ties to the lower row; and the pairs bounded and scored."""
        n = len(texts)
        stats = {"pairs": n * len(self.names), "bounded": 0, "scored": 0}
        best_score = np.full((n, k), -np.inf)
        best_row = np.full((n, k), np.iinfo(np.int64).max)
        has, la = S.char_counts(texts), np.fromiter(map(len, texts), np.int64, n)
        masks = S.bit_masks(texts, self.alphabet)
        # nearest lengths first: the bar rises early
        mean = la.mean() if n else 0
        for rows, holds, codes, first, size in sorted(self.blocks, key=lambda b: abs(b[4].mean() - mean)):
            bar = self._bar(best_score, floor)
            # the least and greatest length of the block bound every pair: whole blocks are left out by length
            nearest = np.clip(la, size[0], size[-1])
            live = np.flatnonzero(S.scores_of(la + nearest, np.minimum(la, nearest)) >= bar)
            if not len(live):
                continue
            shared = np.zeros((len(live), len(rows)), np.int16)
            for c in range(holds.shape[1]):
                shared += np.minimum(has[live, c][:, None], holds[:, c][None, :])
            bound = S.scores_of(la[live][:, None] + size[None, :], shared)
            stats["bounded"] += bound.size
            take = FIRST_ROUND
            while True:
                bound[bound < self._bar(best_score[live], floor)[:, None]] = -1.0
                open_ = np.flatnonzero((bound >= 0).any(1))
                if not len(open_):
                    break
                some = bound[open_]
                if take < some.shape[1]:
                    top = np.argpartition(-some, take - 1, axis=1)[:, :take]
                    at = np.repeat(np.arange(len(open_)), take)
                    col = top.ravel()
                    keep = some[at, col] >= 0
                    at, col = open_[at[keep]], col[keep]
                else:
                    at, col = np.nonzero(some >= 0)
                    at = open_[at]
                bound[at, col] = -1.0
                take *= 4
                stats["scored"] += len(at)
                self._merge(live[at], rows[col], self._scores(texts, masks, la, live[at], rows[col], codes, first[col], size[col]), best_score, best_row, floor)
        t, j = np.nonzero(best_score > -np.inf)
        return t, best_row[t, j], best_score[t, j], stats

    @staticmethod
    def _bar(best_score: np.ndarray, floor: float | None) -> np.ndarray:
        bar = best_score[:, -1]
        return np.maximum(bar, 0.0 if floor is None else floor)

    def _scores(self, texts, masks, la, t, row, codes, first, size) -> np.ndarray:
        lcs = np.zeros(len(t), np.int64)
        wide = la[t] > S.WORD
        for i in np.flatnonzero(wide):
            lcs[i] = S.lcs_length(texts[t[i]], self.names[row[i]])
        sel = np.flatnonzero(~wide)
        if len(sel):
            lcs[sel] = S.lcs_masked(masks, t[sel], la[t[sel]], codes, first[sel], size[sel])
        return S.scores_of(la[t] + size, lcs)

    @staticmethod
    def _merge(t, row, score, best_score, best_row, floor) -> None:
        if floor is not None:
            t, row, score = (x[score >= floor] for x in (t, row, score))
        touched = np.unique(t)
        k = best_score.shape[1]
        t = np.concatenate([t, np.repeat(touched, k)])
        score = np.concatenate([score, best_score[touched].ravel()])
        row = np.concatenate([row, best_row[touched].ravel()])
        order = np.lexsort((row, -score, t))
        t, score, row = t[order], score[order], row[order]
        start = np.flatnonzero(np.diff(t, prepend=-1))
        nth = np.arange(len(t)) - np.repeat(start, np.diff(start, append=len(t)))
        top = nth < k
        best_score[t[top], nth[top]], best_row[t[top], nth[top]] = score[top], row[top]


def _shards(refs: DataFrame, name_col: str, pos_col: str, id_col: str) -> list[pd.DataFrame]:
    """The catalog's (id, name) in order of position, in shards of a proven number of rows."""
    spark = refs.sparkSession
    cols = list(dict.fromkeys([id_col, name_col, pos_col]))
    small = refs.select(*cols).filter(F.col(name_col).isNotNull())
    known = plan_bytes(small)
    # files so small hold no more names than a shard, whatever is in them; others are counted
    rows = 0 if known is not None and known * PLAN_FACTOR <= SHARD_ROWS else proven_size(small)[0]
    n = max(1, math.ceil(rows / SHARD_ROWS))
    parts = [small] if n == 1 else [small.filter(F.pmod(F.xxhash64(id_col), F.lit(n)) == i) for i in range(n)]
    return [p.toPandas().sort_values([pos_col, id_col], kind="stable").reset_index(drop=True) for p in parts]


def scoring_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _searched(texts: DataFrame, text_col: str, found, pos_type: T.DataType, id_type: T.DataType, index) -> DataFrame:
    """Runs ``found(index, texts) -> (text, row, score)`` over all texts; FOUND_ID, FOUND_POS and SCORE of what it finds."""
    spark = texts.sparkSession
    held = spark.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField(text_col, T.StringType()), T.StructField("FOUND_ID", id_type), T.StructField("FOUND_POS", pos_type), T.StructField("SCORE", T.DoubleType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        packed, ids, positions = held.value
        arrow = to_arrow_schema(schema)
        for batch in batches:
            own = sorted(batch.column(0).to_pylist(), key=len)
            for k in range(0, len(own), BATCH_TEXTS):
                some = own[k : k + BATCH_TEXTS]
                t, row, score = found(packed, some)
                columns = ([some[i] for i in t], [ids[i] for i in row], [positions[i] for i in row], score)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # few bytes but much work: an explicit number of partitions, which AQE does not fold into one
    spread = texts.select(text_col).filter(F.col(text_col).isNotNull()).repartition(scoring_partitions(spark), F.xxhash64(text_col))
    return spread.mapInArrow(run, schema)


def _search(texts, refs, text_col, name_col, pos_col, id_col, pack, found, k) -> DataFrame:
    """The best of all shards, ranked: ``text_col``, FOUND_ID, FOUND_POS, SCORE, RANK."""
    shards = [_searched(texts, text_col, found, refs.schema[pos_col].dataType, refs.schema[id_col].dataType,
                        (pack(s[name_col].tolist()), s[id_col].tolist(), s[pos_col].tolist()))
              for s in _shards(refs, name_col, pos_col, id_col)]
    all_found = shards[0]
    for s in shards[1:]:
        all_found = all_found.unionAll(s)
    w = Window.partitionBy(text_col).orderBy(F.col("SCORE").desc(), F.col("FOUND_POS").asc(), F.col("FOUND_ID").asc())
    return all_found.withColumn("RANK", F.row_number().over(w)).filter(F.col("RANK") <= k)


def fuzzy_top_k(texts: DataFrame, refs: DataFrame, threshold: float, k: int, text_col: str = "TOKEN_KEY",
                name_col: str = "REF_TOKEN_KEY", pos_col: str = "REF_POS", id_col: str = "REF_KEY") -> DataFrame:
    """The k best references at or above ``threshold`` per distinct text: all of refs' columns, SCORE and RANK."""
    def found(index, some):
        return index.search(some, k, threshold)[:3]

    top = _search(texts, refs, text_col, name_col, pos_col, id_col, NameIndex, found, k)
    return top.withColumnRenamed("FOUND_ID", id_col).drop("FOUND_POS").join(refs, id_col)


def best_match(texts: DataFrame, refs: DataFrame, text_col: str, name_col: str, pos_col: str, id_col: str,
               scorer: str = "ratio", min_score: float | None = None) -> DataFrame:
    """The best reference per distinct text (score, then position): all of refs' columns and BEST_SCORE.

    Texts with no reference, or none at ``min_score``, are absent.
    """
    def ratio_best(index, some):
        return index.search(some, 1, min_score)[:3]

    def partial_best(names, some):
        least = -1.0 if min_score is None else min_score
        best, row = np.full(len(some), -1.0), np.zeros(len(some), np.int64)
        for k in range(0, len(names), BLOCK_ROWS):  # in order of position: the first of equals stays
            own = names[k : k + BLOCK_ROWS]
            group = np.repeat(np.arange(len(some)), len(own))
            scores = S.partial_batch([t for t in some for _ in own], own * len(some), group, np.maximum(best, least)).reshape(len(some), len(own))
            col = scores.argmax(1)
            here = scores[np.arange(len(some)), col]
            better = here > best
            best[better], row[better] = here[better], k + col[better]
        t = np.flatnonzero(best >= max(least, 0.0))
        return t, row[t], best[t]

    pack, found = (NameIndex, ratio_best) if scorer == "ratio" else (list, partial_best)
    top = _search(texts, refs, text_col, name_col, pos_col, id_col, pack, found, 1)
    return top.withColumnRenamed("FOUND_ID", id_col).withColumnRenamed("SCORE", "BEST_SCORE").drop("FOUND_POS", "RANK").join(refs, id_col)
