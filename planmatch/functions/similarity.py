"""String similarity scorers as Arrow-batched pandas UDFs.

* ``ratio``          100 * (1 - indel / (|a|+|b|)),  indel = |a|+|b| - 2*LCS
* ``partial_ratio``  best ``ratio`` of the shorter string against every window
                     of the longer one (full-length windows plus the truncated
                     windows at both ends); equal lengths are tried both ways.

LCS uses the bit-parallel recurrence of Allison & Dix (1986) / Hyyrö (2004):
one machine-word-wide step per character of the second string.  One pass over
``b`` yields the LCS of ``a`` with every prefix of ``b``, which gives all
prefix windows of ``partial_ratio`` at once (and all suffix windows from the
reversed pass).

Spark's ``levenshtein`` is not a substitute: it charges 1 for a substitution,
the indel distance charges 2.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pattern_masks(a: str) -> dict:
    pm: dict = {}
    for i, ch in enumerate(a):
        pm[ch] = pm.get(ch, 0) | (1 << i)
    return pm


def lcs_length(a: str, b: str, pm: dict | None = None) -> int:
    if not a or not b:
        return 0
    if pm is None:
        pm = _pattern_masks(a)
    mask = (1 << len(a)) - 1
    v = mask
    get = pm.get
    for ch in b:
        u = v & get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return len(a) - v.bit_count()


def lcs_prefixes(a: str, b: str, pm: dict | None = None) -> list:
    """``out[i]`` = LCS(a, b[:i+1]) for every prefix of b."""
    if not a:
        return [0] * len(b)
    if pm is None:
        pm = _pattern_masks(a)
    mask = (1 << len(a)) - 1
    v = mask
    la = len(a)
    out = []
    get = pm.get
    for ch in b:
        u = v & get(ch, 0)
        v = ((v + u) | (v - u)) & mask
        out.append(la - v.bit_count())
    return out


def _score(lsum: int, lcs: int) -> float:
    # same operation order as the original scorer, so values sit on the same
    # side of the 70 / 75 / 85 cut-offs
    return (1.0 - (lsum - 2 * lcs) / lsum) * 100.0


def ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    lsum = len(a) + len(b)
    if lsum == 0:
        return 100.0
    return _score(lsum, lcs_length(a, b))


def _partial_one_way(s: str, longer: str) -> float:
    ls, ll = len(s), len(longer)
    if ls == 0 or ll == 0:
        return 0.0
    pm = _pattern_masks(s)
    best = 0.0
    # truncated windows at the start: longer[:i], i < ls
    pre = lcs_prefixes(s, longer[: ls - 1], pm)
    for i, lcs in enumerate(pre, start=1):
        if lcs:
            best = max(best, _score(ls + i, lcs))
    # truncated windows at the end: longer[k:], length < ls
    if ls > 1:
        rs = s[::-1]
        tail = longer[ll - ls + 1:][::-1]
        suf = lcs_prefixes(rs, tail, _pattern_masks(rs))
        for i, lcs in enumerate(suf, start=1):
            if lcs:
                best = max(best, _score(ls + i, lcs))
    # full-length windows
    for k in range(0, ll - ls + 1):
        if best == 100.0:
            break
        lcs = lcs_length(s, longer[k:k + ls], pm)
        if lcs:
            best = max(best, _score(2 * ls, lcs))
    return best


def partial_ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    if not a and not b:
        return 100.0
    if len(a) <= len(b):
        res = _partial_one_way(a, b)
    else:
        res = _partial_one_way(b, a)
    if res != 100.0 and len(a) == len(b):
        res = max(res, _partial_one_way(b, a))
    return res


def token_sort(s: str) -> str:
    return " ".join(sorted(s.split()))


def nfkd_fold(s: str | None) -> str | None:
    if s is None:
        return None
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")


#: Characters counted one by one; all others share one count, which only loosens the bounds made of the counts.
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 "
_COUNT_OF = np.full(128, len(COUNTED), np.int64)
_COUNT_OF[[ord(c) for c in COUNTED]] = np.arange(len(COUNTED))
#: Longest string whose bit masks fit a machine word.
WORD = 64


def flat_codes(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts end to end, where each text begins, and its length."""
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return points, np.cumsum(length) - length, length


def char_kinds(points: np.ndarray) -> np.ndarray:
    """Which count each code point belongs to."""
    return np.where(points < 128, _COUNT_OF[np.minimum(points, 127)], len(COUNTED))


def char_counts(texts: list) -> np.ndarray:
    """One row a text: how often it has each counted character, and all others together."""
    points, _, length = flat_codes(texts)
    width = len(COUNTED) + 1
    row = np.repeat(np.arange(len(texts)), length)
    return np.bincount(row * width + char_kinds(points), minlength=len(texts) * width).reshape(-1, width).astype(np.int16)


def bit_masks(texts: list, alphabet: np.ndarray) -> np.ndarray:
    """mask[i, c]: positions of the alphabet's c-th code point in text i (of at most WORD characters); the last column is empty."""
    out = np.zeros((len(texts), len(alphabet) + 1), np.uint64)
    points, start, length = flat_codes(texts)
    row = np.repeat(np.arange(len(texts)), length)
    at = np.arange(len(points)) - start[row]
    c = np.searchsorted(alphabet, points)
    known = (c < len(alphabet)) & (alphabet[np.minimum(c, max(0, len(alphabet) - 1))] == points) if len(alphabet) else np.zeros(len(points), bool)
    known &= at < WORD
    np.bitwise_or.at(out, (row[known], c[known]), np.uint64(1) << at[known].astype(np.uint64))
    return out


def lcs_masked(masks: np.ndarray, ai: np.ndarray, la: np.ndarray, codes: np.ndarray, first: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """LCS of many pairs at once: masks of ``a`` (rows ``ai``, lengths ``la``) against ``codes[first : first + lb]``.

    One bit-parallel step for each position of ``b``; pairs leave as their ``b`` ends.
    """
    order = np.argsort(-lb, kind="stable")
    ai, la, first, lb = ai[order], la[order], first[order], lb[order]
    full = np.where(la >= WORD, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(la, WORD - 1).astype(np.uint64)) - np.uint64(1))
    v = full.copy()
    live = len(lb)
    for j in range(int(lb[0]) if live else 0):
        live = int(np.searchsorted(-lb[:live], -j, "left"))  # lengths over j
        w = v[:live]
        u = w & masks[ai[:live], codes[first[:live] + j]]
        v[:live] = ((w + u) | (w - u)) & full[:live]
    out = np.empty(len(lb), np.int64)
    out[order] = la - np.bitwise_count(v).astype(np.int64)
    return out


def distinct(texts: list) -> tuple[list, np.ndarray]:
    """The distinct texts, and which one each text is."""
    number: dict = {}
    of = np.fromiter((number.setdefault(x, len(number)) for x in texts), np.int64, len(texts))
    return list(number), of


def lcs_pairs(a: list, b: list) -> np.ndarray:
    """LCS length of every pair (a[i], b[i]), set up once per distinct string.

    Pairs whose ``a`` is longer than a machine word use Python's integers.
    """
    if not a:
        return np.zeros(0, np.int64)
    (ua, ai), (ub, bi) = distinct(a), distinct(b)
    points, first, length = flat_codes(ub)
    alphabet = np.unique(points)
    codes = np.searchsorted(alphabet, points)
    la = np.fromiter(map(len, ua), np.int64, len(ua))
    out = np.zeros(len(a), np.int64)
    wide = la[ai] > WORD
    for i in np.flatnonzero(wide):
        out[i] = lcs_length(a[i], b[i])
    sel = np.flatnonzero(~wide)
    out[sel] = lcs_masked(bit_masks(ua, alphabet), ai[sel], la[ai[sel]], codes, first[bi[sel]], length[bi[sel]])
    return out


def scores_of(total: np.ndarray, lcs: np.ndarray) -> np.ndarray:
    """``ratio`` from the sum of two lengths and their LCS, by the same operations as one pair's."""
    return np.where(total == 0, 100.0, (1.0 - (total - 2 * lcs) / np.maximum(total, 1)) * 100.0)


#: Windows looked at together, and pairs of a group scored before the rest is bounded by them.
WINDOWS, FIRST_PAIRS = 1 << 17, 4


def partial_batch(a: list, b: list, group: np.ndarray | None = None, floor=None) -> np.ndarray:
    """``partial_ratio`` of every pair (a[i], b[i]); all windows of all pairs at once.

    Pairs and then windows are bounded by the characters both sides share.  The best-bounded pairs of each group
    (each pair by itself, if no groups are given) go first, then those whose bound is not below what their group
    has reached, nor below ``floor`` (one number, or one for each group).  A pair that surely stays below its
    group's best or the floor may come back with less than its score, never with more.
    """
    n = len(a)
    group = np.arange(n) if group is None else np.unique(group, return_inverse=True)[1]
    out = np.zeros(n)
    la, lb = (np.fromiter(map(len, x), np.int64, n) for x in (a, b))
    out[(la == 0) & (lb == 0)] = 100.0
    short = np.minimum(la, lb)
    for i in np.flatnonzero(short > WORD):
        out[i] = partial_ratio(a[i], b[i])
    pairs = np.flatnonzero((short > 0) & (short <= WORD))
    ways = [(i, a[i], b[i]) if la[i] <= lb[i] else (i, b[i], a[i]) for i in pairs]
    ways += [(i, b[i], a[i]) for i in pairs if la[i] == lb[i]]
    reached = np.broadcast_to(-np.inf if floor is None else np.asarray(floor, float), int(group.max()) + 1 if n else 0).copy()
    if not ways:
        return out
    pair = np.fromiter((w[0] for w in ways), np.int64, len(ways))
    ls = short[pair]
    (needles, ni), (texts, ti) = distinct([w[1] for w in ways]), distinct([w[2] for w in ways])
    has, holds = char_counts(needles), char_counts(texts)
    shared = np.zeros(len(ways), np.int64)
    for c in range(has.shape[1]):
        shared += np.minimum(has[ni, c], holds[ti, c])
    bound = scores_of(ls + shared, shared)  # no window does better than one of just the shared characters
    of = group[pair]
    order = np.lexsort((-bound, of))
    nth = np.arange(len(order)) - np.repeat(np.flatnonzero(np.diff(of[order], prepend=-1)), np.unique(of, return_counts=True)[1])
    for part in (order[nth < FIRST_PAIRS], order[nth >= FIRST_PAIRS]):
        part = part[(shared[part] > 0) & (bound[part] >= reached[of[part]])]
        ends = np.cumsum(np.fromiter((len(ways[i][1]) + len(ways[i][2]) - 1 for i in part), np.int64, len(part)))
        for k in range(int(ends[-1]) // WINDOWS + 1 if len(part) else 0):  # as many pairs as have about WINDOWS windows
            some = part[(ends // WINDOWS) == k]
            some = some[bound[some] >= reached[of[some]]]
            if len(some):
                _score_windows([ways[i] for i in some], group, reached, out)
    return out


def _score_windows(ways: list, group: np.ndarray, reached: np.ndarray, out: np.ndarray) -> None:
    """Best window of each (pair, needle, text); raises ``out`` by pair and ``reached`` by group."""
    pair = np.fromiter((w[0] for w in ways), np.int64, len(ways))
    (needles, ni), (texts, ti) = distinct([w[1] for w in ways]), distinct([w[2] for w in ways])
    points, first, length = flat_codes(texts)
    alphabet = np.unique(points)
    codes, width = np.searchsorted(alphabet, points), len(COUNTED) + 1
    upto = np.zeros((len(points) + 1, width), np.int32 if len(points) > 32_000 else np.int16)  # counts of all characters before a position
    upto[np.arange(1, len(points) + 1), char_kinds(points)] = 1
    np.cumsum(upto, 0, out=upto)
    has, ln = char_counts(needles), np.fromiter(map(len, needles), np.int64, len(needles))
    masks = bit_masks(needles, alphabet)

    # windows of needle's length at every offset, cut at both ends of the text
    each = ln[ni] + length[ti] - 1
    way = np.repeat(np.arange(len(ways)), each)
    offset = np.arange(len(way)) - np.repeat(np.cumsum(each) - each, each) - (ln[ni[way]] - 1)
    a = np.maximum(offset, 0)
    size = np.minimum(offset + ln[ni[way]], length[ti[way]]) - a
    a += first[ti[way]]
    shared = np.minimum(has[ni[way]], upto[a + size] - upto[a]).sum(1)
    total = ln[ni[way]] + size
    bound = scores_of(total, shared)
    of = group[pair[way]]

    def score(sel: np.ndarray) -> None:
        found = scores_of(total[sel], lcs_masked(masks, ni[way[sel]], ln[ni[way[sel]]], codes, a[sel], size[sel]))
        np.maximum.at(out, pair[way[sel]], found)
        np.maximum.at(reached, of[sel], found)

    open_ = shared > 0
    order = np.lexsort((-bound, of))
    top = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
    top = top[open_[top] & (bound[top] >= reached[of[top]])]
    score(top)
    open_[top] = False
    score(np.flatnonzero(open_ & (bound >= reached[of])))


def _scored(a: list, b: list, score) -> np.ndarray:
    """``score`` of the pairs that have both sides; NaN elsewhere."""
    out = np.full(len(a), np.nan)
    ok = [i for i in range(len(a)) if isinstance(a[i], str) and isinstance(b[i], str)]
    if ok:
        out[ok] = score([a[i] for i in ok], [b[i] for i in ok])
    return out


def ratio_batch(a: list, b: list) -> np.ndarray:
    """``ratio`` for each pair; NaN where either side is missing."""
    def score(x, y):
        total = np.fromiter((len(p) + len(q) for p, q in zip(x, y)), np.int64, len(x))
        return scores_of(total, lcs_pairs(x, y))

    return _scored(a, b, score)


# --------------------------------------------------------------------------
# Arrow UDFs
# --------------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(ratio_batch(a.tolist(), b.tolist()), dtype="float64")


@F.pandas_udf(T.DoubleType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_scored(a.tolist(), b.tolist(), partial_batch), dtype="float64")


@F.pandas_udf(T.StringType())
def nfkd_ascii(s: pd.Series) -> pd.Series:
    return pd.Series([nfkd_fold(x) if isinstance(x, str) else None for x in s], dtype=object)
