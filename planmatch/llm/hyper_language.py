"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1; a trigram's vector binds its letters' vectors, each rotated by
its place; a text's vector bundles (sums) its trigrams' vectors.  A language's prototype bundles its training
texts.  A text gets the language of the prototype with the greatest cosine.

Letters are lower-cased; whatever is no letter counts as one space.  Null texts and texts without a letter are
``und`` with score 0, as is every text if nothing was learned.  Equal cosines go to the language that comes
first by name.  Repeated rows each get their row.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import give_back, held_out, pick, read

DIMENSIONS = 512
SEED = 8
#: More distinct languages than this are an error: their prototypes would not be small.
MAX_LANGUAGES = 10_000
UNKNOWN = "und"
SPACE = 32
TEXTS = 128  # bundled at once


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@functools.cache
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, dimensions, np.int8) * 2 - 1


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and trigram number of each trigram, and the trigrams (n x 3 code points)."""
    low = [t.lower() + "\n" for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of what follows a letter stands for the space
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in low])
    sym = np.concatenate([[SPACE], np.where(letter, codes, SPACE)[keep]])
    text = np.concatenate([[-1], text[keep]])
    if len(sym) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, 3), np.uint32)
    inside = (sym[1:-1] != SPACE) | (text[:-2] == text[2:])
    alphabet = np.flatnonzero(np.bincount(sym))
    rank = np.zeros(int(alphabet[-1]) + 1, np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    r, a = rank[sym], len(alphabet)
    key = ((r[:-2] * a + r[1:-1]) * a + r[2:])[inside]
    if a**3 <= 1 << 22:
        there = np.bincount(key, minlength=a**3) > 0
        kinds, number = np.flatnonzero(there), (np.cumsum(there) - 1)[key]
    else:
        kinds, number = np.unique(key, return_inverse=True)
    return text[1:-1][inside], number, np.stack([alphabet[kinds // (a * a)], alphabet[kinds // a % a], alphabet[kinds % a]], 1)


def bound(kinds: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of trigrams: letters' vectors, rotated by place, multiplied."""
    out = np.ones((len(kinds), dimensions), np.float32)
    for place in range(3):
        codes, of = np.unique(kinds[:, place], return_inverse=True)
        table = np.array([np.roll(letter_vector(int(c), dimensions), 2 - place) for c in codes], np.float32).reshape(-1, dimensions)
        out *= table[of]
    return out


def bundles(texts: list[str], dimensions: int, groups: np.ndarray | None = None, n: int | None = None) -> np.ndarray:
    """A vector for each text, or, with ``groups``, for each of ``n`` groups of texts."""
    text, number, kinds = trigrams(texts)
    own = np.arange(len(texts)) if groups is None else groups
    n, g = len(texts) if n is None else n, len(kinds)
    counts = np.bincount(own[text] * g + number, minlength=n * g).reshape(n, g) if g else np.zeros((n, 0))
    return counts.astype(np.float32) @ bound(kinds, dimensions)


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their prototypes, from rows (text, lang); rows with a null are left out."""

    def sums(batches):
        import pyarrow as pa

        found: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs], np.int64)
            for k in range(0, len(texts), TEXTS):
                part = bundles(texts[k : k + TEXTS], dimensions, of[k : k + TEXTS], len(names))
                for name, v in zip(names, part):
                    found[name] = found.get(name, 0) + v.astype(np.float64)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([v.tolist() for v in found.values()])], names=["lang", "v"])
        give_back()

    rows = pick(docs, text="string", lang="string").filter("text is not null and lang is not null")
    parts = rows.mapInArrow(sums, "lang string, v array<double>").select("lang", F.posexplode("v").alias("at", "x"))
    whole = parts.groupBy("lang", "at").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
    got = whole.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    v = np.array([[x.x for x in r.v] for r in got], np.float64).reshape(len(got), dimensions)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return [r.lang for r in got], v.astype(np.float32)


def language(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """struct<lang_pred string, score double> of a text column."""
    names, prototypes = model

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        plain, pred, score = [t or "" for t in texts], [], []
        for k in range(0, len(plain), TEXTS):
            part = plain[k : k + TEXTS]
            v = bundles(part, prototypes.shape[1])
            size = np.linalg.norm(v, axis=1)
            cos = v @ prototypes.T / np.maximum(size, 1e-12)[:, None]
            known = (size > 0) if names else np.zeros(len(part), bool)
            best = cos.argmax(1) if names else np.zeros(len(part), int)
            pred += [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score += [min(1.0, max(0.0, float(c[b]))) if k else 0.0 for c, b, k in zip(cos, best, known)]
        return pd.DataFrame({"lang_pred": pred, "score": score})

    # evaluated once, also where a filter and a projection both use it
    return predict.asNondeterministic()(text)


def has_letters(text: Column, dimensions: int) -> Column:
    """Whether a text has anything to bundle: what ``language`` asks of it besides a model."""

    @F.pandas_udf("boolean")
    def lettered(texts: pd.Series) -> pd.Series:
        plain = [t or "" for t in texts]
        return pd.Series([bool(n > 0) for k in range(0, len(plain), TEXTS) for n in np.linalg.norm(bundles(plain[k : k + TEXTS], dimensions), axis=1)], dtype=object)

    return lettered(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op8: three folds of four teach, the fourth is held out."""
    docs = pick(read(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string")
    out = held_out(F.col("doc_id"), 4)
    model = learn(docs.filter(~out))
    return docs.select("doc_id", out.alias("held_out"), language(F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.*")
