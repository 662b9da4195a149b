"""Toxicity by a subsequence string kernel and a support vector machine on Nystroem landmarks.

Words are compared by the letters' gapped subsequences of length 3 that span at most ``SPAN`` + 1 letters,
each weighted by LAMBDA to the power of its span; the kernel is the cosine of these weights, to the power POWER.  An inserted or
missing letter so leaves most of the likeness.  Landmarks are words or stems (first letters of words): all that mark the labelled toxic
texts by more than LEAST_LEAN, and some frequent plain ones.  How much one marks them is counted over distinct neighbourhoods (the word
and the words beside it), so that copies of a text count once.  A text's feature for a landmark is the greatest
kernel of its words and their stems, the
features are whitened by the landmarks' own kernel matrix (Nystroem), and a linear machine with hinge loss is
trained on them; a logistic curve turns its margin into a score.

Before that, letters are lower-cased, look-alike digits and signs read as letters, other signs inside a word
left out, and three or more single letters in a row joined.  Words of over LONG letters are read as overlapping
stretches.  Null and empty texts have no words: their features are 0, and they get a score like any other.
Labels come from a bounded sample: MAX_FIT rows of either class, those of least hash.  Without labels of both
classes every text gets the same score.  Null labels and null doc_ids teach nothing; of several labels of one
doc_id the greatest counts.  Repeated rows each get their row, equal texts equal scores; texts of any length go
whole; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import Numbers, documents, held_out, pick, read, saved

#: Labelled rows of either class that may teach.
MAX_FIT = 3_000
PLAIN_LANDMARKS = 8
LEAST_PLACES = 5  # that a landmark comes in
LEAST_LEAN = 20.0  # of a toxic landmark, as a log-likelihood ratio
STEMS = (4, 5, 6, 8)
SPAN = 5
LAMBDA = 0.7
LONG, STEP = 32, 16
#: Cosines below are read as 0.
FLOOR = 0.3
#: Tokens that a worker remembers; tokens learnt, and characters read, at once.
CACHED_TOKENS, LEARNT, CHARS = 400_000, 4_000, 1 << 20
#: Of the cosine: keeps faint likeness, of which long texts have much, from adding up.
POWER = 3
THRESHOLD = 0.3
#: Signs read as letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_looks = str.maketrans(LOOKALIKES)
_no_letter = re.compile(r"[\W\d_]+")


def clean(token: str) -> str:
    """A token's letters; look-alikes count inside a word only, so that a closing mark stays one."""
    core = token.strip(".,;:!?\"'()[]{}|*-_")
    return core if core.isalpha() else _no_letter.sub("", core.translate(_looks)) if any(c.isalpha() for c in core) else ""


def stretches(word: str) -> list[str]:
    """The word, or overlapping stretches of a long one."""
    return [word] if len(word) <= LONG else [word[k : k + LONG] for k in range(0, len(word) - STEP, STEP)]


def forms_of(token: str) -> list[str]:
    """What of a token is compared: its word (or stretches of a long one) and the word's stems."""
    word = clean(token)
    return [p for p in [*stretches(word), *[word[:n] for n in STEMS if n < len(word)]] if len(p) >= 3]


def neighbourhoods(text: str) -> list[tuple[str, int]]:
    """(word, 64-bit name of the word and its neighbours) at each place of a text."""
    import xxhash

    words = ["", *[w for w in map(clean, text.lower().split()) if w], ""]
    return [(part, xxhash.xxh64_intdigest(f"{a} {w} {z} {k}") - (1 << 63))
            for a, w, z in zip(words, words[1:], words[2:]) if len(w) >= 3 for k, part in enumerate(stretches(w))]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number, its three letters' numbers, weight), each pair once, with weights of length 1 for a word; the letters.

    The letters are all code points of the words, so those of all scripts are told apart.
    """
    width = max(map(len, words), default=0)
    size = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    there = np.bincount(code, minlength=1) > 0
    alphabet = np.flatnonzero(there)
    bits = max(1, len(alphabet).bit_length())
    if 3 * bits + len(words).bit_length() > 63:
        raise OverflowError("too many letters for so many words")
    letter = np.full((len(words), width), -1, np.int64)
    letter[np.arange(width)[None, :] < size[:, None]] = (np.cumsum(there) - 1)[code]
    keys, weights = [], []
    for b in range(2, min(SPAN, width - 1) + 1):
        row, at = np.nonzero(letter[:, b:] >= 0)
        head = row << 3 * bits | letter[row, at] << 2 * bits | letter[row, at + b]
        for a in range(1, b):
            keys.append(head | letter[row, at + a] << bits)
            weights.append(np.full(len(row), LAMBDA ** (b + 1)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros((3, 0), np.int64), np.zeros(0), alphabet
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, weight = key[first], np.add.reduceat(weight, first) if len(first) else weight
    word, mask = key >> 3 * bits, (1 << bits) - 1
    norm = np.sqrt(np.bincount(word, weight**2, len(words)))
    return word, np.stack([key >> 2 * bits & mask, key >> bits & mask, key & mask]), weight / norm[word], alphabet


class Profiles:
    """Subsequence weights of the landmarks, one column each; rows only for subsequences that some landmark has."""

    #: Above this many cells rows are found by search instead of by table.
    CELLS = 1 << 22

    def __init__(self, landmarks: list[str]):
        word, letters, weight, self.alphabet = subsequences(landmarks)
        self.n = len(self.alphabet) + 1  # the last number: a letter that no landmark has
        self.subs, row = np.unique(self._cell(letters), return_inverse=True)
        self.table = np.zeros((len(self.subs), len(landmarks)), np.float32)
        self.table[row, word] = weight
        self.row_of = None
        if self.n**3 <= self.CELLS:
            self.row_of = np.full(self.n**3, -1, np.int32)
            self.row_of[self.subs] = np.arange(len(self.subs))

    def _cell(self, letters: np.ndarray) -> np.ndarray:
        return (letters[0] * self.n + letters[1]) * self.n + letters[2]

    def rows(self, letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
        """The table's row of each subsequence; -1 if no landmark has it."""
        own = np.minimum(np.searchsorted(self.alphabet, alphabet), max(0, self.n - 2))
        own = np.where(self.alphabet[own] == alphabet, own, self.n - 1) if self.n > 1 else np.zeros(len(alphabet), np.int64)
        cell = self._cell(own[letters])
        if self.row_of is not None:
            return self.row_of[cell]
        row = np.minimum(np.searchsorted(self.subs, cell), len(self.subs) - 1)
        return np.where(self.subs[row] == cell, row, -1)

    def kernels(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with each landmark."""
        try:
            word, letters, weight, alphabet = subsequences(words)
        except OverflowError:
            half = len(words) // 2
            return np.concatenate([self.kernels(words[:half]), self.kernels(words[half:])])
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        if not len(self.subs) or not len(word):
            return out
        row = self.rows(letters, alphabet)
        used = row >= 0  # of subsequences that no landmark has, nothing comes
        word, row, weight = word[used], row[used], weight[used].astype(np.float32)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        for lo in range(0, len(first), 20_000):
            part = first[lo : lo + 20_000]
            end = first[lo + 20_000] if lo + 20_000 < len(first) else len(word)
            at = slice(part[0], end)
            out[word[part]] = np.add.reduceat(self.table[row[at]] * weight[at, None], part - part[0])
        return out


class Likeness:
    """Kernels of tokens with the landmarks; those of tokens that recur are remembered."""

    def __init__(self, profiles: Profiles):
        self.profiles, self.width = profiles, profiles.table.shape[1]
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.row = np.zeros(0, np.int64)  # of a token, in ``kernel``; 0: like no landmark
        self.kernel = np.zeros((1, self.width), np.float32)

    def learn(self, tokens: list[str]) -> None:
        for lo in range(0, len(tokens), LEARNT):
            forms = [forms_of(t) for t in tokens[lo : lo + LEARNT]]
            number = Numbers()
            of = number.of([f for x in forms for f in x])
            k = self.profiles.kernels(number.new)
            k[k < FLOOR] = 0
            size = np.array([len(x) for x in forms], np.int64)
            row = np.zeros(len(forms), np.int64)
            some = np.flatnonzero(size)
            if len(some):
                best = np.maximum.reduceat(k[of], (np.cumsum(size) - size)[some])
                like = best.any(1)
                row[some[like]] = len(self.kernel) + np.arange(like.sum())
                self.kernel = np.concatenate([self.kernel, best[like]])
            self.row = np.concatenate([self.row, row])

    def features(self, texts: list[str]) -> np.ndarray:
        """For each text and landmark the greatest kernel of the text's words and stems."""
        if len(self.number) > CACHED_TOKENS:  # so many short rows of kernels and as many tokens at most, and one batch
            self.clear()
        tokens = [t.lower().split() for t in texts]
        flat = [t for x in tokens for t in x]
        text = np.repeat(np.arange(len(texts)), [len(x) for x in tokens])
        one = np.fromiter(map(len, flat), np.int64, len(flat)) == 1
        if one.any():  # letters on their own, perhaps a word spelt out
            inner = np.concatenate([[False], one[1:] & one[:-1] & (text[1:] == text[:-1])])  # goes on from the one before
            first = np.flatnonzero(one & ~inner)
            last = np.flatnonzero(one & ~np.append(inner[1:], False))
            spelt = [(a, z + 1) for a, z in zip(first.tolist(), last.tolist()) if z - a >= 2]
            text = np.concatenate([text, text[[a for a, _ in spelt]]]) if spelt else text
            flat += ["".join(flat[a:z]) for a, z in spelt]
        number = self.number.of(flat)
        new = self.number.fresh()
        if new:
            self.learn(new)
        row = self.row[number]
        at = np.flatnonzero(row)
        pair = np.unique(text[at] * len(self.kernel) + row[at])
        text, row = pair // len(self.kernel), pair % len(self.kernel)
        out = np.zeros((len(texts), self.width), np.float32)
        first = np.flatnonzero(np.diff(text, prepend=-1))
        if len(first):
            out[text[first]] = np.maximum.reduceat(self.kernel[row], first)
        return out**POWER


_likeness: dict[tuple[str, ...], Likeness] = {}


def likeness(landmarks: list[str]) -> Likeness:
    """One for each worker and set of landmarks, kept between batches and tasks."""
    key = tuple(landmarks)
    if key not in _likeness:
        _likeness.clear()
        _likeness[key] = Likeness(Profiles(landmarks))
    return _likeness[key]


def features(texts: list[str], landmarks: list[str]) -> np.ndarray:
    like, out = likeness(landmarks), []
    size = np.cumsum([len(t) for t in texts]) // CHARS
    for k in np.unique(size):
        at = np.flatnonzero(size == k)
        out.append(like.features([texts[i] for i in at]))
    return np.concatenate(out) if out else np.zeros((0, len(landmarks)), np.float32)


# ---------------------------------------------------------------------- training


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 2_000) -> np.ndarray:
    """Weighted linear machine by averaged subgradient steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        inside = y * (x @ w) < 1
        grad = ridge * w - (weight[inside] * y[inside]) @ x[inside]
        w = w - grad * 20.0 / np.sqrt(t)
        if t > steps // 2:
            mean += w
    return mean / (steps - steps // 2)


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), by damped Newton steps."""
    a, b, x = 1.0, 0.0, np.stack([margin, np.ones_like(margin)], 1)
    target = (y > 0).astype(float)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-6 * np.array([a, b])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


class Machine:
    """Landmarks, weights on their kernels, and the curve."""

    def __init__(self, landmarks: list[str], alpha: np.ndarray, bias: float, curve: tuple[float, float]):
        self.landmarks, self.alpha, self.bias, self.curve = landmarks, alpha, bias, curve

    def scores(self, texts: list[str]) -> np.ndarray:
        margin = features(texts, self.landmarks) @ self.alpha + self.bias if self.landmarks else np.full(len(texts), self.bias)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> Machine:
    """From rows (doc_id, text) and (doc_id, toxic)."""
    spark = docs.sparkSession
    marked = pick(labels, doc_id="long", toxic="int").filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    teach = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r.toxic: r["count"] for r in teach.groupBy("toxic").count().collect()}
    prior = np.log((total.get(1, 0) + 1) / (total.get(0, 0) + 1))
    if len(total) < 2:
        return Machine([], np.zeros(0), 0.0, (0.0, float(prior)))
    ids = [teach.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit) for c in (0, 1)]
    chosen = F.broadcast(spark.createDataFrame(ids[0].unionByName(ids[1]).collect(), "doc_id long, toxic int"))  # 2 * max_fit rows
    rows = docs.join(chosen, "doc_id").select("text", "toxic")
    used = {c: min(total[c], max_fit) for c in total}

    @F.pandas_udf("array<struct<word:string,place:long>>")
    def places(texts: pd.Series) -> pd.Series:
        return pd.Series([neighbourhoods(t or "") for t in texts], dtype=object)

    seen = rows.select("toxic", F.explode(places("text")).alias("x")).select("toxic", "x.*").distinct()
    seen = saved(seen.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "places")
    whole = seen.agg(F.sum("t"), F.sum("c")).first()
    stems = F.explode(F.array_distinct(F.array("word", *[F.substring("word", 1, n) for n in STEMS + (7,)]))).alias("word")
    seen = seen.select(stems, "t", "c").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= LEAST_PLACES)
    t, c, n = F.col("t"), F.col("c"), F.col("t") + F.col("c")
    share = (whole[0] + 1) / (whole[0] + whole[1] + 2)
    ratio = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    lean = F.when(t > n * share, 2 * (ratio(t, n * share) + ratio(c, n * (1 - share)))).otherwise(0.0)
    seen = saved(seen.withColumn("lean", lean), "leanings")
    best = seen.filter(F.col("lean") > LEAST_LEAN).orderBy(F.desc("lean"), F.desc(F.length("word")), "word").collect()  # words of 2 * max_fit rows
    toxic, taken, begun = [], set(), set()  # taken words, and all that they begin with
    for r in best:  # of a word and its stem, the one that leans more
        starts = {r.word[:n] for n in range(1, len(r.word) + 1)}
        if r.word not in begun and taken.isdisjoint(starts):
            toxic.append(r.word)
            taken.add(r.word)
            begun |= starts
    plain = [r.word for r in seen.filter("lean = 0").orderBy(F.desc("c"), "word").limit(PLAIN_LANDMARKS).collect()]
    landmarks = toxic + plain
    if not landmarks:
        return Machine([], np.zeros(0), 0.0, (0.0, float(prior)))
    table = Profiles(landmarks).table

    @F.pandas_udf("array<float>")
    def feature(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features([t or "" for t in texts], landmarks)), dtype=object)

    got = rows.select("toxic", feature("text").alias("x")).collect()  # 2 * max_fit short rows
    y = np.array([1.0 if r.toxic else -1.0 for r in got])
    x = np.array([r.x for r in got], np.float64)
    own = (table.T.astype(np.float64) @ table) ** POWER
    value, vector = np.linalg.eigh(own)
    white = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T
    share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    w = hinge(x @ white, y, share)
    alpha, bias = white @ w[:-1], float(w[-1])
    weight = np.where(y > 0, total[1] / used[1], total[0] / used[0])
    return Machine(landmarks, alpha, bias, logistic(x @ alpha + bias, y, weight))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every row."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(machine.scores([t or "" for t in texts]))

    return documents(docs).select("doc_id", scored("text").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op5: three folds of four teach, the fourth is held out."""
    docs = documents(read(spark, sf_dir, "documents"))
    out = held_out(F.col("doc_id"), 4)
    machine = fit(docs.filter(~out), read(spark, sf_dir, "labels"))
    return score(docs, machine).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
