"""SentencePiece encoding and decoding; giant documents by a max-plus scan over chunks.

Encoding looks for the path of greatest weight through the lattice of pieces.  For a byte-pair model the weight
of a step from piece a to piece b is 0 where merging a's and b's characters gives just these two pieces, and
minus infinity elsewhere; a text's merges give the one path of weight 0, so the ids are the model's own.  Along
a text, each position has at most one last piece.

A giant document is cut into chunks.  A boundary's states are the pieces that may end at or lie across it; a
chunk yields the matrix of weights from each state at its left to each at its right, matrices are combined
associatively (greatest sum), which leaves one state at each boundary, and each chunk is then traced back
on its own between its two states.

Words (a space and what follows it) never share a piece with the word before; workers remember words' ids.
Characters without a piece become bytes.  As in the library, U+2581 is a space, and an empty text has no ids.
Null text counts as empty.  Repeated rows and equal doc_ids each get their row.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import documents, read, saved

MODEL = "piece_bpe_32k.model"
#: Characters of a chunk; texts up to this length are encoded in one go.
CHUNK = 65_536
CACHED_WORDS = 200_000
CELLS = 200_000  # characters of words encoded together
LONG_WORD = 48  # beyond, a word is encoded alone
FAR = np.int64(1) << 40


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Model:
    """Pieces, the merges that make them, and which pieces may follow each other."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i).replace("▁", " ") for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        self.unknown = n  # stands for a character without a piece
        self.ids = {t: i for i, t in enumerate(text) if not special[i] and not byte[i]}
        self.byte_ids = {int(text[i][3:5], 16): i for i in range(n) if byte[i]}
        self.raw = spelling(path)
        order = sorted(self.ids.values(), key=lambda i: -sp.get_score(i))
        self.rank = np.full(n + 1, -1, np.int64)  # characters come before all merges
        for r, i in enumerate(i for i in order if len(text[i]) > 1):
            self.rank[i] = r
        self.joined = {}
        for t, i in self.ids.items():
            for k in range(1, len(t)):
                a, b = self.ids.get(t[:k]), self.ids.get(t[k:])
                if a is not None and b is not None:
                    self.joined[a, b] = i
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        rank = self.rank.tolist()
        for t, i in list(self.ids.items()):
            if len(t) > 1:
                parts = self._merge([self.ids.get(c, n) for c in t], rank)
                if len(parts) == 2 and self.joined.get(tuple(parts)) == i:
                    self.left[i], self.right[i] = parts
                else:
                    del self.ids[t]  # merging its characters never makes it
        self.longest = max(map(len, self.ids))
        keys = np.array([a * (n + 1) + b for a, b in self.joined], np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[by], self.rank[np.array(list(self.joined.values()))][by]
        self.lists = rank, self.left.tolist(), self.right.tolist()
        self.fits: dict[tuple[int, int], bool] = {}
        self.trie()

    def _merge(self, parts: list[int], rank: list[int]) -> list[int]:
        """The best merges (leftmost of equals) until two parts are left or none fits."""
        while len(parts) > 2:
            found = [(rank[j], k) for k in range(len(parts) - 1) if (j := self.joined.get((parts[k], parts[k + 1]))) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [self.joined[parts[k], parts[k + 1]]]
        return parts

    def trie(self) -> None:
        """Pieces as a trie: sorted keys (node, character) with the next node; the piece at each node."""
        node, ends, keys = {"": 0}, [-1], []
        for t in sorted(self.ids):
            for k in range(1, len(t) + 1):
                if t[:k] not in node:
                    keys.append((node[t[: k - 1]] << 21 | ord(t[k - 1]), len(ends)))
                    node[t[:k]] = len(ends)
                    ends.append(-1)
            ends[node[t]] = self.ids[t]
        keys.sort()
        self.trie_keys, self.trie_next = np.array(keys, np.int64).T.copy()
        self.trie_piece = np.array(ends, np.int64)

    # ------------------------------------------------- which pieces may be neighbours

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the characters of a and b gives a and b.  Undoes merges from the last one back:
        a merge across must not come before the merge that took away one of its sides."""
        got = self.fits.get((a, b))
        if got is None:
            rank, left, right = self.lists
            u, v, limit, got = a, b, 1 << 60, True
            while u != self.unknown and v != self.unknown:
                j = self.joined.get((u, v))
                if j is not None and 2 * rank[j] < limit:
                    got = False
                    break
                if rank[u] < 0 and rank[v] < 0:
                    break
                if rank[u] > rank[v]:
                    limit, u = 2 * rank[u], right[u]
                else:  # of equal merges the left one comes first
                    limit, v = 2 * rank[v] + 1, left[v]
            if len(self.fits) > 200_000:
                self.fits.clear()
            self.fits[a, b] = got
        return got

    def follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """may_follow, for many pairs at once."""
        base = np.int64(self.unknown + 1)
        pairs, of = np.unique(a * base + b, return_inverse=True)
        u, v = pairs // base, pairs % base
        limit, ok = np.full(len(u), FAR), np.ones(len(u), bool)
        live = np.flatnonzero((u != self.unknown) & (v != self.unknown))
        while len(live):
            key = u[live] * base + v[live]
            i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            across = (self.pair_keys[i] == key) & (2 * self.pair_rank[i] < limit[live])
            ok[live[across]] = False
            ru, rv = self.rank[u[live]], self.rank[v[live]]
            on = ~across & ((ru >= 0) | (rv >= 0))
            live, ru, rv = live[on], ru[on], rv[on]
            first = ru > rv
            x, y = live[first], live[~first]
            limit[x], limit[y] = 2 * ru[first], 2 * rv[~first] + 1
            u[x], v[y] = self.right[u[x]], self.left[v[y]]
        return ok[of]

    # --------------------------------------------------------------- encoding words

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words; words of like length together, position by position."""
        out: list = [None] * len(words)
        size = np.array([len(w) for w in words])
        for k in np.flatnonzero(size > LONG_WORD):
            out[k] = packed(self.path(words[k]))
        at = np.flatnonzero(size <= LONG_WORD)
        at = at[np.argsort(size[at], kind="stable")]
        lo = 0
        while lo < len(at):
            # words come by length: as many as keep the table of a batch small
            n = max(1, CELLS // int(size[at[min(len(at), lo + CELLS // int(size[at[lo]])) - 1]]))
            part = at[lo : lo + n]
            lo += n
            for k, ids in zip(part.tolist(), self._batch([words[k] for k in part.tolist()], size[part])):
                out[k] = ids
        return out

    def _batch(self, words: list[str], size: np.ndarray) -> list[bytes]:
        n, width = len(words), int(size[-1])
        codes = np.full((n, width), -1, np.int64)
        codes[np.arange(width)[None, :] < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        depth = min(self.longest, width)
        piece = np.full((depth + 1, width, n), -1, np.int32)  # piece of a length that starts at a position
        start, of = np.nonzero(codes.T >= 0)
        node = np.zeros(len(of), np.int64)
        for length in range(1, depth + 1):
            end = start + length - 1
            inside = end < size[of]
            start, of, node, end = start[inside], of[inside], node[inside], end[inside]
            key = node << 21 | codes[of, end]
            i = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
            hit = self.trie_keys[i] == key
            if length == 1:
                piece[1, start[~hit], of[~hit]] = self.unknown
            start, of, node = start[hit], of[hit], self.trie_next[i[hit]]
            piece[length, start, of] = self.trie_piece[node]
        one = piece[1]
        one[(one < 0) & (codes.T >= 0)] = self.unknown
        last, took = np.full((width + 1, n), -1, np.int64), np.zeros((width + 1, n), np.int64)
        for end in range(1, width + 1):
            open_ = np.flatnonzero(size >= end)
            for length in range(min(depth, end), 0, -1):
                b = piece[length, end - length, open_]
                some = b >= 0
                w, b = open_[some], b[some].astype(np.int64)
                if not len(w):
                    continue
                ok = np.ones(len(w), bool) if length == end else self.follow(last[end - length, w], b)
                last[end, w[ok]], took[end, w[ok]] = b[ok], length
                open_ = open_[last[end, open_] < 0]
                if not len(open_):
                    break
        # back from the words' ends, all words a step at a time
        at, word, steps = size.copy(), np.arange(n), []
        while len(word):
            steps.append((word, last[at[word], word]))
            at[word] -= took[at[word], word]
            word = word[at[word] > 0]
        count = np.bincount(np.concatenate([w for w, _ in steps]), minlength=n)
        end = np.cumsum(count)
        flat = np.empty(int(end[-1]), "<u4")
        for k, (w, p) in enumerate(steps):
            flat[end[w] - 1 - k] = p
        raw, odd = flat.tobytes(), set(np.flatnonzero(last == self.unknown) % n)
        out = [raw[4 * a : 4 * z] for a, z in zip((end - count).tolist(), end.tolist())]
        for k in odd:
            ids = np.frombuffer(out[k], "<u4").tolist()
            if self.unknown in ids:
                out[k] = packed(self.with_bytes(ids, words[k]))
        return out

    def with_bytes(self, ids: list[int], text: str) -> list[int]:
        out, at = [], 0
        for i in ids:
            if i == self.unknown:
                out += [self.byte_ids[b] for b in text[at].encode("utf-8", "surrogatepass")]
                at += 1
            else:
                out.append(i)
                at += len(self.raw[i].decode())
        return out

    # ------------------------------------------------------------- one long stretch

    def table(self, text: str, first: int | None, lo: int, hi: int) -> dict[int, int | None]:
        """For positions lo to hi: the last piece of the path there that begins with ``first`` before lo (None: nothing before)."""
        last: dict[int, int | None] = {lo: first}
        for end in range(lo + 1, hi + 1):
            for length in range(min(self.longest, end - lo), 0, -1):
                at = end - length
                if at in last:
                    b = self.ids.get(text[at:end], self.unknown if length == 1 else None)
                    if b is not None and (last[at] is None or self.may_follow(last[at], b)):
                        last[end] = b
                        break
        return last

    def width(self, piece: int) -> int:
        return 1 if piece == self.unknown else len(self.raw[piece].decode())

    def back(self, last: dict, lo: int, end: int) -> list[int]:
        ids = []
        while end > lo:
            ids.append(last[end])
            end -= self.width(last[end])
        return ids[::-1]

    def path(self, text: str) -> list[int]:
        return self.with_bytes(self.back(self.table(text, None, 0, len(text)), 0, len(text)), text)

    # --------------------------------------------------------------------- chunks

    def states(self, text: str, at: int) -> list[tuple[int, int, int]]:
        """(piece, characters before, characters behind) of the pieces that may end at, or lie across, a boundary."""
        out = []
        for s in range(1, min(self.longest, at) + 1):
            for j in range(0, self.longest - s + 1):
                if at + j <= len(text) and (i := self.ids.get(text[at - s : at + j])) is not None:
                    out.append((i, s, j))
        if at and text[at - 1] not in self.ids:
            out.append((self.unknown, 1, 0))
        return out


_models: dict[str, Model] = {}
_known: dict[str, dict[str, bytes]] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path], _known[path] = Model(path), {}
    return _models[path]


def cut_words(text: str) -> list[str]:
    """Words, each with the spaces before it; ``text`` begins with a space."""
    return [f" {w}" for w in text[1:].split(" ")] if "  " not in f"{text} " else re.findall(r" +[^ ]*", text)


def encode_all(path: str, texts: list[list[str]]) -> list[bytes]:
    """Ids (little-endian, 32 bits) of texts given as words."""
    m = model(path)
    known = _known[path]
    if len(known) > CACHED_WORDS:
        known.clear()
    new = list({w for t in texts for w in t}.difference(known))
    if new:
        known.update(zip(new, m.encode_words(new)))
    return [b"".join([known[w] for w in t]) for t in texts]


def plain(text: str | None) -> str:
    """The text as the model sees it: a space in front, U+2581 as a space; nothing for an empty text."""
    return f" {text}".replace("▁", " ") if text else ""


@functools.cache
def spelling(path: str) -> list[bytes]:
    """The bytes of each id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    text = [sp.id_to_piece(i).replace("▁", " ") for i in range(sp.get_piece_size())]
    return [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else t.encode() for i, t in enumerate(text)]


def decode(path: str, ids: bytes | np.ndarray) -> str:
    raw = spelling(path)
    text = b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
    return text.removeprefix(" ")


# -------------------------------------------------------------- chunks of giants


def chunk_ends(n: int, chunk: int, margin: int) -> list[int]:
    ends = list(range(chunk, n, chunk))
    if ends and n - ends[-1] < 4 * margin:
        ends.pop()
    return [*ends, n]


def hard_cuts(text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """The first and last start of a word in a stretch: no piece lies across one."""
    found = [m.start() + 1 for m in re.finditer(r"[^ ] ", text[lo:hi])]
    return (lo + found[0], lo + found[-1]) if found else None


def transfer(m: Model, text: str, lo: int, hi: int) -> tuple[list, list, np.ndarray]:
    """States at both boundaries of chunk [lo, hi) (None at a text's start) and the max-plus matrix between them."""
    left = m.states(text, lo) if lo else [(None, 0, 0)]
    right = m.states(text, hi)
    weight = np.full((len(left), len(right)), -np.inf)
    cuts = hard_cuts(text, lo + m.longest, hi)
    if cuts:
        first, last = cuts
        head = [first in m.table(text, u, lo + j, first) for u, _, j in left]
        tail = m.table(text, None, last, hi)
        ends = [hi - s >= last and hi - s in tail and (tail[hi - s] is None or m.may_follow(tail[hi - s], v)) for v, s, _ in right]
        weight[np.ix_(np.flatnonzero(head), np.flatnonzero(ends))] = 0.0
    else:
        for row, (u, _, j) in enumerate(left):
            table = m.table(text, u, lo + j, hi)
            for col, (v, s, _) in enumerate(right):
                if hi - s in table and (table[hi - s] is None or m.may_follow(table[hi - s], v)):
                    weight[row, col] = 0.0
    return left, right, weight


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The associative product: greatest sum over the states between."""
    return (a[:, :, None] + b[None, :, :]).max(1, initial=-np.inf)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, combined pair by pair."""
    if len(matrices) == 1:
        return matrices
    pairs = scan([max_plus(a, b) for a, b in zip(matrices[::2], matrices[1::2])])
    out = [matrices[0]]
    for k in range(1, len(matrices)):
        out.append(pairs[k // 2] if k % 2 else max_plus(pairs[k // 2 - 1], matrices[k]))
    return out


def boundaries(matrices: list[np.ndarray]) -> list[int]:
    """The state at the right of each chunk on the path of greatest weight."""
    from_left = [m[0] for m in scan(matrices)]
    back = [m.T for m in matrices[::-1]]
    end = int(np.argmax(from_left[-1]))
    to_right = [m.T[:, 0] for m in scan([back[0][end : end + 1], *back[1:]])][::-1][1:] if len(matrices) > 1 else []
    return [int(np.argmax(a + b)) for a, b in zip(from_left, to_right)] + [end]


def trace(path: str, text: str, lo: int, hi: int, left: tuple, right: tuple) -> list[int]:
    """A chunk's pieces behind the state at its left, up to and with the state at its right."""
    m = model(path)
    (u, _, j), (v, s, _) = left, right
    cuts = hard_cuts(text, lo + m.longest, hi)
    tail = m.with_bytes([v], text[hi - s :])
    if not cuts:
        table = m.table(text, u, lo + j, hi)
        return m.with_bytes(m.back(table, lo + j, hi - s), text[lo + j :]) + tail
    first, last = cuts
    head = m.with_bytes(m.back(m.table(text, u, lo + j, first), lo + j, first), text[lo + j :])
    words = np.frombuffer(encode_all(path, [cut_words(text[first:last])])[0], "<u4").tolist() if last > first else []
    rest = m.with_bytes(m.back(m.table(text, None, last, hi), last, hi - s), text[last:])
    return head + words + rest + tail


# ------------------------------------------------------------------------- jobs


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text, ids (little-endian 32-bit numbers) of each row."""
    small, giants = encode_parts(docs, path, chunk)
    return small if giants is None else small.unionByName(giants)


def encode_parts(docs: DataFrame, path: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """``encode``, apart for texts encoded in one go and for giant ones (None if there are none)."""
    rows = documents(docs)
    giant = F.coalesce(F.length("text") >= chunk, F.lit(False))

    @F.pandas_udf("binary")
    def whole(texts: pd.Series) -> pd.Series:
        plain_ = [plain(t) for t in texts]
        return pd.Series(encode_all(path, [cut_words(t) if t else [] for t in plain_]), dtype=object)

    small = rows.filter(~giant).select("doc_id", "text", whole("text").alias("ids"))
    giants = saved(rows.filter(giant).withColumn("rid", F.monotonically_increasing_id()), "giants")
    if not giants.head(1):
        return small, None

    def cut(batches):
        import pyarrow as pa

        margin = model(path).longest
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text, lo, out = plain(text), 0, []
                for no, hi in enumerate(chunk_ends(len(text), chunk, margin)):
                    at = max(0, lo - margin)
                    out.append((rid, no, lo - at, hi - at, text[at : hi + margin]))
                    lo = hi
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["rid", "no", "lo", "hi", "part"])

    chunks = giants.select("rid", "text").mapInArrow(cut, "rid long, no int, lo int, hi int, part string")
    chunks = saved(chunks.repartition("rid", "no"), "chunks")

    def matrices(part: pd.DataFrame):
        m = model(path)
        for r in part.itertuples():
            _, right, weight = transfer(m, r.part, r.lo, r.hi)
            yield r.rid, r.no, len(right), (weight == 0).astype(np.uint8).tobytes()

    def transfers(batches):
        for part in batches:
            yield pd.DataFrame(list(matrices(part)), columns=["rid", "no", "states", "weight"]).astype({"no": "int32", "states": "int32"})

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        """A document's matrices: the states at each chunk's left (-1: start) and right."""
        part = part.sort_values("no")
        all_ = [np.where(np.frombuffer(w, np.uint8).reshape(-1, n) > 0, 0.0, -np.inf) for n, w in zip(part.states, part.weight)]
        right = boundaries(all_)
        return pd.DataFrame({"rid": part.rid, "no": part.no, "enter": np.array([-1, *right[:-1]], np.int32), "leave": np.array(right, np.int32)})

    found = chunks.mapInPandas(transfers, "rid long, no int, states int, weight binary").groupBy("rid").applyInPandas(combine, "rid long, no int, enter int, leave int")

    def traces(batches):
        m = model(path)
        for part in batches:
            ids = []
            for r in part.itertuples():
                left = (None, 0, 0) if r.enter < 0 else m.states(r.part, r.lo)[r.enter]
                ids.append(np.array(trace(path, r.part, r.lo, r.hi, left, m.states(r.part, r.hi)[r.leave]), "<u4").tobytes())
            yield pd.DataFrame({"rid": part.rid, "no": part.no, "ids": pd.Series(ids, dtype=object)})

    traced = chunks.join(found, ["rid", "no"]).select("rid", "no", "lo", "hi", "part", "enter", "leave").mapInPandas(traces, "rid long, no int, ids binary")

    def together(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rid": part.rid[:1], "ids": [b"".join(part.sort_values("no").ids)]})

    whole_ids = traced.groupBy("rid").applyInPandas(together, "rid long, ids binary")
    return small, giants.join(whole_ids, "rid").select("doc_id", "text", "ids")


def digests(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256, round_trip of each row: encoded, and decoded from the ids."""

    @F.pandas_udf("n_ids long, ids_crc32 long, decoded_sha256 string")
    def digest(ids: pd.Series) -> pd.DataFrame:
        rows = [(len(i) // 4, zlib.crc32(i), hashlib.sha256(decode(path, i).encode()).hexdigest()) for i in ids]
        return pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "decoded_sha256"])

    same = F.sha2(F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" ")).cast("binary"), 256)
    parts = [p.select("doc_id", digest("ids").alias("d"), same.alias("sha")).select("doc_id", "d.*", (F.col("d.decoded_sha256") == F.col("sha")).alias("round_trip"))
             for p in encode_parts(docs, path, chunk) if p is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, encoded and decoded again."""
    return digests(read(spark, sf_dir, "documents"), model_path())
