"""Vector bin packing of training examples into fixed-size sequences, for instruction data.

An example makes three demands on a sequence: its tokens, one segment, and its loss-bearing tokens (those inside
its ``loss`` spans; all of them if it names none).  Every task packs the examples it reads, from a bounded pool:
into the open sequence goes, of the examples that fit under all three limits, the one whose demands have the
greatest dot product with what the sequence has left.  Where none fits whole, the longest one is cut and its
prefix fills the sequence; an example over the limits fills sequences of its own first.  A sequence that ends
below its size (limits reached, or no more examples) is split at powers of two, where nothing is padded.

Nothing is shuffled, and no task holds more than a batch of texts and a pool.  Null text counts as empty (just
the end id); null and repeated doc_ids and repeated rows are examples of their own; equal demands go by order of
reading; texts of any length are cut over sequences; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import Numbers, documents, pick, read
from planmatch.llm.wavelet import Rows, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Words that a worker remembers with their ids.
CACHED_WORDS = 800_000
#: A pool is filled up to so many examples or sequences' worth of tokens, and packed down to a quarter.
POOL_EXAMPLES, POOL_SEQUENCES = 2048, 256


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


# ------------------------------------------------------------------ tokenizing


class Words:
    """Ids of whole texts through the tokenizers library, remembering the ids of words that recur.

    The tokenizer drops white space and no pre-token crosses it, so a text's ids are those of its words.  Words
    of plain Latin text are cut by the tokenizer's own pattern and its model encodes each distinct pre-token
    once; a text with other characters, or with what may be an added token, goes through the whole library.
    """

    PLAIN = re.compile("[\t\n\r -~À-ÿı-ž]*").fullmatch

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        split = json.loads(self.lib.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self.pretokens = regex.compile(split["pattern"]["Regex"]).findall
        self.model = Tokenizer(self.lib.model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.mark = self.model.encode(["\n"], is_pretokenized=True, add_special_tokens=False).ids[0]
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.word, self.words = Numbers(), Rows()
        self.part, self.parts = Numbers(), Rows()

    def learn(self, words: list[str]) -> None:
        cut = [self.pretokens(w) for w in words]
        number = self.part.of([p for c in cut for p in c])
        new = self.part.fresh()
        for k in range(0, len(new), 4096):  # a line break, which no pre-token holds, marks the ends
            marked = [x for p in new[k : k + 4096] for x in (p, "\n")]
            found = np.array(self.model.encode_batch_fast([marked], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(found == self.mark)
            if len(ends) * 2 != len(marked):
                raise ValueError("pre-tokens and marks do not fit")
            self.parts.add(found[found != self.mark], np.diff(ends, prepend=-1) - 1)
        flat, size = self.parts.take(number)
        total = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, cut)])]
        self.words.add(flat, np.diff(total), total[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text."""
        if len(self.word) > CACHED_WORDS:
            self.clear()
        easy = [bool(self.PLAIN(t)) and not any(a in t for a in self.added) for t in texts]
        cut = [t.lower().split() if e else [] for t, e in zip(texts, easy)]
        of = self.word.of([w for c in cut for w in c])
        new = self.word.fresh()
        if new:
            self.learn(new)
        flat, size = self.words.take(of)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, cut)])].tolist()
        odd = iter(self.lib.encode_batch_fast([t for t, e in zip(texts, easy) if not e], add_special_tokens=False))
        return [flat[a:z] if e else np.array(next(odd).ids, "<u4") for e, a, z in zip(easy, ends, ends[1:])]


_words: dict[str, Words] = {}


def encoder(path: str) -> Words:
    """One for each worker, kept between tasks."""
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


# --------------------------------------------------------------------- packing


def loss_prefix(spans: list[tuple[int, int]] | None, start: int, tokens: int, loss: int) -> int:
    """The most ids from ``start`` on, up to ``tokens``, with at most ``loss`` loss-bearing ones among them."""
    if spans is None:
        return min(tokens, loss)
    for a, z in spans:
        a, z = max(a, start), min(z, start + tokens)
        if a < z:
            if z - a > loss:
                return a + loss - start
            loss -= z - a
    return tokens


def loss_count(spans: list[tuple[int, int]] | None, start: int, end: int) -> int:
    if spans is None:
        return end - start
    return sum(max(0, min(z, end) - max(a, start)) for a, z in spans)


def merged(spans, n: int) -> list[tuple[int, int]] | None:
    """Loss spans inside 0 to n, in order, without overlaps; None for all."""
    if spans is None:
        return None
    out: list[tuple[int, int]] = []
    for a, z in sorted((max(0, s[0] or 0), min(n, n if s[1] is None else s[1])) for s in spans if s is not None):
        if a < z:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(z, out[-1][1]))
            else:
                out.append((a, z))
    return out


class Pool:
    """Examples waiting for a sequence: what is left of each, its tokens and its loss-bearing tokens."""

    GONE = np.iinfo(np.int64).max

    def __init__(self, limits: Limits):
        self.limits, self.examples = limits, []
        self.start, self.tokens, self.loss = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, examples: list) -> None:
        """Examples: (payload, number of ids, loss spans)."""
        live = np.flatnonzero(self.tokens != self.GONE)
        self.examples = [self.examples[i] for i in live] + examples
        grown = ([0] * len(examples), [n for _, n, _ in examples], [loss_count(s, 0, n) for _, n, s in examples])
        self.start, self.tokens, self.loss = (np.concatenate([a[live], np.array(b, np.int64)]) for a, b in zip((self.start, self.tokens, self.loss), grown))

    def size(self) -> tuple[int, int]:
        """Examples and tokens that wait."""
        live = self.tokens != self.GONE
        return int(live.sum()), int(self.tokens[live].sum())

    def _choose(self, tokens: int, loss: int, empty: bool, blocked: np.ndarray) -> tuple[int, bool] | None:
        """The next example, and whether it goes in whole."""
        live = (self.tokens != self.GONE) & ~blocked
        if not live.any():
            return None
        fits = live & (self.tokens <= tokens) & (self.loss <= loss)
        if fits.any() and not (empty and (live & ~fits).any()):
            top = self.limits
            left = np.array([tokens / top.tokens**2, loss / top.loss**2])  # a segment is the same demand for all
            return int(np.argmax(np.where(fits, self.tokens * left[0] + self.loss * left[1], -1.0))), True
        return int(np.argmax(np.where(live & ~fits, self.tokens, -1))), False

    def sequence(self) -> list[tuple[object, int, int, int]]:
        """One sequence: (payload, start, length, loss-bearing tokens) in order of their offsets."""
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        out, blocked = [], np.zeros(len(self.tokens), bool)
        while tokens and segments:
            chosen = self._choose(tokens, loss, not out, blocked)
            if chosen is None:
                break
            i, whole = chosen
            payload, size, spans = self.examples[i]
            start = int(self.start[i])
            n = int(self.tokens[i]) if whole else loss_prefix(spans, start, min(tokens, size - start), loss)
            if n == 0:  # its next id bears loss, and the sequence takes no more of these
                blocked[i] = True
                continue
            own = loss_count(spans, start, start + n)
            out.append((payload, start, n, own))
            tokens, segments, loss = tokens - n, segments - 1, loss - own
            self.start[i] += n
            self.tokens[i], self.loss[i] = (self.GONE, 0) if start + n == size else (size - start - n, self.loss[i] - own)
        return out


def at_powers(pieces: list[tuple], spans_of, full: int) -> list[list[tuple]]:
    """A sequence as it is if full or a power of two long, else split into ones of powers of two."""
    left = sum(n for _, _, n, _ in pieces)
    if left == full:
        return [pieces]
    out: list[list[tuple]] = []
    room = 0
    for payload, start, n, _ in pieces:
        while n:
            if room == 0:
                room = 1 << (left.bit_length() - 1)
                left -= room
                out.append([])
            take = min(n, room)
            out[-1].append((payload, start, take, loss_count(spans_of(payload), start, start + take)))
            start, n, room = start + take, n - take, room - take
    return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, n_loss long"


def _packed(batches, limits: Limits):
    """Arrow batches of pieces from an iterator of lists of (doc_id, ids, loss spans)."""
    import pyarrow as pa

    schema = pa.schema([(k, pa.binary() if k == "ids" else pa.int64()) for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "n_loss")])
    pool, number = Pool(limits), TaskContext.get().partitionId() << 40

    def down_to(examples: int, tokens: int):
        nonlocal number
        cols: list[list] = [[] for _ in schema]
        while (have := pool.size())[0] and (have[0] > examples or have[1] > tokens):
            for pieces in at_powers(pool.sequence(), lambda p: p[2], limits.tokens):
                offset = 0
                for (doc, ids, _), start, n, loss in pieces:
                    for c, v in zip(cols, (doc, start, n, ids[start : start + n].tobytes(), len(ids), number, offset, loss)):
                        c.append(v)
                    offset += n
                number += 1
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        held, tokens = [], pool.size()[1]
        for doc, ids, loss in batch:
            held.append(((doc, ids, loss), len(ids), loss))
            tokens += len(ids)
            if len(held) >= POOL_EXAMPLES or tokens >= POOL_SEQUENCES * limits.tokens:
                pool.add(held)
                yield from down_to(POOL_EXAMPLES // 4, POOL_SEQUENCES * limits.tokens // 4)
                held, tokens = [], pool.size()[1]
        pool.add(held)
    yield from down_to(0, 0)


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pieces of examples given by ids.

    ``examples``: doc_id, ids (binary, little-endian 32-bit), loss (array of structs of two ints, from and to:
    the loss-bearing stretches; null for all).  Null or empty ids make no piece.  Each id lies in exactly one piece.
    """
    rows = pick(examples, doc_id="long", ids="binary", loss="array<struct<a:int,z:int>>").filter("octet_length(ids) > 0")

    def run(batches):
        def lists():
            for batch in batches:
                docs, raws, losses = (c.to_pylist() for c in batch.columns)
                ids = [np.frombuffer(r, "<u4") for r in raws]
                yield [(d, i, merged(s and [(x["a"], x["z"]) if x else None for x in s] if s is not None else None, len(i))) for d, i, s in zip(docs, ids, losses)]

        yield from _packed(lists(), limits)

    return rows.mapInArrow(run, PIECES)


def pack_texts(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID) -> DataFrame:
    """Pieces of whole texts (doc_id, text), each with ``end_id`` behind it; every id bears loss."""

    def run(batches):
        lib, end = encoder(tokenizer), np.array([end_id], "<u4")

        def lists():
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                yield [(d, np.concatenate([i, end]), None) for d, i in zip(batch.column(0).to_pylist(), lib.encode(texts))]

        yield from _packed(lists(), limits)

    return documents(docs).mapInArrow(run, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op13."""
    pieces = pack_texts(read(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "n_loss")
