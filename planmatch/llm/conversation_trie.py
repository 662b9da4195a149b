"""Prefix trie of conversations by fixed-length blocks of turns.

Every conversation is cut into blocks of BLOCK_TURNS turns.  A block is known by the digest of all turns up to its
end, so one grouping by this digest finds which conversations go through it.  Only where a block has siblings
(other blocks with the same turns before them) are turns looked at one by one: the distinct siblings are exploded
into their turns and grouped again.  In a block without siblings every turn has the block's conversations.

Sums over subtrees need no walk through the levels.  The smallest conversation through a node owns it, so each
conversation owns the end of its path; the words before that (shared with smaller ones) are what it saves.  With
X(c) these words and T the words on the path to a node's parent, a node saves the sum of X - T over its
conversations but the smallest.

Long conversations are no single group: turns are sorted by ranges and read in stretches, and one that goes over
several stretches is carried on from a summary of each.  Turns are told apart by 128 bits of SHA-256 over role and
text, sequences by a polynomial of these modulo a prime of 127 bits, and by their depth.

Turns of null conv_id take no part; null role or text is empty; null turns come first; rows of equal turn go by
their digest (repeats are turns of their own); texts of any length; an empty table has no root and gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import copy
import hashlib
import json
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planmatch.llm.common import hot_key_join, pick, read, saved

BLOCK_TURNS = 8
#: Turns read as one row, and ids hashed as one.
STRETCH_TURNS, PIECE_IDS = 1 << 18, 1 << 13
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix trie").digest(), "big") % PRIME
ROOT = bytes(24)
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Heads:
    """Shared heads: the first turns of a conversation are those of the one whose id is the next lower multiple."""

    every: int = 20
    kinds: int = 4

    def length(self, conv_id: int) -> int:
        """Turns of the head: the id's crc32 modulo ``kinds``."""
        return zlib.crc32(str(conv_id).encode()) % self.kinds

    def base(self, conv_id: int) -> int:
        """The conversation whose head it shares: the next multiple towards zero."""
        return conv_id - abs(conv_id) % self.every * (1 if conv_id > 0 else -1)

    def columns(self, conv_id):
        return conv_id - conv_id % self.every, F.crc32(conv_id.cast("string").cast("binary")) % self.kinds


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, words of every turn; the texts stay behind."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string").filter("conv_id is not null")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")})
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.unhex(F.substring(F.sha2(told, 256), 1, 32))
    return rows.select("conv_id", "turn", digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


# ------------------------------------------------------- paths, over stretches of sorted turns


class Path:
    """A conversation as far as read: own turns seen, depth, digest and words of its rebuilt turns, and its open block."""

    def __init__(self, skip: int, block_turns: int, heads: list = ()):
        self.skip, self.block_turns = skip, block_turns
        self.seen, self.depth, self.value, self.power, self.total = 0, 0, 0, 1, 0
        self.start, self.parent, self.turns = 0, ROOT, []
        for g, w in heads[:skip]:
            self.push(g, w)

    def push(self, digest: int, words: int) -> bool:
        """One more rebuilt turn; whether it ends a block."""
        self.depth += 1
        self.power = self.power * BASE % PRIME
        self.value = (self.value + digest * self.power) % PRIME
        self.total += words
        self.turns.append({"node": self.depth.to_bytes(8, "big") + self.value.to_bytes(16, "big"), "words": words, "total": self.total})
        return self.depth % self.block_turns == 0

    def own(self, digest: int, words: int) -> bool:
        self.seen += 1
        return self.seen > self.skip and self.push(digest, words)

    def take(self) -> tuple[int, bytes, list]:
        """The open block (turns before it, its parent, its turns), which is open no more."""
        block = (self.start, self.parent, self.turns)
        self.start, self.parent, self.turns = self.depth, self.turns[-1]["node"], []
        return block

    def carry_on(self, told: dict) -> None:
        """Behind a stretch that is known by its summary only."""
        for g, w in told["first"]:
            if self.own(g, w):
                self.take()
        n, value, words = told["middle"]
        if n:
            self.seen, self.depth, self.total, self.turns = self.seen + n, self.depth + n, self.total + words, []
            self.value = (self.value + self.power * value) % PRIME
            self.power = self.power * pow(BASE, n, PRIME) % PRIME
        for g, w in told["last"]:  # as many as a block has, so that the open one is known again
            if self.own(g, w):
                self.take()


def summary(digests: list[int], words: list[int], kinds: int, block_turns: int) -> dict:
    """What a path needs of its turns in one stretch: the first, which may be skipped, the last, and the rest as one sum."""
    pairs = list(zip(digests, words))
    first, rest = pairs[:kinds], pairs[kinds:]
    middle, last = rest[:-block_turns], rest[-block_turns:]
    power, value = 1, 0
    for g, _ in middle:
        power = power * BASE % PRIME
        value = (value + g * power) % PRIME
    return {"first": first, "middle": (len(middle), value, sum(w for _, w in middle)), "last": last}


STRETCH = "no long, conv binary, digest binary, words binary, first long, last long, head string, tail string"
BLOCKS = "conv_id long, start long, parent binary, node binary, turns array<struct<node:binary,words:long,total:long>>"


def _digests(raw: bytes, a: int, z: int) -> list[int]:
    return [int.from_bytes(raw[16 * i : 16 * i + 16], "big") for i in range(a, z)]


def _runs(conv: np.ndarray) -> list[tuple[int, int]]:
    bounds = [0, *(np.flatnonzero(np.diff(conv)) + 1).tolist(), len(conv)]
    return list(zip(bounds, bounds[1:]))


def stretches(turns: DataFrame, heads: Heads | None, block_turns: int, size: int) -> DataFrame:
    """Turns in order, packed into rows that no task splits: conversations that share a head follow the one that has it.

    first, last: conversations at both ends; tail: summary of the last one's turns; head: first turns of the one
    whose head it shares, if they lie here too.
    """
    base = heads.columns(F.col("conv_id"))[0] if heads else F.col("conv_id")
    kinds = heads.kinds if heads else 1
    turns = turns.withColumn("base", base).withColumn("tie", F.monotonically_increasing_id())
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest", "tie"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words")

    def packed(batches):
        import pyarrow as pa

        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
        kinds_of = [pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["no", "conv", "digest", "words", "first", "last", "head", "tail"]

        def row():
            nonlocal seq
            table = pa.Table.from_batches(held).combine_chunks()
            conv, words = table.column(0).to_numpy(), table.column(2).to_numpy()
            raw, last = b"".join(table.column(1).to_pylist()), int(conv[-1])
            a, z = _runs(conv)[-1]
            tail = summary(_digests(raw, a, z), words[a:z].tolist(), kinds, block_turns)
            at = np.flatnonzero(conv == (heads.base(last) if heads else last))[:kinds]
            head = [(g, int(words[i])) for i in at.tolist() for g in _digests(raw, i, i + 1)]
            values = [(part << 24) + seq, conv.astype("<i8").tobytes(), raw, words.astype("<i8").tobytes(), int(conv[0]), last, json.dumps(head) if head else None, json.dumps(tail)]
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds_of)], names=names)

        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, size - n)
                held.append(piece)
                n, batch = n + piece.num_rows, batch.slice(piece.num_rows)
                if n == size:
                    yield row()
                    held, n = [], 0
        if n:
            yield row()

    return ordered.mapInArrow(packed, STRETCH)


class Reader:
    """Where reading stands between two turns of the order: the conversation, its path, and the head it may share."""

    def __init__(self, heads: Heads | None, block_turns: int):
        self.heads, self.block_turns = heads, block_turns
        self.conv = self.base = self.path = None
        self.head: list = []

    def open(self, conv: int) -> None:
        """From here on ``conv``; nothing happens if it is open already."""
        if conv == self.conv:
            return
        base = self.heads.base(conv) if self.heads else conv
        if base != self.base:
            self.base, self.head = base, []
        self.conv = conv
        shares = self.heads is not None and conv != base
        self.path = Path(self.heads.length(conv) if shares else 0, self.block_turns, self.head)

    def read(self, digest: int, words: int) -> bool:
        if self.conv == self.base and self.heads and len(self.head) < self.heads.kinds:
            self.head.append((digest, words))
        return self.path.own(digest, words)


def carried(rows: DataFrame, heads: Heads | None, block_turns: int) -> tuple[dict[int, Reader], set[int]]:
    """How each stretch begins, and those whose last conversation goes on.  One short line a stretch comes to the driver."""
    begins, goes_on, reader, before = {}, set(), Reader(heads, block_turns), None
    for r in sorted(rows.select("no", "first", "last", "head", "tail").collect()):
        begins[r["no"]] = copy.deepcopy(reader)
        if reader.conv == r["first"]:
            goes_on.add(before)
        before, had, open_conv = r["no"], reader.head, reader.conv
        local = [tuple(x) for x in json.loads(r["head"])] if r["head"] else []
        if heads and local:
            base = heads.base(r["last"])
            same = open_conv == base and r["first"] == base  # the one that has the head goes over both stretches
            head = (had + local)[: heads.kinds] if same else local
            if base != reader.base:
                reader.base = base
            reader.head = head
        reader.open(r["last"])
        reader.path.carry_on(json.loads(r["tail"]))
    return begins, goes_on


def blocks_of(rows: DataFrame, heads: Heads | None, block_turns: int) -> DataFrame:
    """conv_id, start, parent, node, turns: every conversation's blocks; one without turns has a row of start -1."""
    begins, goes_on = carried(rows, heads, block_turns)

    def cut(batches):
        import pyarrow as pa

        turn = pa.struct([("node", pa.binary()), ("words", pa.int64()), ("total", pa.int64())])
        schema = pa.schema([("conv_id", pa.int64()), ("start", pa.int64()), ("parent", pa.binary()), ("node", pa.binary()), ("turns", pa.list_(turn))])
        out: list[dict] = []

        def block(conv, path):
            start, parent, turns = path.take()
            out.append({"conv_id": conv, "start": start, "parent": parent, "node": turns[-1]["node"], "turns": turns})

        for batch in batches:
            for r in batch.to_pylist():
                conv, words = np.frombuffer(r["conv"], "<i8"), np.frombuffer(r["words"], "<i8").tolist()
                reader = copy.deepcopy(begins[r["no"]])
                for a, z in _runs(conv):
                    c = int(conv[a])
                    reader.open(c)
                    path = reader.path
                    for g, w in zip(_digests(r["digest"], a, z), words[a:z]):
                        if reader.read(g, w):
                            block(c, path)
                    if z == len(conv) and r["no"] in goes_on:
                        continue
                    if path.turns:
                        block(c, path)
                    if not path.depth:
                        out.append({"conv_id": c, "start": -1, "parent": None, "node": ROOT, "turns": []})
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out.clear()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select("no", "conv", "digest", "words").mapInArrow(cut, BLOCKS)


# ----------------------------------------------------------------------------- the trie


def digest_of_ids(rows: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """node, sha: SHA-256 over each node's ascending conv_ids, comma-joined; hashed from pieces, never a whole list."""
    ordered = rows.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").select("node", "conv_id")

    def joined(batches):
        import pyarrow as pa

        node, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "least": pa.array([ids[0]], pa.int64()), "listed": pa.array([",".join(map(str, ids)).encode()], pa.binary())})

        for batch in batches:
            pieces = []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node or len(ids) == piece_ids:
                    if ids:
                        pieces.append(piece())
                    node, ids = n, []
                ids.append(c)
            if pieces:
                yield pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    pieces = ordered.mapInArrow(joined, "node binary, least long, listed binary")

    def hashed(batches):
        import pyarrow as pa

        node, sha = None, None
        for batch in batches:
            nodes, shas = [], []
            for n, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n == node:
                    sha.update(b"," + listed)
                    continue
                if sha is not None:
                    nodes.append(node)
                    shas.append(sha.hexdigest())
                node, sha = n, hashlib.sha256(listed)
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "sha": pa.array(shas, pa.string())})
        if sha is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "sha": pa.array([sha.hexdigest()], pa.string())})

    grouped = pieces.repartition("node").sortWithinPartitions("node", "least").select("node", "listed")
    return grouped.mapInArrow(hashed, "node binary, sha string")


def by_turns(blocks: DataFrame, *more: str) -> DataFrame:
    """Distinct blocks as their turns: node, depth, parent, words, total and what the block has besides."""
    rows = blocks.select("start", F.col("parent").alias("before"), "turns", *more, F.posexplode("turns").alias("i", "t"))
    parent = F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("turns", F.col("i") - 1).node)
    return rows.select(F.col("t.node").alias("node"), (F.col("start") + F.col("i") + 1).alias("depth"), parent.alias("parent"), F.col("t.words").alias("words"), F.col("t.total").alias("total"), *more)


def prefix_trie(conversations: DataFrame, heads: Heads | None = None, block_turns: int = BLOCK_TURNS, stretch_turns: int = STRETCH_TURNS) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included.

    node and parent (24 bytes, depth first), depth, conv_id and parent_conv_id (smallest conversations through
    them), words and total (words of the node's last turn, and of all its turns), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.  With ``heads`` conversations first take the turns of the one they share a head with.
    """
    turns = saved(turn_rows(conversations), "trie-turns")
    rows = saved(stretches(turns, heads, block_turns, stretch_turns), "trie-stretches")
    begun = saved(blocks_of(rows, heads, block_turns), "trie-blocks")
    n_blocks = begun.count()
    blocks = begun.filter("start >= 0")

    # which conversations go through each block, and which blocks have siblings
    distinct = blocks.groupBy("node").agg(F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("n"), F.first("start").alias("start"), F.first("parent").alias("parent"), F.first("turns").alias("turns"))
    siblings = distinct.groupBy("parent").agg(F.count(F.lit(1)).alias("siblings"))
    marked = saved(hot_key_join(distinct, siblings, "parent", "siblings", n_blocks), "trie-marked")
    alone, beside = marked.filter("siblings = 1"), marked.filter("siblings > 1")
    same = [F.first(c).alias(c) for c in ("depth", "parent", "words", "total")]
    refined = by_turns(beside, "m", "n").groupBy("node").agg(F.min("m").alias("m"), F.sum("n").alias("n"), *same)
    zero = F.lit(0).cast("long")
    root = begun.filter("start <= 0").agg(F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 0").select(
        F.lit(ROOT).alias("node"), zero.alias("depth"), F.lit(None).cast("binary").alias("parent"), zero.alias("words"), zero.alias("total"), "m", "n")
    nodes = saved(root.unionByName(by_turns(alone, "m", "n")).unionByName(refined), "trie-nodes")
    edges = nodes.filter("parent is not null").select(F.col("parent").alias("node"), F.lit(1).alias("child"))
    own = ["depth", "parent", "words", "total", "m", "n"]
    counted = nodes.unionByName(edges, allowMissingColumns=True).groupBy("node").agg(*[F.max(c).alias(c) for c in own], F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"))
    nodes = saved(counted, "trie-counted")

    # per conversation: where it ends, the words it shares with smaller ones, whether it stands for a leaf
    last = begun.select("conv_id", F.struct("start", "node", F.coalesce(F.try_element_at("turns", F.lit(-1)).total, F.lit(0)).alias("total")).alias("z"), F.when(F.col("start") >= 0, 1).alias("block"))
    owned = nodes.select(F.col("m").alias("conv_id"), (F.col("total") - F.col("words")).alias("shared"), F.when(F.col("n_children") == 0, 1).alias("leaf"))
    stats = last.unionByName(owned, allowMissingColumns=True).groupBy("conv_id").agg(
        F.max("z").alias("z"), F.sum("block").alias("n_blocks"), F.min("shared").alias("shared"), F.coalesce(F.max("leaf"), F.lit(0)).alias("leaf"))
    stats = saved(stats.select("conv_id", "n_blocks", F.col("z.node").alias("node"), F.coalesce("shared", "z.total").alias("x"), "leaf"), "trie-stats")

    through = hot_key_join(blocks.select("conv_id", "node"), stats.filter("n_blocks is not null").select("conv_id", "n_blocks", "x", "leaf"), "conv_id", "n_blocks", n_blocks)
    sums = through.groupBy("node").agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaf"), F.min_by("x", "conv_id").alias("own_x"))
    known = marked.join(sums, "node")
    refined = by_turns(known, "m", "x", "leaf", "own_x").groupBy("node").agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaf"), F.min_by("own_x", "m").alias("own_x"))
    top = stats.agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaf"), F.min_by("x", "conv_id").alias("own_x")).select(F.lit(ROOT).alias("node"), "x", "leaf", "own_x")
    sums = top.unionByName(refined)

    parents = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("m").alias("parent_conv_id"), F.col("n_children").alias("of_parent"))
    rows = hot_key_join(nodes, parents, "parent", "of_parent", n_blocks, "left").join(sums, "node").join(digest_of_ids(stats), "node", "left")
    saves = F.col("x") - F.col("own_x") - (F.col("n") - 1) * (F.col("total") - F.col("words"))
    return rows.select("node", "parent", "depth", F.col("m").alias("conv_id"), "parent_conv_id", "words", "total", F.col("n").alias("n_convs"), "n_children",
                       F.col("leaf").alias("n_leaves"), saves.alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op12."""
    rows = prefix_trie(read(spark, sf_dir, "conversations"), Heads())
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
