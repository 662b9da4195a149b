"""Helpers shared by the training-data operators: inputs, scratch tables, skew-proof joins, packed blocks."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.session import checkpoint_dir, ship_package

#: Rows sent to a Python worker at once, by size, so that long texts never pile up in one batch.
ARROW_BATCH = "8m"
#: Stands for a null doc_id inside packed blocks; sorts after every real id.
NO_ID = np.iinfo(np.int64).max
#: Keys with over 1/HEAVY of all rows are heavy: there are fewer than HEAVY of them, so they can be broadcast.
HEAVY = 1000


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns only, by exact spelling (the first of equal names), cast; other columns cannot clash."""
    first = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{first[n]}").cast(t).alias(n) for n, t in types.items()])


def documents(df: DataFrame) -> DataFrame:
    return pick(df, doc_id="long", text="string")


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    prepare(spark)
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text leaves remainder 2; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


def text_key() -> Column:
    """Tells apart different texts under one doc_id."""
    return F.xxhash64("text")


def hot_key_join(left: DataFrame, right: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join on ``key`` where ``right`` has one row a key and, in ``count``, that key's rows in ``left``.

    Heavy keys (over 1/HEAVY of ``total`` rows, so fewer than HEAVY keys) are broadcast and never
    shuffled; the rest is a plain shuffle join whose largest key is bounded by total/HEAVY.  Left rows
    with a null key match nothing.
    """
    is_heavy = F.col(count) * HEAVY > F.lit(total)
    heavy = F.broadcast(right.filter(is_heavy))
    marked = left.join(F.broadcast(right.filter(is_heavy).select(key, F.lit(True).alias("__heavy"))), key, "left")
    hot = marked.filter("__heavy").drop("__heavy").join(heavy, key, "inner")
    rest = marked.filter("__heavy is null").drop("__heavy").join(right.filter(~is_heavy), key, how)
    return hot.unionByName(rest)


class Numbers(dict):
    """Numbers texts in the order in which they are first looked up, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def of(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def fresh(self) -> list[str]:
        new, self.new = self.new, []
        return new


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` written as a table bucketed by ``keys``: any number of groupings by them then need no shuffle."""
    spark, n = df.sparkSession, partitions(df.sparkSession)
    path, table = scratch(spark, name), f"{name}_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.format("parquet").option("path", path).bucketBy(n, *keys).saveAsTable(table)
    return spark.table(table)


# ---------------------------------------------------------------- packed blocks


#: One element a piece: rid numbers the row, ``skip`` bytes of ``size`` lead and belong to the piece before, ``own`` are the piece's.
PIECES = "block long, rid array<long>, doc array<long>, th array<long>, off array<long>, skip array<int>, own array<int>, size array<int>, last array<boolean>, train array<boolean>, data binary"


def _cuts(raw: bytes, size: int) -> list[int]:
    """Cut points of a long text: after white space where there is some, so that no word is cut."""
    cuts, at = [0], 0
    while len(raw) - at > size:
        spaces = np.frombuffer(raw, np.uint8, size, at)
        found = np.flatnonzero((spaces == 32) | ((spaces >= 9) & (spaces <= 13)))
        if found.size:
            at += int(found[-1]) + 1
        else:
            rest = np.frombuffer(raw, np.uint8, offset=at + size)
            found = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
            at = at + size + int(found[0]) + 1 if found.size else len(raw)
        if at < len(raw):
            cuts.append(at)
    return [*cuts, len(raw)]


def pack(docs: DataFrame, name: str, block_bytes: int = 4 << 20, before: int = 0, after: int = 0) -> DataFrame:
    """Whole texts packed into rows of about ``block_bytes``, written as a table bucketed by ``block``.

    ``docs`` has doc_id, text, train, and perhaps extra (a string that travels with the row).  A text longer than a block is cut into pieces, each with
    ``before``/``after`` bytes of its neighbours (``skip`` of them lead).  A row is never split between
    tasks, so every later pass sees the same blocks, and joins on ``block`` do not move the texts.
    """
    spark = docs.sparkSession
    more = ["extra"] if "extra" in docs.columns else []
    rows = docs.select("doc_id", text_key().alias("th"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), "train", *more)

    def blocks(batches):
        import pyarrow as pa

        task, n, rid = TaskContext.get().partitionId(), 0, 0
        width = 10 + len(more)
        cols, total = [[] for _ in range(width)], 0

        def row():
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.bool_()] * 2 + [pa.string()] * len(more)
            names = ["rid", "doc", "th", "off", "skip", "own", "size", "last", "train", *more]
            arrays = [pa.array([(task << 32) + n], pa.int64())]
            arrays += [pa.array([c], pa.list_(k)) for c, k in zip(cols, kinds)]
            arrays.append(pa.array([b"".join(cols[-1])], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=["block", *names, "data"])

        for batch in batches:
            for doc, th, raw, train, *extra in zip(*[c.to_pylist() for c in batch.columns]):
                rid += 1
                cuts = _cuts(raw, block_bytes)
                for start, end in zip(cuts, cuts[1:]):
                    lo = max(0, start - before)
                    part = raw[lo : end + after]
                    for c, v in zip(cols, ((task << 32) + rid, NO_ID if doc is None else doc, th, start, start - lo, end - start, len(part), end == len(raw), train, *extra, part)):
                        c.append(v)
                    total += len(part)
                    if total >= block_bytes:
                        yield row()
                        cols, total, n = [[] for _ in range(width)], 0, n + 1
        if cols[0]:
            yield row()
        cols.clear()
        give_back()

    path = scratch(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    shape = PIECES.replace("data binary", "extra array<string>, data binary") if more else PIECES
    (rows.mapInArrow(blocks, shape).write.format("parquet").option("path", path).option("compression", "zstd")
         .bucketBy(partitions(spark), "block").saveAsTable(table))
    return spark.table(table)


def beside(blocks: DataFrame, *sides: DataFrame) -> DataFrame:
    """Each block with its ``side0``, ``side1``... : lists of (bucket, blob) that other passes left for it."""
    for i, side in enumerate(sides):
        listed = side.groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias(f"side{i}"))
        blocks = blocks.join(listed, "block", "left")
    return blocks


def give_back() -> None:
    """At the end of a task: memory that a reused Python worker holds without need goes back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def blob_rows(block: int, bucket, blobs: list[bytes]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([block] * len(blobs), pa.int64()), pa.array(bucket, pa.int32()), pa.array(blobs, pa.binary())], names=["block", "bucket", "blob"])


BLOBS = "block long, bucket int, blob binary"


def buckets(blocks: DataFrame) -> int:
    """As many buckets as blocks: a bucket then holds about as much as a block does."""
    return max(16, partitions(blocks.sparkSession), blocks.count())


# ------------------------------------------------------------- 64-bit hashing


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for pairs of 64-bit names."""
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += b * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays packed into one compressed blob; ``unsqueeze`` wants their types back."""
    import zstandard

    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unsqueeze(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out
