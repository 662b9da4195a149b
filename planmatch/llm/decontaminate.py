"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is 10 consecutive words of an item (an item of fewer words is one window).  For a containment of
1, the necessary prefix of a window's shingles, ordered from rare to common over all documents, is its
rarest shingle alone: a document that holds the window holds that shingle.  Document shingles are joined
with those prefixes; the shingle's place in the window bounds where the window would start and end in the
document, and the words there are compared with the window's.

Null and empty texts have no words: such documents get zero hits, such items no windows.  A null item_id
still marks words but is listed under no item; items are told apart by item_id.  Repeated document rows
each get their row.  An empty benchmark marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm.common import documents, pick, read, saved, text_key

WINDOW = 10
SHINGLE = 5
#: A side of the prefix join is broadcast up to this many rows; beyond, the join shuffles.
BROADCAST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct windows: wtext, wwords, wlen, items (the ids of the items that hold it)."""
    items = pick(benchmark, item_id="long", text="string").select("item_id", words_of(F.col("text")).alias("words"))
    items = items.groupBy("words").agg(F.collect_set("item_id").alias("ids")).filter(F.size("words") > 0)
    n = F.size("words")
    wlen = F.least(n, F.lit(window))
    each = items.select("words", "ids", wlen.alias("wlen"), F.explode(F.sequence(F.lit(1), n - wlen + 1)).alias("at"))
    each = each.select("ids", "wlen", F.slice("words", F.col("at"), F.col("wlen")).alias("wwords"))
    return (each.withColumn("wtext", F.array_join("wwords", " ")).groupBy("wtext", "wlen")
                .agg(F.first("wwords").alias("wwords"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items")))


def _positions(words: DataFrame, k: int) -> DataFrame:
    """Every shingle of k words of every document."""
    at = F.explode(F.sequence(F.lit(0), F.col("n_words") - k)).alias("at")
    return (words.filter(F.col("n_words") >= k).select("rid", "n_words", "words", at)
                 .withColumn("h", F.xxhash64(F.slice("words", F.col("at") + 1, k))))


def _small(df: DataFrame, rows: int) -> DataFrame | None:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else None


def occurrences(words: DataFrame, windows: DataFrame, shingle: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Where each window occurs: rid, start, wlen, items.  ``words`` has rid, words, n_words."""
    k = F.least(F.col("wlen"), F.lit(shingle))
    shingles = (windows.select("*", k.alias("k")).withColumn("off", F.explode(F.sequence(F.lit(0), F.col("wlen") - F.col("k"))))
                       .withColumn("h", F.xxhash64(F.slice("wwords", F.col("off") + 1, F.col("k")))))
    shingles = saved(shingles.select("wtext", "wlen", "wwords", "items", "k", "off", "h"), "shingles")
    lengths = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most ``shingle`` numbers
    found = None
    for k in lengths:
        own, here = shingles.filter(F.col("k") == k), _positions(words, k)
        kinds = own.select("h").distinct()
        counts = here.select("h").join(_small(kinds, broadcast_rows) or kinds, "h").groupBy("h").agg(F.count("*").alias("n"))
        prefix = (own.join(counts, "h").groupBy("wtext").agg(F.min(F.struct("n", "h", "off")).alias("least"),
                                                             *[F.first(c).alias(c) for c in ("wlen", "wwords", "items")]))
        prefix = saved(prefix.select("wtext", "wlen", "wwords", "items", "least.h", "least.off"), "prefixes")
        start = F.col("at") - F.col("off")
        fits = (start >= 0) & (start + F.col("wlen") <= F.col("n_words"))
        small = _small(prefix, broadcast_rows)
        if small is not None:
            hits = here.join(small, (here["h"] == small["h"]) & fits & (F.slice("words", F.col("at") - F.col("off") + 1, F.col("wlen")) == F.col("wwords")))
            hits = hits.select("rid", start.alias("start"), "wlen", "items")
        else:
            near = here.select("rid", "n_words", "at", "h").join(prefix, "h").filter(fits).select("rid", start.alias("start"), "wlen", "wwords", "items")
            hits = near.join(words.select("rid", "words"), "rid").filter(F.slice("words", F.col("start") + 1, F.col("wlen")) == F.col("wwords"))
            hits = hits.select("rid", "start", "wlen", "items")
        found = hits if found is None else found.unionByName(hits)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document row: doc_id, th (hash of its text), n_words, n_hit, item_ids, spans (start and length of each hit window)."""
    rows = documents(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_key().alias("th"), words_of(F.col("text")).alias("words"))
    words = saved(rows.withColumn("n_words", F.size("words")), "words")
    hits = occurrences(words, windows_of(benchmark, window), shingle, broadcast_rows)
    base = words.select("rid", "doc_id", "th", "n_words")
    nothing = F.array().cast("array<bigint>")
    if hits is None:
        return base.select("*", F.lit(0).alias("n_hit"), nothing.alias("item_ids"), F.array().cast("array<struct<start:int,wlen:int>>").alias("spans"))
    each = hits.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "wlen"))).alias("spans"),
                                   F.array_distinct(F.flatten(F.collect_set("items"))).alias("item_ids"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["start"] + x["wlen"] - F.greatest(a["end"], x["start"]))).alias("n"),
                                                F.greatest(a["end"], x["start"] + x["wlen"]).alias("end")),
                          lambda a: a["n"])
    return (base.join(each.withColumn("n_hit", covered), "rid", "left")
                .withColumn("n_hit", F.coalesce("n_hit", F.lit(0))).withColumn("item_ids", F.coalesce("item_ids", nothing)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op2."""
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
                        F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
