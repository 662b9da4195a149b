"""The corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of documents.  Rows are told apart by doc_id and
the hash of their text, so null and repeated ids are kept apart; exact repeats of a row are near duplicates
and leave with them.  Texts of any length go whole; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.llm import decontaminate, hyper_language, sentencepieces, simhash_tiles, suffix_dedup
from planmatch.llm.common import held_out, pick, read, scratch

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _keyed(docs: DataFrame) -> DataFrame:
    return pick(docs, **COLUMNS).withColumn("th", F.xxhash64("text"))


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["id2"]) & (a["th"] == b["th2"])


def _keys(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(F.col("doc_id").alias("id2"), F.col("th").alias("th2"), *more)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language (null, or no letter); a null lang becomes the predicted one."""
    rows = pick(docs, **COLUMNS)
    model = hyper_language.learn(rows.filter(~held_out(F.col("doc_id"), 4)))
    if not model[0]:  # no training row has a language: nothing to compare with, letters alone decide
        return rows.filter(hyper_language.has_letters(F.col("text"), model[1].shape[1]))
    kept = rows.withColumn("p", hyper_language.language(F.col("text"), model)).filter(F.col("p.lang_pred") != hyper_language.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "p.lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each component's first document (least doc_id)."""
    rows = _keyed(docs)
    firsts = _keys(simhash_tiles.simhash_components(rows).filter("keeps")).distinct()
    return rows.join(firsts, _same(rows, firsts), "left_semi").dropDuplicates(["doc_id", "th"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes of passages that an earlier document has; half characters at a cut's edges go too, as do texts cut whole.

    The other columns travel with the texts through the operator, so nothing is joined to them afterwards.
    """
    kind = "struct<lang:string,source:string,n_chars:long,none:boolean>"
    rows = pick(docs, **COLUMNS)
    rows = rows.select("doc_id", "text", F.to_json(F.struct("lang", "source", "n_chars", F.col("text").isNull().alias("none"))).alias("extra"))

    @F.pandas_udf("string")
    def decoded(kept):
        return kept.map(lambda b: None if b is None else b.decode("utf-8", "ignore"))

    found = suffix_dedup.dedup(rows).withColumn("x", F.from_json("extra", kind))
    cut = F.col("n_removed") > 0
    # asNondeterministic: decoded once, though a filter and two columns use it
    found = found.withColumn("cut", decoded.asNondeterministic()(F.when(cut, F.col("kept"))))
    text = F.when(cut, F.col("cut")).when(~F.col("x.none"), F.col("kept").cast("string"))
    n_chars = F.when(cut, F.length("cut").cast("long")).otherwise(F.col("x.n_chars"))
    return found.filter(~cut | (F.col("cut") != "")).select("doc_id", text.alias("text"), "x.lang", "x.source", n_chars.alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    rows = _keyed(docs)
    hit = _keys(decontaminate.contamination(rows, read(spark, sf_dir, "benchmark")).filter("n_hit > 0")).distinct()
    return rows.join(hit, _same(rows, hit), "left_anti").select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left, decodes it again, and returns both digests."""
    return sentencepieces.digests(docs, sentencepieces.model_path())


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("suffix_array_dedup", repeated_passages),
          ("benchmark_decontamination", benchmark_leaks), ("sentencepiece", token_ids)]

#: SQL can't express SimHash components, prefix doubling or SentencePiece; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each one's rows written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
