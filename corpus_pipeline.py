"""Corpus pipeline: language, lines, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; every stage's
result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiresight.llm import decontaminate, jaccard, langid, line_dedup, packing
from hiresight.llm.common import session_of, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: a text is rejected when no language is this likely, or when it has no letter
LEAST_POSTERIOR = 0.5
#: bytes of an Arrow batch: workers live through all stages, so each stage's batches add to what they hold
BATCH_BYTES = 4 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a predicted language; labels of all rows train the model.

    Null and empty texts go; rows that repeat an id are each judged; an empty table stays empty."""
    session_of(docs, BATCH_BYTES)
    docs = docs.select(COLUMNS)
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    kept = langid.predict(docs, model).where((F.col("__lang_pred") != langid.UNDETERMINED) & (F.col("__score") >= LEAST_POSTERIOR))
    return kept.select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines from the texts; every document stays, null texts as they are.

    Rows that repeat an id are one document when documents with a line are counted."""
    session_of(docs, BATCH_BYTES)
    docs = docs.select(COLUMNS)
    return (line_dedup.apply_keep_bitmaps(docs, line_dedup.line_keep_bitmaps(docs)).select(COLUMNS)
            .withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts that share 80 % of their five-word shingles the
    row with the smallest id stays (a null id counts as the largest; a text without words is its own).

    Rows are told apart by (id, text), not by id: rows that share an id, but not
    the text, stand for themselves, and of rows that share both one stays.  An
    empty table stays empty."""
    session_of(docs, BATCH_BYTES)
    docs = docs.select(COLUMNS).withColumn("__key", F.xxhash64("doc_id", "text"))
    groups = stage(jaccard.jaccard_components(docs, id_col="__key", size=5, percent=80).select(F.col("doc_id").alias("__key"), "component_id"), "components")
    named = groups.distinct().join(docs.select("__key", "doc_id").distinct(), "__key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("f")).select("component_id", F.col("f.__key").alias("__stays"))
    gone = groups.join(first, "component_id").where(F.col("__key") != F.col("__stays")).select(F.col("__key").alias("__gone")).distinct()
    again = groups.groupBy(F.col("__key").alias("__again")).count().where("count > 1").select("__again")
    left = docs.join(gone.hint("shuffle_hash"), F.col("__key") == F.col("__gone"), "left_anti")
    once = left.join(again, F.col("__key") == F.col("__again"), "left_anti")
    more = left.join(again, F.col("__key") == F.col("__again"), "left_semi").dropDuplicates(["__key"])
    return once.unionByName(more).select(COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item, exact or edited; null texts hold none,
    rows that repeat an id are each judged, and without documents or items nothing is dropped."""
    session_of(docs, BATCH_BYTES)
    return decontaminate.drop_contaminated(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens; a null text is empty (its end
    alone), rows that repeat an id are each packed, and an empty table has no pieces."""
    session_of(docs, BATCH_BYTES)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: no stage but the second is expressible in SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
