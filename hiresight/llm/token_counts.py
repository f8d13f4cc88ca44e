"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by the
SHA-256 of its file and of how it is called.  Texts whose pair of digests is in
the cache take the stored count; only distinct misses are encoded, and their
counts are appended to the cache, a Parquet table in a shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, path_exists, session_of
from hiresight.llm.tokens import encoder

CACHE_DDL = "digest binary, tokenizer binary, n_tokens long"


def tokenizer_digest(path: str) -> bytes:
    """Version of a tokenizer: its file and the options it is called with."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"|add_special_tokens=False").digest()


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        spark.createDataFrame([], CACHE_DDL).write.parquet(path)
    return spark.read.schema(CACHE_DDL).parquet(path)


def _first_in_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop texts whose digest this split has already sent on (a hot text
    leaves each split once); 32 bytes a distinct text are held."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for d in b.column(0).to_pylist():
            keep.append(d not in seen)
            seen.add(d)
        yield b.filter(pa.array(keep))


def _encode_distinct(path: str, version: bytes):
    schema = arrow_schema({"digest": pa.binary(), "tokenizer": pa.binary(), "n_tokens": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(path, True), set()
        for b in batches:
            out = []
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if d not in seen:
                    seen.add(d)
                    out.append((d, enc.encode(text)))
            if out:
                yield batch(schema, digest=[x[0] for x in out], tokenizer=[version] * len(out), n_tokens=[x[1] for x in out])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens (whole text, no special
    tokens added, no truncation or padding).

    Null text counts as empty (0 bytes, 0 tokens).  Ids may be null or repeat:
    rows are matched by content only.  ``normalise`` is applied before both the
    digest and the encoding.  An empty table gives an empty result; other
    columns are ignored.  ``tokenizer_path`` must exist on the executors, as an
    installed package's file does.

    The texts cross one exchange (by digest), which serves the anti-join
    against the cache and the distinct; the result joins narrow rows only.
    """
    spark = session_of(docs)
    version = tokenizer_digest(tokenizer_path)
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    known = open_cache(spark, cache_path).where(F.col("tokenizer") == F.lit(version)).select("digest")
    misses = (docs.select(digest.alias("digest"), text.alias("text"))
              .mapInArrow(_first_in_split, "digest binary, text string")
              .repartition("digest").join(known.hint("shuffle_hash"), "digest", "left_anti"))
    misses.mapInArrow(_encode_distinct(tokenizer_path, version), CACHE_DDL).write.mode("append").parquet(cache_path)
    # another job may have appended the same misses meanwhile: one row a digest
    stored = (open_cache(spark, cache_path).where(F.col("tokenizer") == F.lit(version))
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return (docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"),
                        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
            .join(stored, "digest").select("doc_id", "n_bytes", "n_tokens"))
