"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiresight.llm.common import session_of, shared_path
from hiresight.llm.decontaminate import contaminated_passages
from hiresight.llm.exact_dedup import exact_dedup
from hiresight.llm.hard_negatives import hard_negatives
from hiresight.llm.html_wrappers import extract_main_text
from hiresight.llm.jaccard import jaccard_components
from hiresight.llm.langid import language_id
from hiresight.llm.lexical_search import ranked_search
from hiresight.llm.line_dedup import apply_keep_bitmaps, line_keep_bitmaps
from hiresight.llm.lm import lm_scores
from hiresight.llm.packing import pack
from hiresight.llm.quality import quality_scores
from hiresight.llm.substring_dedup import repeated_spans
from hiresight.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
LONG_TOKENS = 1024


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    session_of(docs)
    return docs


#: A-Z to a-z and nothing else, in SQL
SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_exact_dedup", f"""
    WITH t AS (SELECT doc_id, {SQL_LOWER} AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
    FROM t""")
def op1(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


@query("op2_token_counts")
def op2(spark, sf_dir):
    counts = token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), shared_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LONG_TOKENS).alias("over_limit"))


@query("op3_packing")
def op3(spark, sf_dir):
    return pack(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), window=1024)


SQL_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op7_line_dedup", f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
    n AS (SELECT doc_id, pos, line, {SQL_LOWER.replace("coalesce(text, '')", f"trim(line, {SQL_SPACE})")} AS key FROM l),
    k AS (SELECT key, max(doc_id) AS top FROM n WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
    SELECT n.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE top IS NOT NULL AND n.doc_id <> top) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE top IS NULL OR n.doc_id = top), '')) AS kept_sha256
    FROM n LEFT JOIN k USING (key) GROUP BY n.doc_id""")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = apply_keep_bitmaps(docs, line_keep_bitmaps(docs))
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op10_lm_scoring")
def op10(spark, sf_dir):
    return lm_scores(documents(spark, sf_dir))


@query("op4_language_id")
def op4(spark, sf_dir):
    return language_id(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


@query("op6_html_extraction")
def op6(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


@query("op5_substring_dedup")
def op5(spark, sf_dir):
    return repeated_spans(documents(spark, sf_dir))


@query("op8_decontamination")
def op8(spark, sf_dir):
    return contaminated_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op9_jaccard_join")
def op9(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


@query("op11_quality_classifier")
def op11(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op12_hard_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
          FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) QUALIFY rank <= 3""")
def op12(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), anchor="vec_id % 50 = 0")


SQL_TERMS = f"regexp_extract_all({SQL_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op13_lexical_search", f"""
    WITH d AS (SELECT doc_id, {SQL_TERMS} AS ts FROM documents),
    g AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
    m AS (SELECT doc_id, 75 + (25 * len(ts) * n_docs) // n_terms AS m FROM d, g WHERE len(ts) > 0),
    t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, g GROUP BY term, n_docs),
    i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL),
    s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM i JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 20""")
def op13(spark, sf_dir):
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
