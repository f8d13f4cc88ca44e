"""Posting layers: raw -> posting -> deduplicated -> domain -> clean.

Each step is a lazy DataFrame transform.  The layers that the reference writes
out (domain, clean, enriched) are written once as Parquet per state of the
input files; queries scan the columns they need of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import clean_city, parse_years, seniority_level
from ..functions.salary import salary_midpoint
from ..functions.skills import skill_extract_valid
from ..functions.text import detect_english, detect_remote
from ..operators.enrich import enrich_all
from ..operators.relational import (conform_schema, fill_missing_median, filter_domain,
                                    filter_salary_range, keep_first)
from ..session import layer
from ..sources.postings import raw_postings


def feed_rank():
    """feed_a first, then feed_b (keep-first order between feeds)."""
    return F.when(F.col("source") == "feed_a", F.lit(0)).otherwise(F.lit(1))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified posting record with explicit identity (post_id, source_rank)."""
    raw = raw_postings(spark, sf_dir)
    p = conform_schema(raw)
    return p.withColumn("source_rank", feed_rank()).select(
        "post_id", "source_rank", "source_url", "title", "company", "city_raw", "salary_min",
        "salary_max", "exp_raw", "description", "working_form", "source")


def dedup_postings(df: DataFrame) -> DataFrame:
    """One posting per (title, company), first in feed order wins."""
    return keep_first(df, ["title", "company"], ["source_rank", "post_id"])


def add_salary(df: DataFrame) -> DataFrame:
    return df.withColumn("salary", salary_midpoint("salary_min", "salary_max"))


def derive_clean_columns(df: DataFrame) -> DataFrame:
    """Years, city, skills, flags and level in one projection."""
    skills = skill_extract_valid(F.col("description"))
    years = parse_years(F.col("exp_raw"))
    return df.select(
        "*",
        years.alias("exp_years"),
        clean_city(F.col("city_raw")).alias("city"),
        skills.alias("skills"),
        detect_remote(F.col("description")).alias("remote"),
        detect_english(F.col("description")).alias("english"),
    ).withColumn("num_skills", F.coalesce(F.size("skills"), F.lit(0))) \
     .withColumn("level", seniority_level(F.col("exp_years")))


def domain_from(p: DataFrame) -> DataFrame:
    """posting -> one posting per (title, company), domain filter, salary midpoint."""
    return add_salary(filter_domain(dedup_postings(p)))


def clean_from(domain: DataFrame) -> DataFrame:
    """domain layer -> clean_posting (fill, parse, range filter).

    ``domain`` is read twice, once for the salary column alone (the median)."""
    return filter_salary_range(derive_clean_columns(fill_missing_median(domain)))


def inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "customer")]


def domain_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, "domain", inputs(sf_dir), lambda: domain_from(postings(spark, sf_dir)))


def clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer, written once and scanned pruned."""
    return layer(spark, "clean", inputs(sf_dir), lambda: clean_from(domain_layer(spark, sf_dir)))


def clean_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_layer(spark, sf_dir)


def enriched_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, "enriched", inputs(sf_dir), lambda: enrich_all(clean_layer(spark, sf_dir)))
