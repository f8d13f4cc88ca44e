"""Market aggregates: distributions, top-k, KPIs, histograms, skill statistics.

Skill statistics use one ``explode`` + ``groupBy`` (one shuffle, partial
aggregation map-side) instead of one scan per skill column.  Totals enter as
scalar subqueries.  Top-k uses ``orderBy().limit()`` which Spark plans as
TakeOrderedAndProject (a per-partition top-k, no full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import HIGH_VALUE_SKILLS, SKILL_VOCABULARY
from .relational import scalar


def dataset_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min("salary").alias("min_salary"), F.max("salary").alias("max_salary"),
        F.round(F.avg("salary"), 6).alias("avg_salary"),
        F.round(F.avg("exp_years"), 6).alias("avg_exp_years"),
        F.round(F.avg("num_skills"), 6).alias("avg_num_skills"))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Rows per value, descending, ties by value; optional top-k."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))
    return out.limit(top) if top else out


def level_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, "level")


def city_distribution_top(df: DataFrame, k: int = 10) -> DataFrame:
    return value_counts(df, "city", k)


def skill_vocabulary_df(spark, vocabulary=SKILL_VOCABULARY) -> DataFrame:
    """The fixed vocabulary as a tiny DataFrame (bounded: ~115 rows)."""
    seen, rows = set(), []
    for s in vocabulary:
        if s not in seen:
            seen.add(s)
            rows.append((s,))
    return spark.createDataFrame(rows, "skill string")


def skill_stats(df: DataFrame) -> DataFrame:
    """(skill, demand_count, salary_sum) over the exploded skill arrays."""
    return (df.select(F.explode("skills").alias("skill"), "salary")
            .groupBy("skill").agg(F.count(F.lit(1)).alias("demand_count"),
                                  F.sum("salary").alias("salary_sum")))


def hot_skills(df: DataFrame, top_n: int = 20, flag_vocab=None) -> DataFrame:
    """Top skills: demand_count, demand_percentage (1 dp), avg_salary (1 dp), is_high_value.

    The candidate set is the market vocabulary restricted to skills that have a
    flag (``flag_vocab``); skills nobody asks for are ranked with count 0.
    """
    from ..functions.constants import VALID_IT_SKILLS
    flag_vocab = flag_vocab or VALID_IT_SKILLS
    vocab = [s for s in dict.fromkeys(SKILL_VOCABULARY) if s in set(flag_vocab)]
    total = scalar(df, F.count(F.lit(1)))
    stats = skill_stats(df)
    cand = df.sparkSession.createDataFrame([(s,) for s in vocab], "skill string")
    j = cand.join(stats, "skill", "left").na.fill(0, ["demand_count"])
    return (j.select(
        "skill", F.col("demand_count").cast("long").alias("demand_count"),
        F.round(F.try_divide(F.col("demand_count") * 100.0, total), 1).alias("demand_percentage"),
        F.when(F.col("demand_count") > 0, F.round(F.col("salary_sum") / F.col("demand_count"), 1))
         .otherwise(F.lit(0.0)).alias("avg_salary"),
        F.col("skill").isin(HIGH_VALUE_SKILLS).alias("is_high_value"))
        .orderBy(F.desc("demand_count"), F.asc("skill")).limit(top_n))


def skill_demand_topk(df: DataFrame, k: int = 10) -> DataFrame:
    total = scalar(df, F.count(F.lit(1)))
    return (skill_stats(df).select(
        "skill", "demand_count",
        F.round(F.try_divide(F.col("demand_count") * 100.0, total), 1).alias("share_pct"))
        .orderBy(F.desc("demand_count"), F.asc("skill")).limit(k))


def kpi_by_city(df: DataFrame) -> DataFrame:
    """Count and means per city plus the 'All' row, in one rollup job."""
    return (df.rollup("city").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.round(F.avg("salary"), 6).alias("avg_salary"),
        F.round(F.avg("exp_years"), 6).alias("avg_exp_years"),
        F.round(F.avg("num_skills"), 6).alias("avg_num_skills"))
        .select(F.coalesce("city", F.lit("All")).alias("city"), "total_jobs", "avg_salary",
                "avg_exp_years", "avg_num_skills"))


def avg_salary_by_city_top(df: DataFrame, k: int = 10) -> DataFrame:
    return (df.groupBy("city").agg(F.round(F.avg("salary"), 6).alias("avg_salary"))
            .orderBy(F.desc("avg_salary"), F.asc("city")).limit(k))


def salary_histogram(df: DataFrame, bins: int = 30, col: str = "salary") -> DataFrame:
    """Exactly ``bins`` equal-width bins over [min, max]; the max falls in the last bin."""
    lo = scalar(df, F.min(col))
    hi = scalar(df, F.max(col))
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1))).cast("int")
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", F.round(lo + F.col("bin") * width, 6).alias("bin_lo"),
                    F.round(lo + (F.col("bin") + 1) * width, 6).alias("bin_hi"), "n"))


def salary_box_by_level(df: DataFrame) -> DataFrame:
    """Five-number summary and 1.5 IQR fences per level (exact percentiles)."""
    q = F.percentile("salary", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    g = df.groupBy("level").agg(q.alias("q"), F.count(F.lit(1)).alias("n"))
    iqr = F.col("q")[3] - F.col("q")[1]
    return g.select("level", "n",
                    F.round(F.col("q")[0], 6).alias("min"), F.round(F.col("q")[1], 6).alias("q1"),
                    F.round(F.col("q")[2], 6).alias("median"), F.round(F.col("q")[3], 6).alias("q3"),
                    F.round(F.col("q")[4], 6).alias("max"),
                    F.round(F.col("q")[1] - 1.5 * iqr, 6).alias("lower_fence"),
                    F.round(F.col("q")[3] + 1.5 * iqr, 6).alias("upper_fence"))


def salary_impact(df: DataFrame, skills=None, flag_vocab=None) -> DataFrame:
    """For each of ``skills`` (default: all flags): mean salary with / without it, difference, percent.

    One explode+groupBy for the per-skill sums plus two global scalars:
    without = (S - s) / (N - n).  A skill without a flag has has_skill false and
    no figures.
    """
    from ..functions.constants import VALID_IT_SKILLS
    flag_vocab = list(dict.fromkeys(flag_vocab or VALID_IT_SKILLS))
    names = list(dict.fromkeys(skills or flag_vocab))
    n_all = scalar(df, F.count(F.lit(1)))
    s_all = scalar(df, F.sum("salary"))
    cand = df.sparkSession.createDataFrame([(s, s in flag_vocab) for s in names], "skill string, has_skill boolean")
    j = cand.join(skill_stats(df), "skill", "left").na.fill(0, ["demand_count"])
    with_ = F.col("salary_sum") / F.col("demand_count")
    without = F.try_divide(s_all - F.coalesce(F.col("salary_sum"), F.lit(0.0)), n_all - F.col("demand_count"))
    known = lambda c: F.when(F.col("has_skill"), c)
    return j.select(
        "skill", "has_skill",
        known(F.round(with_, 1)).alias("avg_salary_with"), known(F.round(without, 1)).alias("avg_salary_without"),
        known(F.round(with_ - without, 1)).alias("increase"),
        known(F.when(without > 0, F.round((with_ - without) / without * 100, 1)).otherwise(F.lit(0.0))).alias("increase_percentage"))


def skill_salary_min_support(df: DataFrame, min_count: int = 10, k: int = 15, names=None) -> DataFrame:
    """Mean salary by skill (upper case) with count > min_count, over ``names``
    (default: every flag), top k."""
    from ..functions.constants import VALID_IT_SKILLS
    allowed = [n.lower() for n in (names or dict.fromkeys(VALID_IT_SKILLS))]
    st = skill_stats(df).where(F.col("skill").isin(allowed) & (F.col("demand_count") > min_count))
    return (st.select(F.upper("skill").alias("skill"),
                      F.round(F.col("salary_sum") / F.col("demand_count"), 6).alias("salary"),
                      F.col("demand_count").alias("count"))
            .orderBy(F.desc("salary"), F.asc("skill")).limit(k))


def share_of_rows(df: DataFrame, domain: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """Percent of postings in the domain, of those with a salary before it is
    filled, of clean rows that are remote or ask for English; rows with 5+ skills."""
    share = lambda d, c: scalar(d, F.round(F.try_divide(F.sum(c.cast("int")) * 100.0, F.count(F.lit(1))), 6))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("remote") * 100, 6).alias("remote_pct"),
        F.round(F.avg("english") * 100, 6).alias("english_pct"),
        F.sum((F.col("num_skills") >= 5).cast("int")).alias("jobs_5plus_skills")) \
        .withColumns({"valid_salary_pct": share(domain, F.col("salary").isNotNull()),
                      "domain_pct": F.round(scalar(domain, F.count(F.lit(1))) * 100.0 / scalar(deduplicated, F.count(F.lit(1))), 6)})


def distinct_cities(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("city").alias("distinct_cities"))
