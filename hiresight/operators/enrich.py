"""Enrichment: company size, city premium, skill combos, interactions, repairs."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (BASIC_SKILLS, BIG_CITIES, CITY_MULTIPLIER_DEFAULT, CITY_MULTIPLIERS,
                                   COMPANY_SIZE_BANDS, HIGH_VALUE_SKILLS, SKILL_COMBOS, TITLE_SKILL_RULES,
                                   TITLE_SKILL_RULES_ALT, VALID_IT_SKILLS)
from ..functions.parsing import bin_right_closed
from .relational import scalar


def company_counts(df: DataFrame, key: str = "company") -> DataFrame:
    """Postings per company (partial aggregation map-side; skew-safe)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("company_size"))


def add_company_features(df: DataFrame) -> DataFrame:
    """company_size, its band, and the top-quartile flag.

    The per-company counts are an aggregate joined back on the key.  AQE turns
    the join into a broadcast when the measured count table is small and
    otherwise splits skewed join partitions (a hot company is split, not
    funnelled into one task).
    """
    counts = company_counts(df)
    p75 = scalar(counts, F.percentile("company_size", 0.75))
    out = df.join(counts, "company", "left")
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns], "company_size",
        bin_right_closed(F.col("company_size"), COMPANY_SIZE_BANDS).alias("company_size_category"),
        (F.col("company_size") >= p75).cast("int").alias("is_big_company"))


def city_multiplier(city: Column) -> Column:
    """Literal lookup (8 fixed entries) -> stays a CASE in generated code, no join."""
    expr = None
    for c, m in CITY_MULTIPLIERS:
        expr = F.when(city == c, F.lit(m)) if expr is None else expr.when(city == c, F.lit(m))
    return expr.otherwise(F.lit(CITY_MULTIPLIER_DEFAULT))


def big_city_flag(city: Column) -> Column:
    return city.isin(BIG_CITIES).cast("int")


def add_city_premium(df: DataFrame) -> DataFrame:
    return df.withColumns({"city_multiplier": city_multiplier(F.col("city")),
                           "is_big_city": big_city_flag(F.col("city"))})


def combo_flags(skills: Column, flag_vocab=VALID_IT_SKILLS) -> list:
    """All-of flags; a combo needing a skill that has no flag column is 0."""
    out = []
    for name, combo in SKILL_COMBOS:
        if all(s in flag_vocab for s in combo):
            held = functools.reduce(operator.and_, [F.coalesce(F.array_contains(skills, s), F.lit(False)) for s in combo])
            expr = F.when(skills.isNotNull(), held.cast("int"))
        else:
            expr = F.lit(0)
        out.append(expr.alias(f"combo_{name}"))
    return out


def high_value_count(skills: Column, flag_vocab=VALID_IT_SKILLS) -> Column:
    hv = [s for s in HIGH_VALUE_SKILLS if s in flag_vocab]
    return F.size(F.array_intersect(skills, F.array(*[F.lit(s) for s in hv])))


def add_skill_combinations(df: DataFrame) -> DataFrame:
    return df.select("*", *combo_flags(F.col("skills")),
                     high_value_count(F.col("skills")).alias("num_high_value_skills"))


def add_interaction_features(df: DataFrame) -> DataFrame:
    y = F.col("exp_years")
    return df.withColumns({
        "exp_skill_interaction": y * F.col("num_skills"),
        "exp_high_value": y * F.col("num_high_value_skills"),
        "exp_squared": y * y,
        "remote_english": F.col("remote") * F.col("english"),
        "remote_big_city": F.col("remote") * F.col("is_big_city"),
        "salary_per_skill": F.col("salary") / (F.col("num_skills") + 1),
    })


def enrich_all(df: DataFrame) -> DataFrame:
    return (df.transform(add_company_features).transform(add_city_premium)
            .transform(add_skill_combinations).transform(add_interaction_features))


# --- FIXED VALUES: expected-salary formula of the outlier adjustment.
EXPECTED_BASE, EXP_RATE, EXP_CAP, SKILL_RATE, CITY_BONUS, ENGLISH_BONUS = 8.0, 1.5, 15.0, 0.8, 2.0, 2.0
HIGH_RATIO, HIGH_TO, LOW_RATIO, LOW_TO = 1.5, 1.2, 0.7, 0.8


def expected_salary(df: DataFrame) -> Column:
    def num(c, default=0):
        return F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
    exp_bonus = F.when(num("exp_years", None).isNull(), F.lit(0.0)).otherwise(
        F.least(num("exp_years") * EXP_RATE, F.lit(EXP_CAP)))
    skill_bonus = F.when(num("num_skills", None).isNull(), F.lit(0.0)).otherwise(num("num_skills") * SKILL_RATE)
    return (F.lit(EXPECTED_BASE) + exp_bonus + skill_bonus
            + F.when(num("is_big_city") == 1, F.lit(CITY_BONUS)).otherwise(F.lit(0.0))
            + F.when(num("english") == 1, F.lit(ENGLISH_BONUS)).otherwise(F.lit(0.0)))


def salary_outlier_adjust(df: DataFrame) -> DataFrame:
    """> 1.5x expected -> round(1.2x expected, 1); < 0.7x -> round(0.8x, 1)."""
    e = expected_salary(df)
    s = F.col("salary")
    adj = (F.when(s > e * HIGH_RATIO, F.round(e * HIGH_TO, 1))
           .when(s < e * LOW_RATIO, F.round(e * LOW_TO, 1)).otherwise(s))
    return df.withColumn("salary", adj)


def _rules_literal(rules) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(p).alias("pattern"),
                              F.array(*[F.lit(s) for s in sk]).alias("skills"))
                     for i, (p, sk) in enumerate(rules)])


def skill_repair_high_pay(df: DataFrame, flag_vocab=VALID_IT_SKILLS) -> DataFrame:
    """Rows with salary > 20 and < 3 skills: the first title rule (in order) that
    adds a skill with a flag column applies; if none adds, python/git/sql are
    added.  ``num_skills`` is recounted for every row."""
    vocab = F.array(*[F.lit(s) for s in flag_vocab])
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    skills = F.coalesce(F.col("skills"), F.array().cast("array<string>"))
    rules = _rules_literal(TITLE_SKILL_RULES)
    adds = F.transform(rules, lambda r: F.struct(
        r["pattern"].alias("pattern"),
        F.array_intersect(F.array_except(r["skills"], skills), vocab).alias("new")))
    applicable = F.filter(adds, lambda a: (F.instr(title, a["pattern"]) > 0) & (F.size(a["new"]) > 0))
    basic = F.array_intersect(F.array(*[F.lit(s) for s in BASIC_SKILLS]), vocab)
    chosen = F.when(F.size(applicable) > 0, F.try_element_at(applicable, F.lit(1))["new"]).otherwise(basic)
    target = (F.col("salary") > 20) & (F.col("num_skills") < 3)
    new_skills = F.when(target, F.array_sort(F.array_distinct(F.concat(skills, chosen)))).otherwise(skills)
    return df.withColumn("skills", new_skills).withColumn("num_skills", F.size("skills"))


def skill_repair_by_title(df: DataFrame, flag_vocab=VALID_IT_SKILLS) -> DataFrame:
    """Every title rule that matches (case-insensitive) adds its skills that have flags."""
    vocab = F.array(*[F.lit(s) for s in flag_vocab])
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    rules = _rules_literal(TITLE_SKILL_RULES_ALT)
    hits = F.flatten(F.transform(F.filter(rules, lambda r: F.instr(title, r["pattern"]) > 0),
                                 lambda r: F.array_intersect(r["skills"], vocab)))
    skills = F.coalesce(F.col("skills"), F.array().cast("array<string>"))
    return df.withColumn("skills", F.array_sort(F.array_distinct(F.concat(skills, hits)))) \
        .withColumn("num_skills", F.size("skills"))
