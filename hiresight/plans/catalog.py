"""Registered queries (Spark) and their oracle SQL (DuckDB).

Every query reads the driver tables at ``sf_dir`` (or data Spark derives
from them) in full.  Arrays are rendered as sorted comma-joined strings so
that both engines hash them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clean as C
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def csv(col: str):
    return F.array_join(F.col(col), ",")


# ---------------------------------------------------------------- clean layer
CLEAN_COLS_SPARK = ["post_id", "title", "company", "city", "salary", "exp_years", "num_skills",
                    "remote", "english", "level"]


@register("clean_postings", O.with_ctes(O.clean_ctes(), """
SELECT post_id, title, company, city, salary, exp_years, num_skills, remote, english, level,
       array_to_string(skills, ',') AS skills FROM clean"""))
def q_clean_postings(spark, sf_dir):
    c = C.clean_from(C.domain_layer(spark, sf_dir))
    return c.select(*CLEAN_COLS_SPARK, csv("skills").alias("skills"))


def _hot_vocab():
    from ..functions.constants import SKILL_VOCABULARY, VALID_IT_SKILLS
    return [s for s in dict.fromkeys(SKILL_VOCABULARY) if s in set(VALID_IT_SKILLS)]


SKILL_STATS_CTE = """skill_stats AS (
  SELECT skill, count(*) AS demand_count, sum(salary) AS salary_sum
  FROM (SELECT unnest(skills) AS skill, salary FROM clean) GROUP BY skill)"""


@register("hot_skills", O.with_ctes(O.clean_ctes() + ",\n" + SKILL_STATS_CTE, f"""
SELECT v.skill, CAST(coalesce(s.demand_count, 0) AS BIGINT) AS demand_count,
       round(coalesce(s.demand_count, 0) * 100.0 / (SELECT count(*) FROM clean), 1) AS demand_percentage,
       CASE WHEN coalesce(s.demand_count, 0) > 0 THEN round(s.salary_sum / s.demand_count, 1) ELSE 0.0 END
         AS avg_salary,
       v.skill IN ('python', 'aws', 'docker', 'kubernetes', 'devops', 'tensorflow', 'pytorch', 'react')
         AS is_high_value
FROM (SELECT unnest({O.str_list(_hot_vocab())}) AS skill) v LEFT JOIN skill_stats s ON v.skill = s.skill
ORDER BY demand_count DESC, v.skill LIMIT 20"""))
def q_hot_skills(spark, sf_dir):
    from ..operators.aggregates import hot_skills
    return hot_skills(C.clean_layer(spark, sf_dir), 20)


def _load_modules():
    # query modules register themselves on import
    from . import q_aggregates, q_augment, q_core, q_io, q_ml, q_more, q_pages, q_rules, q_sampling  # noqa: F401


def queries() -> dict:
    _load_modules()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load_modules()
    return dict(ORACLE)
