"""Queries: exact hash-ordered sampling, bootstrap and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as SM
from . import clean as C
from . import oracle as O
from .catalog import register

ENRICHED = O.enriched_ctes()
W = O.with_ctes
HASH = "md5(CAST(post_id AS VARCHAR) || ':42')"
BRACKET = """CASE WHEN salary > 0 AND salary <= 10 THEN '<10M' WHEN salary > 10 AND salary <= 15 THEN '10-15M'
    WHEN salary > 15 AND salary <= 20 THEN '15-20M' WHEN salary > 20 AND salary <= 30 THEN '20-30M'
    WHEN salary > 30 AND salary <= 50 THEN '30-50M' WHEN salary > 50 AND salary <= 100 THEN '>50M' END"""


def enriched(spark, sf):
    """The enriched layer: the sampling operators read it several times."""
    return C.enriched_layer(spark, sf)


def levels_sql(src: str) -> str:
    """CTEs lv .. lvl_bal over ``src`` (balance_levels)."""
    return f"""lv AS (SELECT * REPLACE (CASE WHEN level = 'Expert' THEN 'Senior' ELSE level END AS level) FROM {src}),
lv2 AS (SELECT * FROM lv WHERE level <> 'Fresher' OR (SELECT count(*) FROM lv WHERE level = 'Fresher') >= 10),
sizes AS (SELECT level, count(*) AS n FROM lv2 GROUP BY level),
capt AS (SELECT least(median(n) * 2, 2000.0) AS cap FROM sizes),
tg AS (SELECT level, CASE WHEN n > cap THEN greatest(cap, floor(CAST(n AS DOUBLE) * 0.7)) ELSE n END AS target
       FROM sizes, capt),
lranked AS (SELECT lv2.*, row_number() OVER (PARTITION BY level ORDER BY {HASH}, post_id) AS lrk FROM lv2),
lvl_bal AS (SELECT lranked.* EXCLUDE (lrk) FROM lranked JOIN tg USING (level) WHERE lrk <= target)"""


def brackets_sql(src: str) -> str:
    """CTEs b .. br_bal over ``src`` (balance_brackets, 300 per bracket)."""
    return f"""b AS (SELECT *, {BRACKET} AS salary_bracket FROM {src}),
b2 AS (SELECT * FROM b WHERE salary_bracket IS NOT NULL),
bsizes AS (SELECT salary_bracket, count(*) AS bn FROM b2 GROUP BY salary_bracket),
branked AS (SELECT b2.*, row_number() OVER (PARTITION BY salary_bracket ORDER BY {HASH}, post_id) AS brk FROM b2),
bdown AS (SELECT branked.* FROM branked JOIN bsizes USING (salary_bracket) WHERE bn > 300 AND brk <= 300),
bdraws AS (SELECT salary_bracket, bn, unnest(range(1, 301)) AS i FROM bsizes WHERE bn <= 300),
bdraws2 AS (SELECT salary_bracket,
                   (CAST(('0x' || substr(md5(salary_bracket || ':' || CAST(i AS VARCHAR) || ':42'), 1, 8)) AS BIGINT)
                    % bn) + 1 AS brk FROM bdraws),
bup AS (SELECT r.* FROM bdraws2 d JOIN branked r ON d.salary_bracket = r.salary_bracket AND d.brk = r.brk),
br_bal AS (SELECT * EXCLUDE (brk, salary_bracket) FROM bdown UNION ALL SELECT * EXCLUDE (brk, salary_bracket) FROM bup)"""


def cities_sql(src: str) -> str:
    return f"""topc AS (SELECT city FROM {src} GROUP BY city ORDER BY count(*) DESC, city LIMIT 5),
city_bal AS (SELECT s.* REPLACE (CASE WHEN t.city IS NOT NULL THEN s.city ELSE 'Other' END AS city,
                    CAST((CASE WHEN t.city IS NOT NULL THEN s.city ELSE 'Other' END) IN ('Ho Chi Minh City', 'Hanoi')
                         AS INTEGER) AS is_big_city)
             FROM {src} s LEFT JOIN topc t ON s.city = t.city)"""


@register("balance_levels", W(ENRICHED + ",\n" + levels_sql("enriched"), "SELECT post_id, level FROM lvl_bal"))
def q_balance_levels(spark, sf):
    return SM.balance_levels(enriched(spark, sf)).select("post_id", "level")


@register("sample_exact_n", W(ENRICHED + ",\n" + levels_sql("enriched"), "SELECT post_id, level FROM lvl_bal"))
def q_sample_exact_n(spark, sf):
    """The generic exact sampler with per-group targets (here: the level targets)."""
    d = SM.merge_expert(enriched(spark, sf))
    n_fresher = d.where(F.col("level") == "Fresher").select(F.count(F.lit(1))).scalar()
    d = d.where((F.col("level") != "Fresher") | (n_fresher >= 10))
    return SM.sample_exact_per_group(d, ["level"], SM.level_targets(d)).select("post_id", "level")


@register("balance_brackets", W(ENRICHED + ",\n" + brackets_sql("enriched"),
                                "SELECT post_id, round(salary, 6) AS salary FROM br_bal"))
def q_balance_brackets(spark, sf):
    return SM.balance_brackets(enriched(spark, sf)).select("post_id", F.round("salary", 6).alias("salary"))


@register("bootstrap_n", W(ENRICHED + ",\n" + brackets_sql("enriched").replace("WHERE bn <= 300", "")
             , "SELECT post_id, salary_bracket FROM bup"))
def q_bootstrap(spark, sf):
    d = enriched(spark, sf).withColumn("salary_bracket", SM.salary_bracket()).where(F.col("salary_bracket").isNotNull())
    return SM.bootstrap_n(d, "salary_bracket", 300).select("post_id", "salary_bracket")


@register("top_cities_other", W(ENRICHED + ",\n" + cities_sql("enriched"), "SELECT post_id, city, is_big_city FROM city_bal"))
def q_top_cities(spark, sf):
    return SM.top_cities_other(enriched(spark, sf)).select("post_id", "city", "is_big_city")


@register("balance_all", W(ENRICHED + ",\n" + levels_sql("enriched") + ",\n" + brackets_sql("lvl_bal") + ",\n"
                           + cities_sql("br_bal"),
                           "SELECT post_id, level, city, is_big_city, round(salary, 6) AS salary FROM city_bal"))
def q_balance_all(spark, sf):
    return SM.balance_all(enriched(spark, sf)).select("post_id", "level", "city", "is_big_city",
                                                     F.round("salary", 6).alias("salary"))
