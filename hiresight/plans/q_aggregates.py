"""Queries: market aggregates over the clean layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import VALID_IT_SKILLS
from ..operators import aggregates as A
from . import clean as C
from . import oracle as O
from .catalog import register
from .catalog import SKILL_STATS_CTE as SKILL_STATS_CTE_SQL

CLEAN = O.clean_ctes()
W = O.with_ctes


def clean(spark, sf):
    return C.clean_postings(spark, sf)


def clean_mat(spark, sf):
    """For plans reading the layer more than once."""
    return C.clean_layer(spark, sf)


@register("dataset_stats", W(CLEAN, """SELECT count(*) AS rows, min(salary) AS min_salary, max(salary) AS max_salary,
    round(avg(salary), 6) AS avg_salary, round(avg(exp_years), 6) AS avg_exp_years,
    round(avg(num_skills), 6) AS avg_num_skills FROM clean"""))
def q_dataset_stats(spark, sf):
    return A.dataset_stats(clean(spark, sf)).drop("columns")


register("level_distribution", W(CLEAN, "SELECT level, count(*) AS n FROM clean GROUP BY level"))(
    lambda spark, sf: A.level_distribution(clean(spark, sf)))
register("city_distribution_top10", W(CLEAN, """SELECT city, count(*) AS n FROM clean GROUP BY city
    ORDER BY n DESC, city LIMIT 10"""))(lambda spark, sf: A.city_distribution_top(clean(spark, sf), 10))
register("skill_demand_topk", W(CLEAN + ",\n" + SKILL_STATS_CTE_SQL, """SELECT skill, demand_count,
    round(demand_count * 100.0 / (SELECT count(*) FROM clean), 1) AS share_pct FROM skill_stats
    ORDER BY demand_count DESC, skill LIMIT 10"""))(lambda spark, sf: A.skill_demand_topk(clean_mat(spark, sf), 10))
register("kpi_by_city", W(CLEAN, """SELECT coalesce(city, 'All') AS city, count(*) AS total_jobs,
    round(avg(salary), 6) AS avg_salary, round(avg(exp_years), 6) AS avg_exp_years,
    round(avg(num_skills), 6) AS avg_num_skills FROM clean GROUP BY ROLLUP (city)"""))(
    lambda spark, sf: A.kpi_by_city(clean(spark, sf)))
register("avg_salary_by_city_top10", W(CLEAN, """SELECT city, round(avg(salary), 6) AS avg_salary FROM clean
    GROUP BY city ORDER BY avg_salary DESC, city LIMIT 10"""))(
    lambda spark, sf: A.avg_salary_by_city_top(clean(spark, sf), 10))
register("salary_histogram", W(CLEAN, """
, mm AS (SELECT min(salary) AS lo, max(salary) AS hi FROM clean),
binned AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((salary - lo) / ((hi - lo) / 30)), 29) END AS INTEGER)
                  AS bin, lo, hi FROM clean, mm WHERE salary IS NOT NULL)
SELECT bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30), 6) AS bin_lo,
       round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 30), 6) AS bin_hi, count(*) AS n
FROM binned GROUP BY bin""".replace("\n, mm", ",\nmm", 1)))(lambda spark, sf: A.salary_histogram(clean_mat(spark, sf)))
register("salary_box_by_level", W(CLEAN, """
, qq AS (SELECT level, count(*) AS n, quantile_cont(salary, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM clean GROUP BY level)
SELECT level, n, round(q[1], 6) AS min, round(q[2], 6) AS q1, round(q[3], 6) AS median, round(q[4], 6) AS q3,
       round(q[5], 6) AS max, round(q[2] - 1.5 * (q[4] - q[2]), 6) AS lower_fence,
       round(q[4] + 1.5 * (q[4] - q[2]), 6) AS upper_fence FROM qq""".replace("\n, qq", ",\nqq", 1)))(
    lambda spark, sf: A.salary_box_by_level(clean(spark, sf)))

_vocab = list(dict.fromkeys(VALID_IT_SKILLS))


@register("salary_impact", W(CLEAN, f"""
, v AS (SELECT unnest({O.str_list(_vocab + ['cobol', 'fortran'])}) AS skill),
ws AS (SELECT v.skill, avg(c.salary) FILTER (WHERE list_contains(c.skills, v.skill)) AS w,
              avg(c.salary) FILTER (WHERE NOT list_contains(c.skills, v.skill)) AS wo
       FROM v, clean c GROUP BY v.skill)
SELECT skill, true AS has_skill, round(w, 1) AS avg_salary_with, round(wo, 1) AS avg_salary_without,
       round(w - wo, 1) AS increase,
       CASE WHEN wo > 0 THEN round((w - wo) / wo * 100, 1) ELSE 0.0 END AS increase_percentage
FROM ws WHERE skill NOT IN ('cobol', 'fortran')
UNION ALL SELECT skill, false, NULL, NULL, NULL, NULL FROM ws WHERE skill IN ('cobol', 'fortran')""".replace("\n, v AS", ",\nv AS", 1)))
def q_salary_impact(spark, sf):
    """Every flag, and two skills that have none."""
    return A.salary_impact(clean_mat(spark, sf), _vocab + ["cobol", "fortran"])


_names = [n.lower() for n in sorted(s.upper() for s in _vocab)[:40][:20]]


@register("skill_salary_min_support", W(CLEAN + ",\n" + SKILL_STATS_CTE_SQL, f"""
SELECT upper(skill) AS skill, round(salary_sum / demand_count, 6) AS salary, demand_count AS count
FROM skill_stats WHERE skill IN ({', '.join(O.q(n) for n in _names)}) AND demand_count > 10
ORDER BY salary DESC, skill LIMIT 15"""))
def q_skill_salary_min_support(spark, sf):
    return A.skill_salary_min_support(clean_mat(spark, sf), names=_names)


register("share_of_rows", W(CLEAN, """SELECT count(*) AS rows,
    round(avg(remote) * 100, 6) AS remote_pct, round(avg(english) * 100, 6) AS english_pct,
    CAST(sum(CAST(num_skills >= 5 AS INTEGER)) AS BIGINT) AS jobs_5plus_skills,
    (SELECT round(sum(CAST(salary IS NOT NULL AS INTEGER)) * 100.0 / count(*), 6) FROM sal) AS valid_salary_pct,
    round((SELECT count(*) FROM domain) * 100.0 / (SELECT count(*) FROM dedup), 6) AS domain_pct FROM clean"""))(
    lambda spark, sf: A.share_of_rows(clean(spark, sf), C.domain_layer(spark, sf), C.dedup_postings(C.postings(spark, sf))))
register("distinct_cities", W(CLEAN, "SELECT count(DISTINCT city) AS distinct_cities FROM clean"))(
    lambda spark, sf: A.distinct_cities(clean(spark, sf)))
