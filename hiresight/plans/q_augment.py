"""Queries: synthetic rows and augmentation over the enriched layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import SALARY_BRACKETS, BRACKET_LEVEL
from ..operators import augment as AU
from ..operators.sampling import salary_bracket
from . import oracle as O
from .catalog import register
from .q_sampling import HASH, enriched

W = O.with_ctes
ENRICHED = O.enriched_ctes()


def u_sql(rid: str, k: str) -> str:
    """The hash draw in [0, 1) of a row's key."""
    return f"(CAST(('0x' || substr(md5({rid} || ':{k}:42'), 1, 8)) AS BIGINT) / 4294967296.0)"


def normal_sql(key: str) -> str:
    h = lambda x: f"(CAST(('0x' || substr(md5({key} || '|{x}'), 1, 8)) AS BIGINT) / 4294967296.0)"
    return f"(sqrt(-2.0 * ln(1.0 - {h('a')})) * cos(2.0 * 3.141592653589793 * {h('b')}))"


def synth_sql(level: str, tag: str, n: int, offset: int) -> str:
    (e0, e1), (s0, s1), (k0, k1) = AU.LEVEL_RANGES[level]
    rid = f"('{tag}#' || CAST(i AS VARCHAR))"
    hv = " + ".join(f"CAST({u_sql(rid, s)} < {p} AS INTEGER)" for s, p in AU.SKILL_PROBS if s in AU.SYNTH_HV)
    city = f"{O.str_list(AU.SYNTH_CITIES)}[CAST(floor({u_sql(rid, 'city')} * {len(AU.SYNTH_CITIES)}) AS INTEGER) + 1]"
    return f"""SELECT {-offset - 1} - i AS post_id, round({float(e0)} + {u_sql(rid, 'exp')} * {e1 - e0}, 6) AS exp_years,
        round({float(s0)} + {u_sql(rid, 'salary')} * {s1 - s0}, 6) AS salary,
        CAST({k0} + floor({u_sql(rid, 'nsk')} * {k1 - k0}) AS INTEGER) AS num_skills, {hv} AS num_high_value_skills,
        CAST({u_sql(rid, 'remote')} < 0.3 AS INTEGER) AS remote, {city} AS city, '{level}' AS level
        FROM (SELECT unnest(range({n})) AS i)"""


SYNTH_COLUMNS = ["post_id", "round(exp_years, 6) AS exp_years", "round(salary, 6) AS salary", "num_skills",
                 "num_high_value_skills", "remote", "city", "level"]
#: postings up to the first salary (million) leave the upper brackets empty; few freshers earn the second
LOW_PAY, HIGH_PAY = 20, 99


@register("synth_level", W(ENRICHED + f""",
low AS (SELECT * FROM enriched WHERE salary <= {LOW_PAY})""", " UNION ALL ".join(
    f"SELECT * FROM ({synth_sql(BRACKET_LEVEL[label], label, 300, AU.SYNTH_TAGS.index(label) * AU.SYNTH_ID_RANGE)}) "
    f"WHERE NOT EXISTS (SELECT 1 FROM low WHERE salary > {lo} AND salary <= {hi})" for lo, hi, label in SALARY_BRACKETS)))
def q_synth_level(spark, sf):
    """300 synthetic rows for every salary bracket that the low-paid postings leave empty."""
    e = enriched(spark, sf).where(F.col("salary") <= LOW_PAY)
    present = {r[0] for r in e.select(salary_bracket().alias("b")).where(F.col("b").isNotNull()).distinct().collect()}
    out = None
    for _lo, _hi, label in SALARY_BRACKETS:  # at most 6 labels
        s = AU.synth_level(spark, BRACKET_LEVEL[label], 300, tag=label).selectExpr(*SYNTH_COLUMNS).where(F.lit(label not in present))
        out = s if out is None else out.unionByName(s)
    return out


_F = "('fresher#' || CAST(i AS VARCHAR))"


@register("synth_fresher", W(ENRICHED, f"""SELECT {-AU.SYNTH_TAGS.index("fresher") * AU.SYNTH_ID_RANGE - 1} - i AS post_id,
    round({u_sql(_F, 'exp')}, 6) AS exp_years, round(least(12.0, greatest(5.0, 6 + nsk * 0.8 + {normal_sql(_F)})), 6) AS salary,
    nsk AS num_skills, CAST({u_sql(_F, 'remote')} < 0.3 AS INTEGER) AS remote,
    {O.str_list(AU.FRESHER_CITIES)}[CAST(floor({u_sql(_F, 'city')} * {len(AU.FRESHER_CITIES)}) AS INTEGER) + 1] AS city
    FROM (SELECT i, CAST(1 + floor({u_sql(_F, 'nsk')} * 4) AS INTEGER) AS nsk FROM (SELECT unnest(range(500)) AS i))
    WHERE (SELECT count(*) FROM enriched WHERE level = 'Fresher' AND salary > {HIGH_PAY}) < 10"""))
def q_synth_fresher(spark, sf):
    """500 synthetic freshers when fewer than 10 real ones are paid well."""
    n = enriched(spark, sf).where((F.col("level") == "Fresher") & (F.col("salary") > HIGH_PAY)).count()
    return AU.synth_fresher(spark, 500 if n < 10 else 0).select(
        "post_id", F.round("exp_years", 6).alias("exp_years"), F.round("salary", 6).alias("salary"), "num_skills", "remote", "city")


@register("aug_balance_levels", W(ENRICHED + f""",
sz AS (SELECT level, count(*) AS n FROM enriched GROUP BY level),
t AS (SELECT greatest(median(n), 300.0) AS t FROM sz),
tg AS (SELECT level, CASE WHEN n > t * 2 THEN least(t * 2, floor(CAST(n AS DOUBLE) * 0.7)) ELSE n END AS target FROM sz, t),
rk AS (SELECT post_id, level, row_number() OVER (PARTITION BY level ORDER BY {HASH}, post_id) AS r FROM enriched)""",
    "SELECT post_id, level FROM rk JOIN tg USING (level) WHERE r <= target"))
def q_aug_balance(spark, sf):
    return AU.aug_balance_levels(enriched(spark, sf)).select("post_id", "level")


@register("aug_dedup", W(ENRICHED, """SELECT post_id FROM (SELECT post_id, row_number() OVER (
    PARTITION BY exp_years, num_skills, city, level ORDER BY post_id) AS r FROM enriched) WHERE r = 1"""))
def q_aug_dedup(spark, sf):
    e = enriched(spark, sf).withColumn("origin_rank", F.lit(0))
    return AU.aug_dedup(e).select("post_id")


NOISE_SQL = f"""nz AS (SELECT * REPLACE (least(100.0, greatest(5.0, salary * (1 + 0.03 * {normal_sql("CAST(post_id AS VARCHAR) || ':noise:42'")}))) AS salary)
       FROM (SELECT *, row_number() OVER (ORDER BY {HASH}, post_id) AS hr FROM enriched) WHERE hr <= %d)"""


@register("aug_salary_noise", W(ENRICHED + ",\n" + NOISE_SQL % 200, "SELECT post_id, round(salary, 6) AS salary, 'noise' AS source FROM nz"))
def q_aug_noise(spark, sf):
    return AU.aug_salary_noise(enriched(spark, sf), 0.03, 200).select("post_id", F.round("salary", 6).alias("salary"), "source")


def interpolate_sql(n: int) -> str:
    pid = "CAST(pair AS VARCHAR)"
    mix = lambda c: f"(CAST(a.{c} AS DOUBLE) * alpha + CAST(b.{c} AS DOUBLE) * (1 - alpha))"
    return f"""rkd AS (SELECT *, row_number() OVER (ORDER BY {HASH}, post_id) AS hr2 FROM enriched QUALIFY hr2 <= {2 * n}),
itp AS (SELECT -1000000 - pair AS post_id, {mix('exp_years')} AS exp_years, {mix('salary')} AS salary,
        CAST(greatest(1, round({mix('num_skills')})) AS INTEGER) AS num_skills,
        CAST(CASE WHEN {u_sql(pid, 'remote')} < 0.5 THEN a.remote ELSE b.remote END AS INTEGER) AS remote,
        CASE WHEN {u_sql(pid, 'level')} < 0.5 THEN a.level ELSE b.level END AS level, coalesce(a.city, b.city) AS city,
        (a.city_multiplier + b.city_multiplier) / 2 AS city_multiplier
        FROM (SELECT pair, 0.3 + 0.4 * {u_sql(pid, 'alpha')} AS alpha FROM (SELECT unnest(range(1, {n} + 1)) AS pair))
        JOIN rkd a ON a.hr2 = 2 * pair - 1 JOIN rkd b ON b.hr2 = 2 * pair)"""


@register("aug_interpolate", W(ENRICHED + ",\n" + interpolate_sql(200), """SELECT post_id, round(exp_years, 6) AS exp_years,
    round(salary, 6) AS salary, num_skills, remote, level, city, round(city_multiplier, 6) AS city_multiplier FROM itp"""))
def q_aug_interp(spark, sf):
    return AU.aug_interpolate(enriched(spark, sf), 200).select(
        "post_id", F.round("exp_years", 6).alias("exp_years"), F.round("salary", 6).alias("salary"), "num_skills", "remote",
        "level", "city", F.round("city_multiplier", 6).alias("city_multiplier"))


def _noise_and_mixed(e, k):
    return AU.aug_salary_noise(e, 0.03, k).withColumn("origin_rank", F.lit(1)).unionByName(
        AU.aug_interpolate(e, k).withColumn("origin_rank", F.lit(2)), allowMissingColumns=True)


@register("aug_limit_tail", W(ENRICHED + ",\n" + NOISE_SQL % 150 + ",\n" + interpolate_sql(150) + """,
n0 AS (SELECT count(*) AS n FROM enriched), cap AS (SELECT n + CAST(floor(n * 0.01) AS BIGINT) AS cap FROM n0),
parts AS (SELECT post_id, 0 AS origin_rank FROM enriched UNION ALL SELECT post_id, 1 FROM nz UNION ALL SELECT post_id, 2 FROM itp),
pos AS (SELECT *, row_number() OVER (ORDER BY origin_rank, """ + HASH + """, post_id) AS p FROM parts)""",
    "SELECT post_id, origin_rank FROM pos WHERE p <= (SELECT cap FROM cap)"))
def q_aug_limit(spark, sf):
    """One percent of room for noise and interpolated rows: the newest go, then part of the noise."""
    e = enriched(spark, sf)
    both = e.withColumn("origin_rank", F.lit(0)).unionByName(_noise_and_mixed(e, 150), allowMissingColumns=True)
    return AU.aug_limit_tail(both, e.count(), 0.01).select("post_id", "origin_rank")


@register("augment_all", W(ENRICHED + f""",
sz AS (SELECT level, count(*) AS n FROM enriched GROUP BY level),
tg AS (SELECT level, CASE WHEN n > 1000 THEN least(1000, floor(CAST(n AS DOUBLE) * 0.7)) ELSE n END AS target FROM sz),
rk AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY {HASH}, post_id) AS r FROM enriched),
bal AS (SELECT rk.* FROM rk JOIN tg USING (level) WHERE r <= target),
""" + NOISE_SQL % 150 + ",\n" + interpolate_sql(150) + """,
parts AS (SELECT post_id, level, city, salary, exp_years, num_skills, 0 AS origin_rank FROM bal
          UNION ALL SELECT post_id, level, city, salary, exp_years, num_skills, 1 FROM nz
          UNION ALL SELECT post_id, level, city, salary, exp_years, num_skills, 2 FROM itp),
cap AS (SELECT count(*) + CAST(floor(count(*) * 0.3) AS BIGINT) AS cap FROM enriched),
pos AS (SELECT *, row_number() OVER (ORDER BY origin_rank, """ + HASH + """, post_id) AS p FROM parts),
lim AS (SELECT * FROM pos WHERE p <= (SELECT cap FROM cap))""",
    """SELECT post_id, level, city, round(salary, 6) AS salary, origin_rank FROM lim
       QUALIFY row_number() OVER (PARTITION BY exp_years, num_skills, city, level ORDER BY origin_rank, post_id) = 1"""))
def q_augment_all(spark, sf):
    return AU.augment_all(enriched(spark, sf)).select("post_id", "level", "city", F.round("salary", 6).alias("salary"), "origin_rank")
