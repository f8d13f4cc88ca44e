"""Synthetic rows and training-set augmentation (deterministic hash draws).

Draw ``k`` of row ``r`` is ``hash_uniform('<r>:<k>:<seed>')``; the same row
identity always gives the same values, in any partitioning and on retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .relational import keep_first_of_equals
from .sampling import flag_exact_global, hash_key, hash_normal, hash_uniform, sample_exact_global, sample_exact_per_group

# --- FIXED VALUES: per-level ranges (exp, salary, skills [lo, hi)) and draw probabilities.
LEVEL_RANGES = {
    "Fresher": ((0, 1), (6, 12), (1, 4)),
    "Junior": ((1, 3), (10, 18), (3, 6)),
    "Middle": ((3, 5), (16, 25), (5, 8)),
    "Senior": ((5, 8), (25, 40), (6, 10)),
    "Expert": ((8, 15), (35, 60), (8, 12)),
}
SKILL_PROBS = [("python", 0.3), ("java", 0.2), ("javascript", 0.3), ("react", 0.2), ("aws", 0.2),
               ("docker", 0.3), ("sql", 0.4), ("kubernetes", 0.1), ("devops", 0.1)]
SYNTH_HV = ["python", "aws", "docker", "kubernetes", "devops"]
SYNTH_CITIES = ["Hanoi", "Ho Chi Minh City", "Da Nang", "Hai Phong"]
FRESHER_CITIES = ["Hanoi", "Ho Chi Minh City", "Da Nang"]


def _u(rid: Column, k: str, seed: int) -> Column:
    return hash_uniform(F.concat(rid.cast("string"), F.lit(f":{k}:{seed}")))


SYNTH_TAGS = [*LEVEL_RANGES, "<10M", "10-15M", "15-20M", "20-30M", "30-50M", ">50M", "fresher"]
#: ids of different tags never meet: each tag has a range of its own below zero
SYNTH_ID_RANGE = 1 << 40


def synth_id(tag: str, i: Column) -> Column:
    return F.lit(-SYNTH_TAGS.index(tag) * SYNTH_ID_RANGE - 1) - i


def synth_level(spark: SparkSession, level: str, n: int, seed: int = 42, tag: str | None = None) -> DataFrame:
    """n synthetic postings of a level: uniform years and salary, integer skill
    count in [lo, hi), Bernoulli skill flags, remote 0.3, english 0.2, 4 cities.

    ``tag`` (a level or a salary bracket) names the draw: two brackets of one
    level get different rows with different ids."""
    (e0, e1), (s0, s1), (k0, k1) = LEVEL_RANGES.get(level, LEVEL_RANGES["Expert"])
    tag = tag or level
    rid = F.concat(F.lit(tag + "#"), F.col("id").cast("string"))
    flags = {s: (_u(rid, s, seed) < p).cast("int") for s, p in SKILL_PROBS}
    skills = F.array_compact(F.array(*[F.when(v == 1, F.lit(s)) for s, v in flags.items()]))
    city = F.element_at(F.array(*[F.lit(c) for c in SYNTH_CITIES]),
                        (F.floor(_u(rid, "city", seed) * len(SYNTH_CITIES)) + 1).cast("int"))
    return spark.range(n).select(
        synth_id(tag, F.col("id")).alias("post_id"),
        (F.lit(float(e0)) + _u(rid, "exp", seed) * (e1 - e0)).alias("exp_years"),
        (F.lit(float(s0)) + _u(rid, "salary", seed) * (s1 - s0)).alias("salary"),
        (F.lit(k0) + F.floor(_u(rid, "nsk", seed) * (k1 - k0))).cast("int").alias("num_skills"),
        sum((flags[s] for s in SYNTH_HV), F.lit(0)).alias("num_high_value_skills"),
        (_u(rid, "remote", seed) < 0.3).cast("int").alias("remote"),
        (_u(rid, "english", seed) < 0.2).cast("int").alias("english"),
        city.alias("city"), F.lit(level).alias("level"), F.lit("synthetic").alias("source"),
        F.array_sort(skills).alias("skills"))


def synth_fresher(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    """Fresher rows: salary = 6 + 0.8 * skills + N(0, 1), clipped to [5, 12]."""
    rid = F.concat(F.lit("fresher#"), F.col("id").cast("string"))
    nsk = (F.lit(1) + F.floor(_u(rid, "nsk", seed) * 4)).cast("int")
    city = F.element_at(F.array(*[F.lit(c) for c in FRESHER_CITIES]),
                        (F.floor(_u(rid, "city", seed) * len(FRESHER_CITIES)) + 1).cast("int"))
    return spark.range(n).select(
        synth_id("fresher", F.col("id")).alias("post_id"), _u(rid, "exp", seed).alias("exp_years"),
        F.least(F.lit(12.0), F.greatest(F.lit(5.0), 6 + nsk * 0.8 + hash_normal(rid))).alias("salary"),
        nsk.alias("num_skills"), (_u(rid, "remote", seed) < 0.3).cast("int").alias("remote"),
        (_u(rid, "english", seed) < 0.2).cast("int").alias("english"), city.alias("city"),
        F.lit("Fresher").alias("level"))


def aug_balance_levels(df: DataFrame, target: int | None = None, seed: int = 42) -> DataFrame:
    """Classes above 2 x target keep min(2 x target, floor(0.7 n)) rows; target
    defaults to max(median class size, 300)."""
    sizes = df.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    t = F.lit(float(target)) if target is not None else F.greatest(sizes.select(F.median("n")).scalar(), F.lit(300.0))
    tg = sizes.select("level", F.when(F.col("n") > t * 2, F.least(t * 2, F.floor(F.col("n") * 0.7)))
                      .otherwise(F.col("n")).cast("long").alias("target"))
    return sample_exact_per_group(df, ["level"], tg, seed=seed, small_groups=True)


def aug_salary_noise(df: DataFrame, noise: float = 0.03, n: int = 200, seed: int = 42) -> DataFrame:
    """min(n, rows) rows by hash order; salary x N(1, noise), clipped to [5, 100]."""
    s = sample_exact_global(df, count=n, seed=seed)
    factor = 1 + noise * hash_normal(F.concat(F.col("post_id").cast("string"), F.lit(f":noise:{seed}")))
    return s.withColumn("salary", F.least(F.lit(100.0), F.greatest(F.lit(5.0), F.col("salary") * factor))) \
        .withColumn("source", F.lit("noise"))


def aug_interpolate(df: DataFrame, n: int = 200, seed: int = 42) -> DataFrame:
    """min(n, 500) pairs from the first 2n rows in hash order: convex mix of the
    numeric columns (alpha in [0.3, 0.7)), random pick of flags and level, first
    non-null city, mean multiplier, OR of skills, recomputed interactions."""
    n = min(n, 500)
    cols = ["post_id", "exp_years", "salary", "num_skills", "num_high_value_skills", "remote", "english",
            "is_big_city", "is_big_company", "city", "level", "city_multiplier", "skills"]
    d = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols]).na.fill(0)
    top = sample_exact_global(d, count=2 * n, seed=seed)
    # top holds at most 2n rows (n <= 500): ranking it in one window is bounded
    ranked = top.withColumn("_r", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy(hash_key("post_id", seed), "post_id")))
    a = ranked.where(F.col("_r") % 2 == 1).select(((F.col("_r") + 1) / 2).cast("int").alias("pair"),
                                                   *[F.col(c).alias(f"a_{c}") for c in cols])
    b = ranked.where(F.col("_r") % 2 == 0).select((F.col("_r") / 2).cast("int").alias("pair"),
                                                   *[F.col(c).alias(f"b_{c}") for c in cols])
    j = a.join(b, "pair")
    pid = F.col("pair").cast("string")
    alpha = 0.3 + 0.4 * hash_uniform(F.concat(pid, F.lit(f":alpha:{seed}")))

    def mix(c):
        return F.col(f"a_{c}").cast("double") * alpha + F.col(f"b_{c}").cast("double") * (1 - alpha)

    def pick(c):
        return F.when(hash_uniform(F.concat(pid, F.lit(f":{c}:{seed}"))) < 0.5, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))

    nsk = F.greatest(F.lit(1), F.round(mix("num_skills"))).cast("int")
    nhv = F.greatest(F.lit(0), F.round(mix("num_high_value_skills"))).cast("int")
    out = j.select(
        (-1000000 - F.col("pair")).alias("post_id"), mix("exp_years").alias("exp_years"), mix("salary").alias("salary"),
        nsk.alias("num_skills"), nhv.alias("num_high_value_skills"),
        *[pick(c).cast("int").alias(c) for c in ("remote", "english", "is_big_city", "is_big_company")],
        F.coalesce("a_city", "b_city").alias("city"), pick("level").alias("level"),
        ((F.coalesce("a_city_multiplier", F.lit(1.0)) + F.coalesce("b_city_multiplier", F.lit(1.0))) / 2)
        .alias("city_multiplier"),
        F.array_sort(F.array_union(F.coalesce("a_skills", F.array().cast("array<string>")),
                                   F.coalesce("b_skills", F.array().cast("array<string>")))).alias("skills"))
    y = F.col("exp_years")
    return out.withColumns({
        "exp_squared": y * y, "exp_skill_interaction": y * F.col("num_skills"),
        "exp_high_value": y * F.col("num_high_value_skills"),
        "remote_english": ((F.col("remote") == 1) & (F.col("english") == 1)).cast("int"),
        "remote_big_city": ((F.col("remote") == 1) & (F.col("is_big_city") == 1)).cast("int"),
        "salary_per_skill": F.col("salary") / F.greatest(F.col("num_skills"), F.lit(1)),
        "source": F.lit("interpolated")})


def aug_limit_tail(df: DataFrame, original_rows: int, ratio: float = 0.3) -> DataFrame:
    """Keep at most original + floor(ratio x original) rows, dropping the newest
    rows first (highest origin rank, then latest in hash order).

    The counts per origin rank (a handful) say how many rows of each rank stay;
    a rank that is cut keeps its smallest hashes, found through the bucket
    histogram, so neither the tail nor the head is ever sorted in one task.
    """
    cap = original_rows + int(original_rows * ratio)
    counts = dict(sorted((r[0], r[1]) for r in df.groupBy("origin_rank").count().collect()))  # one row a step
    room, out = cap, None
    for rank, n in counts.items():
        rows = df.where(F.col("origin_rank").eqNullSafe(F.lit(rank)))
        keep = min(n, max(0, room))
        room -= keep
        if keep < n:
            rows = flag_exact_global(rows, count=keep, flag="_in").where("_in = 1").drop("_in")
        out = rows if out is None else out.unionByName(rows)
    return df if out is None else out


def aug_dedup(df: DataFrame) -> DataFrame:
    """One row per (exp_years, num_skills, city, level): the first in origin order."""
    return keep_first_of_equals(df, ["exp_years", "num_skills", "city", "level"], ["origin_rank", "post_id"])


def augment_all(df: DataFrame, ratio: float = 0.3, seed: int = 42) -> DataFrame:
    """balance (target 500) + noise + interpolation (each <= 150 and <= a third of
    the allowance) + cap at ``ratio`` added rows + dedup."""
    from ..session import materialise
    base = materialise(df)
    n0 = base.count()
    allowance = int(n0 * ratio)
    k = min(150, allowance // 3)
    bal = aug_balance_levels(base, 500, seed).withColumn("origin_rank", F.lit(0))
    parts = [bal]
    if k > 0:
        parts.append(aug_salary_noise(base, 0.03, k, seed).withColumn("origin_rank", F.lit(1)))
        if n0 >= 2:
            parts.append(aug_interpolate(base, k, seed).withColumn("origin_rank", F.lit(2)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return aug_dedup(aug_limit_tail(materialise(out), n0, ratio))
