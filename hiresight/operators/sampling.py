"""Exact, reproducible sampling and class balancing.

Random draws are replaced by a portable hash order: a row's rank inside its
group is the order of ``md5('<id>:<seed>')`` (then the id).  md5 is the same
in every engine, so a sample is a deterministic function of the data, and a
retried task recomputes exactly the same rows.

Scale: an exact "k smallest hashes per group" never sorts a group in one task.
The first 20 bits of the hash form a bucket; a bucket histogram per group
(map-side combined, at most 2^20 rows per group whatever the data size) gives
each group's boundary bucket, rows below it are kept as they stream by, and
only the rows of the single boundary bucket (about 1/2^20 of the group) are
ranked.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import BIG_CITIES, BRACKET_LEVEL, SALARY_BRACKETS
from ..functions.parsing import bin_right_closed

BUCKET_HEX_DIGITS = 5  # 2^20 buckets
TOP_ROWS = 1000  # samples of so many rows at most are taken as a top-k


def hash_key(id_col: str = "post_id", seed: int = 42) -> Column:
    """md5('<id>:<seed>') as hex text (the portable sort key)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash_bucket(id_col: str = "post_id", seed: int = 42) -> Column:
    """The first 20 bits of the sort key."""
    return F.conv(F.substring(hash_key(id_col, seed), 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")


def hash_uniform(key: Column) -> Column:
    """Uniform [0, 1) from the first 32 bits of md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / 4294967296.0


def hash_normal(key: Column) -> Column:
    """Standard normal draw by Box-Muller from two hash uniforms."""
    u1 = hash_uniform(F.concat(key, F.lit("|a")))
    u2 = hash_uniform(F.concat(key, F.lit("|b")))
    return F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(2.0 * 3.141592653589793 * u2)


def _settled(df: DataFrame) -> DataFrame:
    """A table of a handful of rows, evaluated once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def sample_exact_per_group(df: DataFrame, group_cols, targets: DataFrame, id_col: str = "post_id",
                           seed: int = 42, small_groups: bool = False, bucket: str | None = None) -> DataFrame:
    """Exactly ``target`` rows per group: those with the smallest (hash, id).

    ``targets`` has the group columns and an integer ``target``; groups
    missing from it keep all their rows.  ``small_groups`` is for callers whose
    groups are a fixed handful of classes: the group tables are then evaluated at
    once and broadcast.  ``bucket`` names a column that holds the rows' hash buckets.
    """
    g = list(group_cols)
    keyed = df.withColumn("_b", F.col(bucket) if bucket else hash_bucket(id_col, seed))
    hist = keyed.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if small_groups:
        targets = _settled(targets)
    tg = F.broadcast(targets) if small_groups else targets
    cum = (hist.join(tg, g, "inner").withColumn("_cum", F.sum("_n").over(w))
           .withColumn("_prev", F.col("_cum") - F.col("_n")))
    boundary = (cum.where((F.col("_prev") < F.col("target")) & (F.col("_cum") >= F.col("target")))
                .select(*g, F.col("_b").alias("_bb"), (F.col("target") - F.col("_prev")).alias("_need")))
    # groups with fewer rows than the target (or none in targets) keep everything
    bnd = F.broadcast(_settled(boundary)) if small_groups else boundary
    j = keyed.join(bnd, g, "left")
    below = j.where(F.col("_bb").isNull() | (F.col("_b") < F.col("_bb")))
    edge = j.where(F.col("_b") == F.col("_bb")).withColumn("_h", hash_key(id_col, seed))
    rk = Window.partitionBy(*g, "_b").orderBy("_h", id_col)
    edge = edge.withColumn("_rn", F.row_number().over(rk)).where(F.col("_rn") <= F.col("_need")).drop("_rn", "_h")
    keep = targets.where(F.col("target") <= 0).select(*g)
    out = below.unionByName(edge).join(F.broadcast(keep) if small_groups else keep, g, "left_anti")
    return out.drop("_b", "_bb", "_need")


def _boundary(df: DataFrame, fraction: float | None, count: int | None, id_col: str, seed: int):
    """Rows keyed by hash and bucket, the boundary bucket and how many of its
    rows are still needed (null: every row), and the target, as scalars.

    The histogram of 2^20 hash buckets (a few MB whatever the input) gives all
    three; only the boundary bucket is ever ranked."""
    h = hash_key(id_col, seed)
    b = F.conv(F.substring(h, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")
    keyed = df.withColumns({"_h": h, "_b": b})
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    t = F.ceil(F.sum("_n").over(whole) * fraction) if fraction is not None else F.lit(count)
    run = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_t", t.cast("long")).withColumn("_cum", F.sum("_n").over(run)) \
        .withColumn("_prev", F.col("_cum") - F.col("_n"))
    at = (F.col("_prev") < F.col("_t")) & (F.col("_cum") >= F.col("_t"))
    # one row: Spark evaluates this subquery once for all three values
    edge = cum.agg(F.struct(F.min(F.when(at, F.col("_b"))).alias("b"), F.min(F.when(at, F.col("_t") - F.col("_prev"))).alias("need"),
                            F.max("_t").alias("t")).alias("e")).scalar()
    return keyed, edge["b"], edge["need"], edge["t"]


def sample_exact_global(df: DataFrame, fraction: float | None = None, count: int | None = None,
                        id_col: str = "post_id", seed: int = 42) -> DataFrame:
    """Exactly ceil(fraction x rows) (or ``count``) rows overall, the smallest hashes.

    A small ``count`` is a top-k: one pass, ``count`` rows a task."""
    if count is not None and count <= TOP_ROWS:
        h = F.when(F.col(id_col).isNotNull(), hash_key(id_col, seed))
        return df.orderBy(h.asc_nulls_last(), F.col(id_col).asc_nulls_last()).limit(count)
    return flag_exact_global(df, fraction, count, id_col, seed, "_in").where("_in = 1").drop("_in")


def flag_exact_global(df: DataFrame, fraction: float | None = None, count: int | None = None, id_col: str = "post_id",
                      seed: int = 42, flag: str = "is_test") -> DataFrame:
    """All rows with ``flag`` 1 for exactly ceil(fraction x rows) (or ``count``)
    of them, those with the smallest (hash, id), and 0 for the others.

    Each row gets its flag in one pass; rows that share an id are ranked like
    any others, so nothing is lost or doubled."""
    keyed, bb, need, target = _boundary(df, fraction, count, id_col, seed)
    clear = keyed.where(bb.isNull() | (F.col("_b") != bb)).withColumn(
        flag, F.when(bb.isNull(), (target > 0).cast("int")).otherwise((F.col("_b") < bb).cast("int")))
    rk = Window.partitionBy("_b").orderBy("_h", id_col)
    edge = keyed.where(F.col("_b") == bb).withColumn(flag, (F.row_number().over(rk) <= need).cast("int"))
    return clear.unionByName(edge).drop("_h", "_b")


def bootstrap_n(df: DataFrame, group_col: str, n: int, id_col: str = "post_id", seed: int = 42) -> DataFrame:
    """n draws with replacement per group, of any size.

    Draw i of group g takes the row of rank pmod(md5(g:i:seed), size) + 1 in the
    group's hash order.  The rank is found through the group's bucket histogram
    (at most 2^20 rows per group): its cumulative counts and the draws are
    ordered together, which gives each draw its bucket and its rank there; only
    rows of drawn buckets are ranked, so no group is sorted in one task.
    """
    h = hash_key(id_col, seed)
    b = F.conv(F.substring(h, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")
    keyed = df.withColumns({"_h": h, "_b": b})
    hist = keyed.groupBy(group_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_prev", F.sum("_n").over(before) - F.col("_n"))
    sizes = hist.groupBy(group_col).agg(F.sum("_n").alias("_size"))
    draws = sizes.select(group_col, "_size", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_draw"))
    dkey = F.concat(F.col(group_col).cast("string"), F.lit(":"), F.col("_draw").cast("string"), F.lit(f":{seed}"))
    at = F.pmod(F.conv(F.substring(F.md5(dkey), 1, 8), 16, 10).cast("bigint"), F.col("_size"))
    marks = cum.select(group_col, F.col("_prev").alias("_at"), F.lit(None).cast("int").alias("_draw"), F.col("_b").alias("_db")) \
        .unionByName(draws.select(group_col, at.alias("_at"), "_draw", F.lit(None).cast("int").alias("_db")))
    here = Window.partitionBy(group_col).orderBy("_at", F.col("_draw").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (marks.withColumn("_bucket", F.last("_db", ignorenulls=True).over(here))
             .withColumn("_start", F.max(F.when(F.col("_draw").isNull(), F.col("_at"))).over(here))
             .where(F.col("_draw").isNotNull())
             .select(group_col, F.col("_bucket").alias("_b"), (F.col("_at") - F.col("_start") + 1).alias("_rank")))
    rk = Window.partitionBy(group_col, "_b").orderBy("_h", id_col)
    ranked = (keyed.join(found.select(group_col, "_b").distinct(), [group_col, "_b"], "left_semi")
              .withColumn("_rank", F.row_number().over(rk).cast("long")))
    return found.join(ranked, [group_col, "_b", "_rank"], "inner").select(*df.columns)


# ------------------------------------------------------------------ balancing
def merge_expert(df: DataFrame) -> DataFrame:
    return df.withColumn("level", F.when(F.col("level") == "Expert", F.lit("Senior")).otherwise(F.col("level")))


def level_targets(df: DataFrame, cap_limit: int = 2000, keep_ratio: float = 0.7) -> DataFrame:
    """(level, target): cap = min(2 x median class size, 2000); larger classes keep
    max(cap, floor(0.7 n)).  Computed on the class-size table (one row per level)."""
    sizes = df.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    med = sizes.select(F.median("n")).scalar()
    cap = F.least(med * 2, F.lit(float(cap_limit)))
    target = F.when(F.col("n") > cap, F.greatest(cap, F.floor(F.col("n") * keep_ratio))).otherwise(F.col("n"))
    return sizes.select("level", target.cast("long").alias("target"))


def balance_levels(df: DataFrame, min_fresher: int = 10, seed: int = 42, bucket: str | None = None) -> DataFrame:
    """Expert -> Senior; drop Fresher if rare; sample large classes down (exactly)."""
    d = merge_expert(df)
    n_fresher = d.where(F.col("level") == "Fresher").select(F.count(F.lit(1))).scalar()
    d = d.where((F.col("level") != "Fresher") | (n_fresher >= min_fresher))
    return sample_exact_per_group(d, ["level"], level_targets(d), seed=seed, small_groups=True, bucket=bucket)


def salary_bracket(col: str = "salary") -> Column:
    return bin_right_closed(F.col(col), SALARY_BRACKETS)


def whole_rows(df: DataFrame, chosen: DataFrame, cols) -> DataFrame:
    """The rows of ``df`` that ``chosen`` has the columns ``cols`` of; ``chosen`` has
    few rows.  Of rows alike in ``cols`` as many as were chosen."""
    cols = list(cols)
    number = F.row_number().over(Window.partitionBy(*cols).orderBy(*cols))
    few = chosen.select(*cols).withColumn("_k", number)
    key = lambda names: F.broadcast(few.select(*[F.col(c).alias(f"__{c}") for c in names]))
    on = lambda names: functools.reduce(operator.and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"__{c}")) for c in names])
    found = df.join(key(cols), on(cols), "left_semi").withColumn("_k", number)
    return found.join(key([*cols, "_k"]), on([*cols, "_k"]), "left_semi").drop("_k")


def balance_brackets(df: DataFrame, per_bracket: int = 300, seed: int = 42, synth=None, whole: DataFrame | None = None,
                     bucket: str | None = None) -> DataFrame:
    """Exactly ``per_bracket`` rows for each of the 6 salary brackets.

    > n rows: the n smallest hashes; 1..n rows: n bootstrap draws; 0 rows:
    ``synth(spark, level, n, tag=bracket)`` synthetic rows of the bracket's
    level (default ``augment.synth_level``).  Rows outside every bracket are
    dropped.  Rows that are drawn from (``per_bracket`` a bracket at most) are
    written first.  With ``whole``, ``df`` is some columns of some of its rows,
    and the result has the others, too.
    """
    from ..session import materialise
    if synth is None:
        from .augment import synth_level as synth
    d = df.withColumn("salary_bracket", salary_bracket()).where(F.col("salary_bracket").isNotNull())
    sizes = {r[0]: r[1] for r in d.groupBy("salary_bracket").count().collect()}  # at most 6 rows
    big = [b for b, n in sizes.items() if n > per_bracket]
    targets = df.sparkSession.createDataFrame([(b, per_bracket) for b in big], "salary_bracket string, target long")
    chosen = materialise(sample_exact_per_group(d, ["salary_bracket"], targets, seed=seed, small_groups=True, bucket=bucket))
    if whole is not None:
        cols = [c for c in whole.columns if c in df.columns]
        chosen = materialise(whole_rows(whole, chosen, cols).withColumn("salary_bracket", salary_bracket()))
    sampled = F.col("salary_bracket").isin(big)
    out = chosen.where(sampled).unionByName(bootstrap_n(chosen.where(~sampled), "salary_bracket", per_bracket, seed=seed))
    for _lo, _hi, label in SALARY_BRACKETS:
        if label not in sizes:
            s = synth(df.sparkSession, BRACKET_LEVEL[label], per_bracket, tag=label).withColumn("salary_bracket", F.lit(label))
            out = out.unionByName(s, allowMissingColumns=True)
    return out.drop("salary_bracket")


def top_cities_other(df: DataFrame, k: int = 5) -> DataFrame:
    """Keep the k most frequent cities (ties by name), others -> 'Other'; big-city flag recomputed."""
    top = df.groupBy("city").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), F.asc("city")).limit(k) \
        .select("city", F.lit(True).alias("_top"))
    j = df.join(F.broadcast(top), "city", "left")  # k rows: bounded
    return j.withColumn("city", F.when(F.col("_top"), F.col("city")).otherwise(F.lit("Other"))) \
        .withColumn("is_big_city", F.col("city").isin(BIG_CITIES).cast("int")).drop("_top")


def balance_all(df: DataFrame, seed: int = 42, synth=None, per_level: int = 400) -> DataFrame:
    """Levels, then brackets, then cities; an empty input starts from
    ``per_level`` synthetic rows of each of the five levels.

    Each step reads its input several times (histograms, targets, joins), so
    the columns that decide and the hash bucket are written as Parquet first;
    whole rows are read once, for those that were chosen."""
    from ..session import materialise
    from .augment import LEVEL_RANGES, synth_level
    synth = synth or synth_level
    if df.isEmpty():
        for level in LEVEL_RANGES:
            df = df.unionByName(synth(df.sparkSession, level, per_level, tag=level), allowMissingColumns=True)
        df = materialise(df)
    merged = merge_expert(df)
    keys = materialise(merged.select("post_id", "level", "salary", hash_bucket("post_id", seed).alias("_bucket")))
    lv = materialise(balance_levels(keys, seed=seed, bucket="_bucket"))
    br = materialise(balance_brackets(lv, seed=seed, synth=synth, whole=merged, bucket="_bucket"))
    return top_cities_other(br)
