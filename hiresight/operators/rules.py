"""Frequent itemsets, association rules and recommendations.

Itemsets come from Spark ML's distributed FP-growth.  Rules are expanded
here because Spark's own ``associationRules`` emits single-item consequents
only: consequents of any size are grown level by level, pruned by confidence,
and supports are attached by equi-joins on the sorted item arrays (the itemset
table is small and AQE broadcasts it once measured).
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .relational import scalar


def baskets_from_pairs(pairs: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """(basket, items sorted distinct) from (basket, item) rows.

    ``collect_set`` is combined map-side, so a basket spread over many rows
    costs at most one set of distinct items per map task.
    """
    return pairs.groupBy(basket_col).agg(F.array_sort(F.collect_set(item_col)).alias("items"))


def skill_matrix(df: DataFrame, vocabulary, skills_col: str = "skills") -> DataFrame:
    """Basket per posting restricted to the vocabulary (the boolean matrix, sparse)."""
    vocab = F.array(*[F.lit(v) for v in dict.fromkeys(vocabulary)])
    # an intersection has no repeats and, as the vocabulary, no nulls
    return df.select("*", F.sort_array(F.array_intersect(F.col(skills_col), vocab)).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.03, items_col: str = "items") -> DataFrame:
    """(items sorted, freq, support) for all itemsets with support >= min_support.

    FP-growth runs with a hair lower threshold and the exact ``freq / n >=
    min_support`` test is applied afterwards, so the boundary matches the
    definition regardless of how the threshold is rounded to a count.
    """
    b = baskets.where(F.size(items_col) > 0).select(F.col(items_col).alias("items"))
    n = scalar(baskets, F.count(F.lit(1)))
    model = FPGrowth(itemsCol="items", minSupport=max(min_support - 1e-9, 0.0), minConfidence=0.0).fit(b)
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("long").alias("freq"))
    return fi.withColumn("support", F.col("freq") / n).where(F.col("freq") / n >= min_support)


def association_rules(itemsets: DataFrame, min_lift: float = 1.2, max_len: int | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Every split A -> C of every frequent itemset (|I| >= 2) with lift >= min_lift and confidence >= min_confidence.

    Columns: antecedents, consequents (sorted arrays), antecedent_support,
    consequent_support, support, confidence, lift, leverage, conviction.

    Consequents grow item by item, each from the one without its last item.  The
    smaller antecedent that is left can only be more frequent, so a split is not
    grown further once its confidence is below min_confidence or its antecedent's
    support above 1 / min_lift: a consequent is at least as frequent as the whole
    itemset, so confidence < min_lift * support(I) rules the lift out.  Antecedents
    must be itemsets themselves, which those of all frequent itemsets are.
    """
    big = itemsets.where(F.size("items") >= 2)
    if max_len:
        big = big.where(F.size("items") <= max_len)
    sup = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    longest = big.agg(F.max(F.size("items"))).first()[0] or 0
    grown = big.select("items", "support", F.array().cast("array<string>").alias("consequents"), F.lit(0).alias("last"))
    levels = []
    for _ in range(longest - 1):
        # the items after the last one taken; at least one stays in the antecedent
        taken = (grown.where(F.size("consequents") < F.size("items") - 1)
                 .select("*", F.posexplode(F.slice("items", F.col("last") + 1, F.size("items"))).alias("__at", "__item")))
        split = taken.select("items", "support", F.array_append("consequents", F.col("__item")).alias("consequents"), (F.col("last") + F.col("__at") + 1).alias("last"))
        split = split.withColumn("antecedents", F.array_except("items", "consequents")).join(sup, "antecedents")
        conf = F.col("support") / F.col("antecedent_support")
        grown = materialise(split.where((conf >= min_confidence) & (F.col("antecedent_support") * min_lift <= 1 + 1e-9)))
        levels.append(grown)
        if grown.isEmpty():
            break
    if not levels:
        levels = [grown.select("*", F.col("items").alias("antecedents"), F.lit(0.0).alias("antecedent_support")).limit(0)]
    all_ = levels[0]
    for level in levels[1:]:
        all_ = all_.unionByName(level)
    j = all_.join(itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support")), "consequents")
    conf = F.col("support") / F.col("antecedent_support")
    lift = conf / F.col("consequent_support")
    out = j.select("antecedents", "consequents", "antecedent_support", "consequent_support", "support",
                   conf.alias("confidence"), lift.alias("lift"),
                   (F.col("support") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
                   F.when(conf >= 1.0, F.lit(float("inf")))
                    .otherwise((1 - F.col("consequent_support")) / (1 - conf)).alias("conviction"))
    return out.where(F.col("lift") >= min_lift)


def item_stats(baskets: DataFrame, value_col: str, items_col: str = "items") -> DataFrame:
    """(item, demand_count, avg_value, increase over the global mean of value)."""
    g = scalar(baskets, F.avg(value_col))
    st = (baskets.select(F.explode(items_col).alias("item"), value_col)
          .groupBy("item").agg(F.count(F.lit(1)).alias("demand_count"), F.avg(value_col).alias("avg_value")))
    return st.withColumn("increase", F.col("avg_value") - g)


def per_distinct_basket(fn):
    """Run a recommender once per distinct owned set and join the result back.

    Profiles with the same skills get the same recommendations, and distinct
    skill sets are far fewer than profiles; the result is keyed by the set and
    attached to each profile with one equi-join on that key (AQE broadcasts the
    per-set table when it is measured small, or splits a hot key).
    """
    def wrapped(profiles: DataFrame, *args, profile_col: str = "profile_id", owned_col: str = "owned", **kw):
        key = F.array_join(F.array_sort(F.array_distinct(F.col(owned_col))), "|")
        keyed = profiles.select(profile_col, key.alias("_set"))
        sets = profiles.select(key.alias("_set"), F.array_sort(F.array_distinct(F.col(owned_col))).alias(owned_col)) \
            .dropDuplicates(["_set"])
        recs = fn(sets, *args, profile_col="_set", owned_col=owned_col, **kw)
        return keyed.join(recs, "_set").drop("_set")
    wrapped.__doc__ = fn.__doc__
    wrapped.per_profile = fn
    return wrapped


@per_distinct_basket
def recommend_from_rules(profiles: DataFrame, rules: DataFrame, stats: DataFrame, top_n: int = 10,
                         profile_col: str = "profile_id", owned_col: str = "owned") -> DataFrame:
    """Per profile: consequent items of rules whose antecedents are all owned,
    not owned yet, best rule per item, top n by (rounded lift, lift, confidence).

    Matching is an equi-join on items: profiles and rule antecedents are
    exploded, joined on the item, and a (profile, rule) pair qualifies when it
    matched every antecedent item (no profile x rule product).
    """
    order = [F.desc(F.round("lift", 2)), F.desc("lift"), F.desc("confidence"),
             F.asc(F.array_join("antecedents", ",")), F.asc("item")]
    # 1. compress the rules: best rule per (antecedent set, recommended item)
    per_item = rules.select("antecedents", "lift", "confidence", F.explode("consequents").alias("item"))
    per_item = per_item.withColumn("_r", F.row_number().over(
        Window.partitionBy("antecedents", "item").orderBy(*order))).where(F.col("_r") == 1).drop("_r")
    per_item = per_item.withColumn("ante_id", F.array_join("antecedents", ","))
    # 2. profiles that own every item of an antecedent set (equi-join on items)
    antes = per_item.select("ante_id", "antecedents").distinct().withColumn("n_ante", F.size("antecedents"))
    ante_items = antes.select("ante_id", "n_ante", F.explode("antecedents").alias("item"))
    owned = profiles.select(profile_col, F.explode(owned_col).alias("item"))
    hits = (owned.join(ante_items, "item").groupBy(profile_col, "ante_id", "n_ante")
            .agg(F.count(F.lit(1)).alias("m")).where(F.col("m") == F.col("n_ante")).select(profile_col, "ante_id"))
    # 3. their recommended items not owned yet, best rule per item, top n
    cand = hits.join(per_item, "ante_id").join(owned, [profile_col, "item"], "left_anti").join(stats, "item")
    best = cand.withColumn("_r", F.row_number().over(Window.partitionBy(profile_col, "item").orderBy(*order))) \
        .where(F.col("_r") == 1).drop("_r")
    top = best.withColumn("rank", F.row_number().over(Window.partitionBy(profile_col).orderBy(*order))) \
        .where(F.col("rank") <= top_n)
    return top.select(profile_col, "rank", F.col("item").alias("skill"), F.col("ante_id").alias("from_skills"),
                      F.round("lift", 2).alias("lift"), F.round("confidence", 2).alias("confidence"),
                      "demand_count", F.round("avg_value", 1).alias("avg_salary"),
                      F.round("increase", 1).alias("salary_increase"))


@per_distinct_basket
def recommend_fallback(profiles: DataFrame, stats: DataFrame, top_n: int = 10,
                       profile_col: str = "profile_id", owned_col: str = "owned") -> DataFrame:
    """No rules: the 2n most demanded items minus the owned ones, first n.

    The hot list has at most 2n items (a proven bound), so it is fetched once
    and enters the plan as a literal array; there is no join with profiles.
    """
    hot = [r["item"] for r in stats.orderBy(F.desc("demand_count"), F.asc("item")).limit(2 * top_n).collect()]
    ordered = F.array(*[F.lit(h) for h in hot]) if hot else F.array().cast("array<string>")
    recs = F.slice(F.filter(ordered, lambda x: ~F.array_contains(F.col(owned_col), x)), 1, top_n)
    return profiles.select(profile_col, F.posexplode(recs).alias("pos", "skill")) \
        .select(profile_col, (F.col("pos") + 1).alias("rank"), "skill")


@per_distinct_basket
def recommend_from_map(profiles: DataFrame, suggestions, top_n: int = 10, profile_col: str = "profile_id",
                       owned_col: str = "owned", stats: DataFrame | None = None) -> DataFrame:
    """Static skill -> suggestions map: count suggestions of unowned skills, top n;
    with ``stats`` (item, avg_value) also the mean salary of those who have the skill."""
    m = F.create_map(*[x for k, v in suggestions for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    up = F.transform(F.col(owned_col), lambda s: F.upper(s))
    sug = F.flatten(F.transform(up, lambda s: F.coalesce(F.element_at(m, s), F.array().cast("array<string>"))))
    ex = profiles.select(profile_col, up.alias("_owned"), F.explode(sug).alias("skill")) \
        .where(~F.array_contains(F.col("_owned"), F.col("skill")))
    cnt = ex.groupBy(profile_col, "skill").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(profile_col).orderBy(F.desc("count"), F.asc("skill"))
    top = cnt.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
    if stats is None:
        return top
    pay = stats.select(F.upper("item").alias("skill"), F.round("avg_value", 1).alias("avg_salary"))
    return top.join(pay, "skill", "left").select(*top.columns, "avg_salary")
