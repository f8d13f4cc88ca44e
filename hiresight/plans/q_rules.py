"""Queries: itemsets, association rules and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import SKILL_SUGGESTIONS, SKILL_VOCABULARY, VALID_IT_SKILLS
from ..operators import rules as RU
from ..sources.tables import table
from . import clean as C
from . import oracle as O
from ..session import materialise
from .catalog import register

CLEAN = O.clean_ctes()
W = O.with_ctes
VOCAB = [s for s in dict.fromkeys(SKILL_VOCABULARY) if s in set(VALID_IT_SKILLS)]


def skill_baskets(spark, sf):
    """One basket per clean posting: its skills within the market vocabulary."""
    return RU.skill_matrix(C.clean_postings(spark, sf), VOCAB).select(
        F.col("post_id").alias("profile_id"), "items", "salary")


def brand_baskets(spark, sf):
    """One basket per order: the distinct part brands it contains."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    pa = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return RU.baskets_from_pairs(li.join(pa, "l_partkey"), "l_orderkey", "p_brand")


SKILL_BASKETS_SQL = CLEAN + f""",
bk AS (SELECT post_id AS profile_id, salary,
              list_sort(list_intersect(list_distinct(skills), {O.str_list(VOCAB)})) AS items FROM clean)"""
BRAND_BASKETS_SQL = """bk AS (SELECT l_orderkey AS profile_id, list_sort(list_distinct(list(p_brand))) AS items
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""


def itemsets_sql(baskets_ctes: str) -> str:
    return baskets_ctes + """,
nb AS (SELECT count(*) AS n FROM bk),
subs AS (SELECT unnest(list_transform(range(1, (1 << len(items))),
                lambda m: list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1))) AS s FROM bk WHERE len(items) > 0),
fi AS (SELECT s AS items, count(*) AS freq, CAST(count(*) AS DOUBLE) / (SELECT n FROM nb) AS sup FROM subs GROUP BY s
       HAVING CAST(count(*) AS DOUBLE) / (SELECT n FROM nb) >= 0.03)"""


def rules_sql(baskets_ctes: str) -> str:
    return itemsets_sql(baskets_ctes) + """,
splits AS (SELECT items, sup, unnest(range(1, (1 << len(items)) - 1)) AS m FROM fi WHERE len(items) >= 2),
rs AS (SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a,
              list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS c, sup FROM splits),
rr AS (SELECT rs.a, rs.c, rs.sup, fa.sup AS asup, fc.sup AS csup, rs.sup / fa.sup AS conf,
              rs.sup / fa.sup / fc.sup AS lift
       FROM rs JOIN fi fa ON rs.a = fa.items JOIN fi fc ON rs.c = fc.items),
rules AS (SELECT * FROM rr WHERE lift >= 1.2)"""


ITEMSET_BODY = "SELECT array_to_string(items, ',') AS items, freq, round(sup, 6) AS support FROM fi"
RULES_BODY = """SELECT array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents,
    round(asup, 6) AS antecedent_support, round(csup, 6) AS consequent_support, round(sup, 6) AS support,
    round(conf, 6) AS confidence, round(lift, 6) AS lift, round(sup - asup * csup, 6) AS leverage,
    CASE WHEN conf >= 1 THEN CAST('inf' AS DOUBLE) ELSE round((1 - csup) / (1 - conf), 6) END AS conviction
    FROM rules"""


def _itemsets_out(fi):
    return fi.select(F.array_join("items", ",").alias("items"), "freq", F.round("support", 6).alias("support"))


def _rules_out(r):
    return r.select(F.array_join("antecedents", ",").alias("antecedents"),
                    F.array_join("consequents", ",").alias("consequents"),
                    *[F.round(c, 6).alias(c) for c in ("antecedent_support", "consequent_support", "support",
                                                       "confidence", "lift", "leverage")],
                    F.when(F.col("conviction") == float("inf"), F.col("conviction"))
                    .otherwise(F.round("conviction", 6)).alias("conviction"))


register("skill_matrix", W(SKILL_BASKETS_SQL, "SELECT profile_id, array_to_string(items, ',') AS items FROM bk"))(
    lambda spark, sf: skill_baskets(spark, sf).select("profile_id", F.array_join("items", ",").alias("items")))
register("frequent_itemsets", W(itemsets_sql(SKILL_BASKETS_SQL), ITEMSET_BODY))(
    lambda spark, sf: _itemsets_out(RU.frequent_itemsets(skill_baskets(spark, sf))))
register("frequent_itemsets_baskets", W(itemsets_sql(BRAND_BASKETS_SQL), ITEMSET_BODY))(
    lambda spark, sf: _itemsets_out(RU.frequent_itemsets(brand_baskets(spark, sf))))


def skill_rules(spark, sf):
    return RU.association_rules(materialise(RU.frequent_itemsets(materialise(skill_baskets(spark, sf)))))


register("association_rules", W(rules_sql(SKILL_BASKETS_SQL), RULES_BODY))(
    lambda spark, sf: _rules_out(skill_rules(spark, sf)))
register("rule_metrics", W(rules_sql(SKILL_BASKETS_SQL), """SELECT count(*) AS n_rules,
    round(max(lift), 6) AS max_lift, round(avg(conf), 6) AS avg_confidence FROM rules"""))(
    lambda spark, sf: skill_rules(spark, sf).agg(F.count(F.lit(1)).alias("n_rules"),
                                                 F.round(F.max("lift"), 6).alias("max_lift"),
                                                 F.round(F.avg("confidence"), 6).alias("avg_confidence")))
register("association_rules_baskets", W(rules_sql(BRAND_BASKETS_SQL), RULES_BODY))(
    lambda spark, sf: _rules_out(RU.association_rules(RU.frequent_itemsets(brand_baskets(spark, sf)))))


STATS_SQL = """,
ist AS (SELECT item, count(*) AS demand_count, avg(salary) AS avg_value FROM (SELECT unnest(items) AS item, salary FROM bk)
        GROUP BY item),
istats AS (SELECT *, avg_value - (SELECT avg(salary) FROM bk) AS increase FROM ist)"""


@register("recommend_from_rules", W(rules_sql(SKILL_BASKETS_SQL) + STATS_SQL + """,
hit AS (SELECT p.profile_id, r.a, r.c, r.lift, r.conf FROM bk p JOIN rules r ON list_has_all(p.items, r.a)),
cand AS (SELECT profile_id, a, lift, conf, unnest(c) AS item, items FROM hit JOIN bk USING (profile_id)),
cand2 AS (SELECT c.*, s.demand_count, s.avg_value, s.increase FROM cand c JOIN istats s USING (item)
          WHERE NOT list_contains(c.items, c.item)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_id, item ORDER BY round(lift, 2) DESC, lift DESC,
                 conf DESC, array_to_string(a, ','), item) AS r1 FROM cand2) WHERE r1 = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY round(lift, 2) DESC, lift DESC, conf DESC,
                 array_to_string(a, ','), item) AS rank FROM best)""",
    """SELECT profile_id, CAST(rank AS INTEGER) AS rank, item AS skill, array_to_string(a, ',') AS from_skills, round(lift, 2) AS lift,
       round(conf, 2) AS confidence, demand_count, round(avg_value, 1) AS avg_salary,
       round(increase, 1) AS salary_increase FROM top WHERE rank <= 10"""))
def q_recommend_from_rules(spark, sf):
    # baskets and itemsets are read by several steps: materialise them once
    b = materialise(skill_baskets(spark, sf))
    rules = materialise(RU.association_rules(materialise(RU.frequent_itemsets(b))))
    stats = RU.item_stats(b, "salary")
    return RU.recommend_from_rules(b.withColumnRenamed("items", "owned"), rules, stats, 10)


@register("recommend_fallback", W(SKILL_BASKETS_SQL + STATS_SQL + """,
hot AS (SELECT item, row_number() OVER (ORDER BY demand_count DESC, item) AS hr FROM istats QUALIFY hr <= 20),
cand AS (SELECT b.profile_id, h.item, h.hr FROM bk b, hot h WHERE NOT list_contains(b.items, h.item)),
ranked AS (SELECT profile_id, item, row_number() OVER (PARTITION BY profile_id ORDER BY hr) AS rank FROM cand)""",
    "SELECT profile_id, CAST(rank AS INTEGER) AS rank, item AS skill FROM ranked WHERE rank <= 10"))
def q_recommend_fallback(spark, sf):
    b = materialise(skill_baskets(spark, sf))
    return RU.recommend_fallback(b.withColumnRenamed("items", "owned"), RU.item_stats(b, "salary"), 10)


def _suggest_sql():
    rows = ", ".join(f"({O.q(k)}, {O.str_list(v)})" for k, v in SKILL_SUGGESTIONS)
    return f"sugg(k, v) AS (VALUES {rows})"


@register("recommend_from_map", W(SKILL_BASKETS_SQL + STATS_SQL + ",\n" + _suggest_sql() + """,
own AS (SELECT profile_id, list_transform(items, lambda s: upper(s)) AS up FROM bk),
ex AS (SELECT o.profile_id, unnest(s.v) AS skill, o.up FROM own o, (SELECT profile_id, unnest(up) AS k FROM own) u
       JOIN sugg s ON u.k = s.k WHERE o.profile_id = u.profile_id),
cnt AS (SELECT profile_id, skill, count(*) AS count FROM ex WHERE NOT list_contains(up, skill) GROUP BY profile_id, skill),
rk AS (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY count DESC, skill) AS rank FROM cnt)""",
    """SELECT profile_id, skill, count, CAST(rank AS INTEGER) AS rank, round(avg_value, 1) AS avg_salary
    FROM rk LEFT JOIN istats ON upper(item) = skill WHERE rank <= 10"""))
def q_recommend_from_map(spark, sf):
    b = skill_baskets(spark, sf)
    return RU.recommend_from_map(b.withColumnRenamed("items", "owned"), SKILL_SUGGESTIONS, 10, stats=RU.item_stats(b, "salary"))
