"""Queries: scalar parsers, relational steps, skills and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions import salary as S
from ..functions import skills as K
from ..functions import text as T
from ..functions.constants import (BASIC_SKILLS, SALARY_BRACKETS, SKILL_COMBOS, TITLE_SKILL_RULES,
                                   TITLE_SKILL_RULES_ALT, VALID_IT_SKILLS)
from ..operators import enrich as E
from ..operators import relational as R
from ..sources.postings import raw_postings
from . import clean as C
from . import oracle as O
from .catalog import csv, register

POSTING = O.posting_ctes()
CLEAN = O.clean_ctes()
ENRICHED = O.enriched_ctes()
W = O.with_ctes


# ------------------------------------------------------------ posting layer
@register("conform_schema", W(POSTING, """
SELECT post_id, source_rank, title, company, city_raw, salary_min, salary_max, exp_raw, description,
       working_form, source FROM posting"""))
def q_conform_schema(spark, sf):
    return C.postings(spark, sf).drop("source_url")


@register("union_feeds", W(POSTING, "SELECT post_id, source_rank, source, title, company FROM posting"))
def q_union_feeds(spark, sf):
    raw = raw_postings(spark, sf)
    a = R.conform_schema(raw.where(F.col("source") == "feed_a").drop("source"), source="feed_a")
    b = R.conform_schema(raw.where(F.col("source") == "feed_b").drop("source"), source="feed_b")
    return R.union_feeds(a, b).select("post_id", "source_rank", "source", "title", "company")


@register("concat_text", W(POSTING, "SELECT post_id, description FROM posting"))
def q_concat_text(spark, sf):
    return C.postings(spark, sf).select("post_id", "description")


@register("tag_source", W(POSTING, "SELECT source, count(*) AS n FROM posting GROUP BY source"))
def q_tag_source(spark, sf):
    return C.postings(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("dedup_keep_first", W(CLEAN, "SELECT post_id, source_rank, title, company FROM dedup"))
def q_dedup(spark, sf):
    return C.dedup_postings(C.postings(spark, sf)).select("post_id", "source_rank", "title", "company")


@register("filter_domain", W(CLEAN, "SELECT post_id, title FROM domain"))
def q_filter_domain(spark, sf):
    return R.filter_domain(C.dedup_postings(C.postings(spark, sf))).select("post_id", "title")


@register("salary_midpoint", W(CLEAN, "SELECT post_id, salary FROM sal"))
def q_salary_midpoint(spark, sf):
    d = R.filter_domain(C.dedup_postings(C.postings(spark, sf)))
    return C.add_salary(d).select("post_id", "salary")


@register("fill_missing_median", W(CLEAN, "SELECT post_id, salary FROM filled"))
def q_fill_median(spark, sf):
    return R.fill_missing_median(C.domain_layer(spark, sf)).select("post_id", "salary")


@register("filter_salary_range", W(CLEAN, "SELECT post_id, salary FROM clean"))
def q_filter_salary_range(spark, sf):
    return C.clean_postings(spark, sf).select("post_id", "salary")


def _raw_text_query(col_spark, alias):
    def fn(spark, sf):
        return C.postings(spark, sf).select("post_id", col_spark().alias(alias))
    return fn


def _sal_text(parser):
    def fn(spark, sf):
        raw = raw_postings(spark, sf)
        st = parser(F.col("salary_raw"))
        return raw.select("post_id", "salary_raw", st["salary_min"].alias("salary_min"),
                          st["salary_max"].alias("salary_max"))
    return fn


_a_lo, _a_hi = O.salary_text_a_sql("salary_raw")
_b_lo, _b_hi = O.salary_text_b_sql("salary_raw")
register("parse_salary_text_a", W(POSTING, f"SELECT post_id, salary_raw, {_a_lo} AS salary_min, {_a_hi} AS salary_max FROM raw"))(
    _sal_text(S.parse_salary_text_a))
register("parse_salary_text_b", W(POSTING, f"SELECT post_id, salary_raw, {_b_lo} AS salary_min, {_b_hi} AS salary_max FROM raw"))(
    _sal_text(S.parse_salary_text_b))

register("parse_years", W(POSTING, f"SELECT post_id, {O.years_sql('exp_raw')} AS exp_years FROM posting"))(
    _raw_text_query(lambda: P.parse_years(F.col("exp_raw")), "exp_years"))
register("seniority_level", W(POSTING, f"SELECT post_id, {O.level_sql(O.years_sql('exp_raw'))} AS level FROM posting"))(
    _raw_text_query(lambda: P.seniority_level(P.parse_years(F.col("exp_raw"))), "level"))
register("clean_city", W(POSTING, f"SELECT post_id, {O.city_sql('city_raw')} AS city FROM posting"))(
    _raw_text_query(lambda: P.clean_city(F.col("city_raw")), "city"))
register("clean_city_advanced", W(POSTING, f"SELECT post_id, {O.city_advanced_sql('city_raw')} AS city FROM posting"))(
    _raw_text_query(lambda: P.clean_city_advanced(F.col("city_raw")), "city"))
register("detect_remote", W(POSTING, """SELECT post_id, CAST(coalesce(regexp_matches(lower(description),
    'remote|work from home|wfh|hybrid'), false) AS INTEGER) AS remote FROM posting"""))(
    _raw_text_query(lambda: T.detect_remote(F.col("description")), "remote"))
register("detect_english", W(POSTING, """SELECT post_id, CAST(coalesce(regexp_matches(lower(description),
    'english|ielts|toeic|toefl'), false) AS INTEGER) AS english FROM posting"""))(
    _raw_text_query(lambda: T.detect_english(F.col("description")), "english"))
register("text_clean", W(POSTING, """SELECT post_id,
    trim(regexp_replace(coalesce(title, '') || '  ' || coalesce(working_form, ''), '\\s+', ' ', 'g')) AS text
    FROM posting"""))(
    _raw_text_query(lambda: T.text_clean(F.concat(F.col("title"), F.lit("  "), F.col("working_form"))), "text"))
register("text_normalise", W(POSTING, f"SELECT post_id, {O.norm_sql('description')} AS norm FROM posting"))(
    _raw_text_query(lambda: T.normalise_for_skills(F.col("description")), "norm"))


@register("safe_numeric", W(POSTING, """SELECT post_id,
    CASE WHEN isnan(TRY_CAST(t AS DOUBLE)) THEN NULL ELSE TRY_CAST(t AS DOUBLE) END AS value
    FROM (SELECT post_id, CASE post_id % 4 WHEN 0 THEN salary_raw WHEN 1 THEN 'nan' ELSE CAST(post_id % 1000 AS VARCHAR) || '.5' END AS t
          FROM raw)"""))
def q_safe_numeric(spark, sf):
    """Salary texts, 'nan' and plain numbers as they stand in raw columns."""
    i = F.col("post_id")
    t = F.when(i % 4 == 0, F.col("salary_raw")).when(i % 4 == 1, F.lit("nan")).otherwise(F.concat((i % 1000).cast("string"), F.lit(".5")))
    return raw_postings(spark, sf).select("post_id", S.safe_numeric(t).alias("value"))


_SKILL_NAMES = [e[0] for e in K.lexicon_entries()]


@register("word_ngrams", W(POSTING, f"""
, words AS (SELECT list_filter(string_split(trim({O.norm_sql('description')}), ' '), lambda w: w <> '') AS w
            FROM posting)
SELECT g AS ngram, size, count(*) AS n, g IN ({", ".join(O.q(n) for n in _SKILL_NAMES)}) AS is_skill FROM (
  SELECT 2 AS size, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) >= 2
  UNION ALL SELECT 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM words WHERE len(w) >= 3) GROUP BY g, size"""))
def q_word_ngrams(spark, sf):
    """Bigrams and trigrams with their counts, and whether they name a skill."""
    w = T.words(T.normalise_for_skills(F.col("description")))

    def sized(x, n):
        return F.transform(T.word_ngrams(x, n), lambda g: F.struct(g.alias("ngram"), F.lit(n).alias("size")))

    grams = T.let(w, lambda x: F.concat(sized(x, 2), sized(x, 3)))
    return (C.postings(spark, sf).select(F.inline(grams)).groupBy("ngram", "size").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("is_skill", F.col("ngram").isin(_SKILL_NAMES)))


# ------------------------------------------------------------ skills
register("skill_extract", W(POSTING, f"SELECT post_id, array_to_string({O.skills_sql('description')}, ',') AS skills FROM posting"))(
    _raw_text_query(lambda: F.array_join(K.skill_extract(F.col("description")), ","), "skills"))
_NAMES = list(dict.fromkeys(VALID_IT_SKILLS))
DESCRIPTIONS = "dd AS (SELECT DISTINCT description AS d FROM posting)"
register("skill_extract_word", W(POSTING + f""",
{DESCRIPTIONS}, {O.names_table("nm", _NAMES)},
hit AS (SELECT d, list_sort(list(name)) AS sk FROM dd, nm WHERE regexp_matches(lower(d), pat) GROUP BY d)""",
    "SELECT post_id, coalesce(array_to_string(sk, ','), '') AS skills FROM posting LEFT JOIN hit ON description = d"))(
    _raw_text_query(lambda: F.array_join(K.skill_extract_names(F.col("description"), _NAMES), ","), "skills"))
register("skill_whitelist", W(CLEAN, "SELECT post_id, array_to_string(skills, ',') AS skills FROM clean"))(
    lambda spark, sf: C.clean_postings(spark, sf).select("post_id", csv("skills").alias("skills")))
register("skill_count", W(CLEAN, "SELECT post_id, num_skills FROM clean"))(
    lambda spark, sf: C.clean_postings(spark, sf).select("post_id", "num_skills"))


def _flag_cols_sql():
    return ", ".join(f"CAST(list_contains(skills, {O.q(v)}) AS INTEGER) AS \"skill_{v}\""
                     for v in dict.fromkeys(VALID_IT_SKILLS))


@register("skill_one_hot", W(CLEAN, f"SELECT post_id, {_flag_cols_sql()} FROM clean"))
def q_one_hot(spark, sf):
    c = C.clean_postings(spark, sf)
    return c.select("post_id", *K.skill_one_hot("skills", list(dict.fromkeys(VALID_IT_SKILLS))))


@register("skill_explode", W(CLEAN, "SELECT post_id, unnest(skills) AS skill FROM clean"))
def q_skill_explode(spark, sf):
    return C.clean_postings(spark, sf).select("post_id", F.explode("skills").alias("skill"))


def _lex_attr_sql(attr):
    idx = {"category": 1, "weight": 2}[attr]
    vals = ", ".join(f"({O.q(e[0])}, {O.q(e[idx]) if attr == 'category' else 'CAST(' + repr(e[idx]) + ' AS DOUBLE)'})"
                     for e in K.lexicon_entries())
    return f"lex_attr(skill, v) AS (VALUES {vals})"


@register("skill_categories", W(POSTING + ",\n" + _lex_attr_sql("category"), f"""
SELECT post_id, l.v AS category, count(*) AS n
FROM (SELECT post_id, unnest({O.skills_sql('description')}) AS skill FROM posting) s JOIN lex_attr l ON s.skill = l.skill
GROUP BY post_id, l.v"""))
def q_skill_categories(spark, sf):
    """How many skills of each category a posting asks for; counted inside the row, no shuffle."""
    found = F.transform(K.skill_extract(F.col("description")), lambda s: F.element_at(K.skill_attr_map("category"), s))
    # bound once a row: the lambda over the categories would extract the skills again for each of them
    counted = T.let(found, lambda cats: F.transform(F.array_distinct(cats), lambda c: F.struct(
        c.alias("category"), F.size(F.filter(cats, lambda x: x == c)).cast("long").alias("n"))))
    return C.postings(spark, sf).select("post_id", F.inline(counted))


@register("skill_weight", W(POSTING + ",\n" + _lex_attr_sql("weight"), f"""
SELECT p.post_id, round(coalesce(sum(l.v), 0), 6) AS weight
FROM posting p LEFT JOIN (SELECT post_id, unnest({O.skills_sql('description')}) AS skill FROM posting) s
  ON p.post_id = s.post_id LEFT JOIN lex_attr l ON s.skill = l.skill
GROUP BY p.post_id"""))
def q_skill_weight(spark, sf):
    wmap = K.skill_attr_map("weight")
    sk = K.skill_extract(F.col("description"))
    w = F.aggregate(sk, F.lit(0.0), lambda acc, s: acc + F.coalesce(F.element_at(wmap, s), F.lit(0.0)))
    return C.postings(spark, sf).select("post_id", F.round(w, 6).alias("weight"))


# --- FIXED VALUES: the eight skills checked for near-miss spellings.
FUZZY_TARGETS = ["python", "java", "javascript", "react", "angular", "docker", "kubernetes", "aws"]


def ratio_sql(words: str) -> str:
    """CTEs after ``tg(t)``: ``ratio(w, t, s)`` of the distinct words of a table and the targets, by matching blocks."""
    sub = "substr(b, CAST(i AS BIGINT), CAST(l AS BIGINT))"
    return f"""rounds(w, t, a, b, l) AS (
  SELECT DISTINCT w, t, w, t, CAST(0 AS BIGINT) FROM {words}, tg WHERE 2.0 * least(length(w), length(t)) / (length(w) + length(t)) >= 0.8
  UNION ALL
  SELECT w, t, p.a, p.b, p.l FROM (
    SELECT w, t, unnest([{{'a': substr(a, 1, -k.p - 1), 'b': substr(b, 1, -k.i - 1), 'l': k.l}},
                         {{'a': substr(a, -k.p + k.l), 'b': substr(b, -k.i + k.l), 'l': 0}}]) AS p
    FROM (SELECT w, t, a, b, list_sort(list_filter(flatten(list_transform(range(1, length(b) + 1), lambda i: list_transform(
            range(1, length(b) - i + 2), lambda l: {{'l': l, 'p': -instr(a, {sub}), 'i': -i}}))), lambda x: x.p < 0), 'DESC')[1] AS k
          FROM rounds WHERE a <> '' AND b <> '') WHERE k IS NOT NULL)),
ratio AS (SELECT w, t, 2.0 * sum(l) / (length(w) + length(t)) AS s FROM rounds GROUP BY w, t)"""


@register("fuzzy_match", W(POSTING + f""",
{DESCRIPTIONS},
ws AS (SELECT d, unnest(w) AS w FROM (SELECT d, list_filter(string_split({O.norm_sql('d')}, ' '), lambda x: x <> '') AS w FROM dd)),
tg(t) AS (VALUES {", ".join(f"('{t}')" for t in FUZZY_TARGETS)}),
{ratio_sql("ws")},
best AS (SELECT DISTINCT d, t, w FROM ws JOIN ratio USING (w) WHERE s >= 0.8 QUALIFY dense_rank() OVER (PARTITION BY d, t ORDER BY s DESC, w DESC) = 1),
hit AS (SELECT d, array_to_string(list_sort(list(t || ':' || w)), ',') AS m FROM best GROUP BY d)""",
    "SELECT post_id, coalesce(m, '') AS matches FROM posting LEFT JOIN hit ON description = d").replace("WITH ", "WITH RECURSIVE ", 1))
def q_fuzzy_match(spark, sf):
    """Each target with its closest word (matching-block ratio of at least 0.8)."""
    from ..functions.fuzzy import best_close_word

    def pairs(w):
        return F.array_compact(F.array(*[F.concat(F.lit(t + ":"), best_close_word(w, t)) for t in FUZZY_TARGETS]))

    matches = T.let(T.words(T.normalise_for_skills(F.col("description"))), pairs)
    return C.postings(spark, sf).select("post_id", F.coalesce(F.array_join(F.array_sort(matches), ","), F.lit("")).alias("matches"))


def _rules_sql(rules):
    return "[" + ", ".join(f"{{'p': {O.q(p)}, 'sk': {O.str_list(sk)}}}" for p, sk in rules) + "]"


VOCAB_SQL = O.str_list(list(dict.fromkeys(VALID_IT_SKILLS)))


@register("skill_repair_high_pay", W(CLEAN, f"""
, rep AS (
  SELECT post_id, skills, salary, num_skills,
         list_filter(list_transform({_rules_sql(TITLE_SKILL_RULES)}, lambda r: {{'p': r.p,
             'new': list_filter(r.sk, lambda x: NOT list_contains(skills, x) AND list_contains({VOCAB_SQL}, x))}}),
           lambda a: instr(lower(title), a.p) > 0 AND len(a.new) > 0) AS app
  FROM clean)
SELECT post_id, array_to_string(CASE WHEN salary > 20 AND num_skills < 3 THEN
         list_sort(list_distinct(list_concat(skills, CASE WHEN len(app) > 0 THEN app[1].new
                                                     ELSE {O.str_list(BASIC_SKILLS)} END)))
         ELSE skills END, ',') AS skills
FROM rep""".replace("\n, rep", ",\nrep", 1)))
def q_repair_high_pay(spark, sf):
    return E.skill_repair_high_pay(C.clean_postings(spark, sf)).select("post_id", csv("skills").alias("skills"))


@register("skill_repair_by_title", W(CLEAN, f"""
SELECT post_id, array_to_string(list_sort(list_distinct(list_concat(skills, flatten(list_transform(
         list_filter({_rules_sql(TITLE_SKILL_RULES_ALT)}, lambda r: instr(lower(title), r.p) > 0),
         lambda r: list_filter(r.sk, lambda x: list_contains({VOCAB_SQL}, x))))))), ',') AS skills
FROM clean"""))
def q_repair_by_title(spark, sf):
    return E.skill_repair_by_title(C.clean_postings(spark, sf)).select("post_id", csv("skills").alias("skills"))


# ------------------------------------------------------------ enrichment
def enriched(spark, sf):
    return C.enriched_layer(spark, sf)


register("company_size", W(ENRICHED, "SELECT post_id, company, company_size, company_size_category, is_big_company FROM enriched"))(
    lambda spark, sf: enriched(spark, sf).select("post_id", "company", "company_size", "company_size_category",
                                                 "is_big_company"))
register("company_counts", W(CLEAN, "SELECT company, count(*) AS company_size FROM clean GROUP BY company"))(
    lambda spark, sf: E.company_counts(C.clean_postings(spark, sf)))
register("city_premium", W(ENRICHED, "SELECT post_id, city, city_multiplier, is_big_city FROM enriched"))(
    lambda spark, sf: E.add_city_premium(C.clean_postings(spark, sf)).select("post_id", "city", "city_multiplier",
                                                                              "is_big_city"))
_combo_names = ", ".join(f"combo_{n}" for n, _ in SKILL_COMBOS)
register("skill_combos", W(ENRICHED, f"SELECT post_id, {_combo_names}, num_high_value_skills FROM enriched"))(
    lambda spark, sf: E.add_skill_combinations(C.clean_postings(spark, sf)).select(
        "post_id", *[f"combo_{n}" for n, _ in SKILL_COMBOS], "num_high_value_skills"))
_inter = ("round(exp_skill_interaction, 6) AS exp_skill_interaction, round(exp_high_value, 6) AS exp_high_value, "
          "round(exp_squared, 6) AS exp_squared, remote_english, remote_big_city, "
          "round(salary_per_skill, 6) AS salary_per_skill")


def _round_inter(df):
    return df.select("post_id", *[F.round(c, 6).alias(c) for c in
                                  ("exp_skill_interaction", "exp_high_value", "exp_squared")],
                     "remote_english", "remote_big_city", F.round("salary_per_skill", 6).alias("salary_per_skill"))


register("interactions", W(ENRICHED, f"SELECT post_id, {_inter} FROM enriched"))(
    lambda spark, sf: _round_inter(enriched(spark, sf)))

ENRICHED_COLS = ["post_id", "title", "company", "city", "salary", "exp_years", "num_skills", "remote", "english",
                 "level", "company_size", "company_size_category", "is_big_company", "city_multiplier",
                 "is_big_city"] + [f"combo_{n}" for n, _ in SKILL_COMBOS] + ["num_high_value_skills"]


@register("enrich_all", W(ENRICHED, f"SELECT {', '.join(ENRICHED_COLS)}, array_to_string(skills, ',') AS skills FROM enriched"))
def q_enrich_all(spark, sf):
    return enriched(spark, sf).select(*ENRICHED_COLS, csv("skills").alias("skills"))


@register("salary_outlier_adjust", W(ENRICHED, """
, ex AS (SELECT post_id, salary, 8 + least(exp_years * 1.5, 15) + num_skills * 0.8
                + CASE WHEN is_big_city = 1 THEN 2 ELSE 0 END + CASE WHEN english = 1 THEN 2 ELSE 0 END AS e
         FROM enriched)
SELECT post_id, round(CASE WHEN salary > e * 1.5 THEN round(e * 1.2, 1) WHEN salary < e * 0.7 THEN round(e * 0.8, 1)
                      ELSE salary END, 6) AS salary FROM ex""".replace("\n, ex", ",\nex", 1)))
def q_outlier(spark, sf):
    return E.salary_outlier_adjust(enriched(spark, sf)).select("post_id", F.round("salary", 6).alias("salary"))


@register("bin_right_closed", W(CLEAN, """SELECT post_id, CASE WHEN salary > 0 AND salary <= 10 THEN '<10M'
    WHEN salary > 10 AND salary <= 15 THEN '10-15M' WHEN salary > 15 AND salary <= 20 THEN '15-20M'
    WHEN salary > 20 AND salary <= 30 THEN '20-30M' WHEN salary > 30 AND salary <= 50 THEN '30-50M'
    WHEN salary > 50 AND salary <= 100 THEN '>50M' END AS salary_bracket FROM clean"""))
def q_bin(spark, sf):
    return C.clean_postings(spark, sf).select("post_id", P.bin_right_closed(F.col("salary"), SALARY_BRACKETS)
                                              .alias("salary_bracket"))


@register("trim_quantiles", W(CLEAN, """SELECT post_id, salary FROM clean
    WHERE salary >= (SELECT quantile_cont(salary, 0.02) FROM clean)
      AND salary <= (SELECT quantile_cont(salary, 0.98) FROM clean)"""))
def q_trim(spark, sf):
    return R.trim_quantiles(C.clean_postings(spark, sf)).select("post_id", "salary")


@register("filter_city", W(CLEAN, "SELECT post_id, salary FROM clean WHERE city = 'Hanoi'"))
def q_filter_city(spark, sf):
    return R.filter_city(C.clean_postings(spark, sf), "Hanoi").select("post_id", "salary")


@register("city_options", W(CLEAN, "SELECT 'All' AS city, 0 AS grp UNION ALL SELECT DISTINCT city, 1 AS grp FROM clean"))
def q_city_options(spark, sf):
    return R.city_options(C.clean_postings(spark, sf))


@register("fill_zero", W(POSTING, "SELECT post_id, coalesce(salary_min, 0) AS salary_min, coalesce(salary_max, 0) AS salary_max FROM posting"))
def q_fill_zero(spark, sf):
    return R.fill_zero(C.postings(spark, sf).select("post_id", "salary_min", "salary_max"), ["salary_min", "salary_max"])


@register("drop_helper_columns", W(CLEAN, "SELECT post_id, level FROM clean"))
def q_drop_helper(spark, sf):
    c = C.clean_postings(spark, sf).withColumn("_tmp", F.lit(1))
    return c.drop("_tmp").select("post_id", "level")
