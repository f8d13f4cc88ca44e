"""Queries: remaining inventory entries (lexicon, garbage filter, fuzzy extractor,
page labels, flag aliases, feature preparation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import skills as K
from ..functions import text as T
from ..functions.constants import SKILL_COMBOS, SKILL_VARIATIONS, VALID_IT_SKILLS
from ..operators import enrich as E
from ..operators import ml as M
from ..operators import relational as R
from ..session import materialise
from ..sources import feeds as FD
from . import clean as C
from . import oracle as O
from .catalog import register
from .q_core import DESCRIPTIONS, FUZZY_TARGETS, enriched, ratio_sql

W = O.with_ctes
POSTING = O.posting_ctes()
CLEAN = O.clean_ctes()
ENRICHED = O.enriched_ctes()


# ---------------------------------------------------------------- lexicon
def _lex_values_sql():
    rows = []
    for s, cat, w, aliases in K.lexicon_entries():
        rows.append(f"({O.q(s)}, {O.q(cat)}, CAST({w!r} AS DOUBLE), {len(aliases)})")
    return "lex(skill, category, weight, n_aliases) AS (VALUES " + ", ".join(rows) + ")"


@register("skill_lexicon", W(POSTING + ",\n" + _lex_values_sql() + f""",
dem AS (SELECT skill, count(*) AS demand FROM (SELECT unnest({O.skills_sql('description')}) AS skill FROM posting)
        GROUP BY skill)""", """SELECT l.skill, l.category, l.weight, l.n_aliases, coalesce(d.demand, 0) AS demand
    FROM lex l LEFT JOIN dem d ON l.skill = d.skill"""))
def q_skill_lexicon(spark, sf):
    """The lexicon dimension with each skill's demand over all postings."""
    rows = [(s, c, w, len(a)) for s, c, w, a in K.lexicon_entries()]
    lex = spark.createDataFrame(rows, "skill string, category string, weight double, n_aliases int")
    dem = C.postings(spark, sf).select(F.explode(K.skill_extract(F.col("description"))).alias("skill")) \
        .groupBy("skill").agg(F.count(F.lit(1)).alias("demand"))
    return lex.join(dem, "skill", "left").na.fill(0, ["demand"]) \
        .select("skill", "category", "weight", "n_aliases", "demand")


def _alias_values_sql():
    pairs = [(a, s) for a, s in K.alias_map().items() if a != s]
    return "al(alias, skill) AS (VALUES " + ", ".join(f"({O.q(a)}, {O.q(s)})" for a, s in pairs) + ")"


@register("skill_alias_resolve", W(POSTING + ",\n" + _alias_values_sql(), f"""
SELECT al.alias, al.skill, count(p.post_id) AS postings
FROM al LEFT JOIN posting p ON instr({O.norm_sql('p.description')}, al.alias) > 0 GROUP BY al.alias, al.skill"""))
def q_alias_resolve(spark, sf):
    """Resolved alias -> skill (later declarations win) with the postings each alias fires in."""
    pairs = [(a, s) for a, s in K.alias_map().items() if a != s]
    al = spark.createDataFrame(pairs, "alias string, skill string")
    norm = T.normalise_for_skills(F.col("description"))
    found = K.patterns_found(norm, [a for a, _ in pairs])
    fired = C.postings(spark, sf).select(F.explode(found).alias("alias")) \
        .groupBy("alias").agg(F.count(F.lit(1)).alias("postings"))
    return al.join(fired, "alias", "left").na.fill(0, ["postings"]).select("alias", "skill", "postings")


# ---------------------------------------------------------------- garbage filter
GARBAGE_WORDS = ["r", "illustrator", "photoshop", "design"]


def has_garbage(skills, whitelist=VALID_IT_SKILLS):
    wl = F.array(*[F.lit(s) for s in dict.fromkeys(whitelist)])
    return F.exists(skills, lambda s: ((F.length(s) <= 2) & ~F.array_contains(wl, s)) | s.isin(GARBAGE_WORDS))


@register("filter_garbage", W(POSTING, f"""SELECT post_id FROM posting WHERE NOT len(list_filter({O.skills_sql('description')},
    lambda s: (length(s) <= 2 AND NOT list_contains({O.str_list(list(dict.fromkeys(VALID_IT_SKILLS)))}, s))
              OR s IN ('r', 'illustrator', 'photoshop', 'design'))) > 0"""))
def q_filter_garbage(spark, sf):
    """Rows whose (unfiltered) skill list has a short non-whitelisted token or a
    design word are dropped; after the whitelist it can never fire, so the check
    runs on the full extraction."""
    p = C.postings(spark, sf).select("post_id", K.skill_extract(F.col("description")).alias("sk"))
    return p.where(~has_garbage(F.col("sk"))).select("post_id")


# ---------------------------------------------------------------- fuzzy extractor
_ALL_NAMES = [e[0] for e in K.lexicon_entries()]
_STANDARD = dict(SKILL_VARIATIONS)


@register("skill_extract_fuzzy", W(POSTING + f""",
{DESCRIPTIONS},
tt AS (SELECT d, regexp_replace(regexp_replace(lower(d), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g') AS t FROM dd WHERE d <> ''),
{O.names_table("nm", _ALL_NAMES)}, {O.names_table("va", _STANDARD)},
std(v, name) AS (VALUES {", ".join(f"({O.q(v)}, {O.q(n)})" for v, n in _STANDARD.items())}),
tg(t) AS (VALUES {", ".join(f"('{t}')" for t in FUZZY_TARGETS)}),
ws AS (SELECT d, w FROM (SELECT d, unnest(string_split(t, ' ')) AS w FROM tt) WHERE w <> ''),
{ratio_sql("ws")},
found AS (SELECT d, name FROM tt, nm WHERE regexp_matches(t, pat)
          UNION SELECT d, std.name FROM tt, va JOIN std ON std.v = va.name WHERE regexp_matches(t, pat)
          UNION SELECT d, name FROM tt, nm WHERE contains(name, ' ') AND contains(t, name)
          UNION SELECT d, ratio.t FROM ws JOIN ratio USING (w) WHERE s >= 0.8),
hit AS (SELECT d, array_to_string(list_sort(list(name)), ',') AS skills FROM found GROUP BY d)""",
    "SELECT post_id, coalesce(skills, '') AS skills FROM posting LEFT JOIN hit ON description = d").replace("WITH ", "WITH RECURSIVE ", 1))
def q_skill_fuzzy(spark, sf):
    """Names as words, spelling variations, names of several words, near-miss spellings of the key skills."""
    skills = K.skill_extract_advanced(F.col("description"), _ALL_NAMES, FUZZY_TARGETS)
    return C.postings(spark, sf).select("post_id", F.array_join(skills, ",").alias("skills"))


# ---------------------------------------------------------------- flag aliases (line-by-line inventory)
register("company_size_band", W(ENRICHED, "SELECT post_id, company_size_category FROM enriched"))(
    lambda spark, sf: enriched(spark, sf).select("post_id", "company_size_category"))
register("big_company_flag", W(ENRICHED, "SELECT post_id, is_big_company FROM enriched"))(
    lambda spark, sf: enriched(spark, sf).select("post_id", "is_big_company"))
register("big_city_flag", W(ENRICHED, "SELECT post_id, is_big_city FROM enriched"))(
    lambda spark, sf: E.add_city_premium(C.clean_postings(spark, sf)).select("post_id", "is_big_city"))
register("high_value_count", W(ENRICHED, "SELECT post_id, num_high_value_skills FROM enriched"))(
    lambda spark, sf: E.add_skill_combinations(C.clean_postings(spark, sf)).select("post_id", "num_high_value_skills"))


@register("sink_layers", W(ENRICHED, "SELECT post_id, company_size, city_multiplier, combo_fullstack_data FROM enriched"))
def q_sink_layers(spark, sf):
    path = FD.scratch_path(spark, "enriched-layer")
    FD.sink_layer(enriched(spark, sf), path)
    return FD.scan_layer(spark, path).select("post_id", "company_size", "city_multiplier", "combo_fullstack_data")


# ---------------------------------------------------------------- feature preparation
def _features_df(spark, sf):
    return M.with_skill_flags(enriched(spark, sf))


def _feature_list(spark, sf):
    return M.feature_columns(_features_df(spark, sf))


def _feature_sql(c: str) -> str:
    return f"CAST(list_contains(skills, {O.q(c[6:])}) AS INTEGER)" if c.startswith("skill_") else c


_FLAGS = [f"skill_{v}" for v in dict.fromkeys(VALID_IT_SKILLS)]
_FEATURES = [*M.BASE_FEATURES, *_FLAGS, *[f"combo_{n}" for n, _ in SKILL_COMBOS], *M.INTERACTIONS]


@register("feature_columns", W(ENRICHED, " UNION ALL ".join(
    f"SELECT {i} AS position, {O.q(c)} AS feature, round(avg({_feature_sql(c)}), 6) AS mean FROM enriched" for i, c in enumerate(_FEATURES))))
def q_feature_columns(spark, sf):
    """The model's feature list (base, flags, combos, interactions that exist) with means."""
    d = _features_df(spark, sf)
    feats = M.feature_columns(d)
    row = d.agg(*[F.avg(M.q(c)).alias(str(i)) for i, c in enumerate(feats)]).first()
    return spark.createDataFrame([(i, c, float(row[str(i)])) for i, c in enumerate(feats)], "position int, feature string, mean double") \
        .withColumn("mean", F.round("mean", 6))


@register("prepare_training", W(CLEAN, """
, tr AS (SELECT post_id, salary FROM clean WHERE salary >= (SELECT quantile_cont(salary, 0.02) FROM clean)
           AND salary <= (SELECT quantile_cont(salary, 0.98) FROM clean))
SELECT post_id, round(ln(1 + salary), 6) AS label,
       CAST(row_number() OVER (ORDER BY md5(CAST(post_id AS VARCHAR) || ':42'), post_id)
            <= ceil((SELECT count(*) FROM tr) * 0.2) AS INTEGER) AS is_test FROM tr""".replace("\n, tr", ",\ntr", 1)))
def q_prepare_training(spark, sf):
    """Quantile trim (p2..p98), log1p target and the exact 80/20 split."""
    d = materialise(R.trim_quantiles(C.clean_postings(spark, sf).select("post_id", "salary"), "salary", 0.02, 0.98).select(
        "post_id", F.round(F.log1p("salary"), 6).alias("label")))
    return M.split_flags(d)


_ALT = [c for c in M.ALT_FEATURES if c in [*_FEATURES, "salary_per_skill", "num_high_value_skills"]]


def _scaled_sql(c: str) -> str:
    z = f"(f_{_ALT.index(c)} - avg(f_{_ALT.index(c)}) OVER ()) / stddev_pop(f_{_ALT.index(c)}) OVER ()"
    return f'round(CASE WHEN stddev_pop(f_{_ALT.index(c)}) OVER () = 0 THEN 0 ELSE {z} END, 6) AS "{c}"'


@register("prepare_features_alt", W(ENRICHED + f""",
tr AS (SELECT post_id, {", ".join(f"CAST({_feature_sql(c)} AS DOUBLE) AS f_{i}" for i, c in enumerate(_ALT))} FROM enriched
       WHERE salary >= (SELECT quantile_cont(salary, 0.01) FROM enriched) AND salary <= (SELECT quantile_cont(salary, 0.98) FROM enriched))""",
    f"SELECT post_id, {', '.join(_scaled_sql(c) for c in _ALT)} FROM tr"))
def q_prepare_alt(spark, sf):
    """p1..p98 trim, the fixed 33-name feature list (existing ones), scaled on all rows."""
    d = _features_df(spark, sf)
    feats = [c for c in M.ALT_FEATURES if c in d.columns]
    d = R.trim_quantiles(d.na.fill(0, subset=feats), "salary", 0.01, 0.98)
    scaled, _ = M.standardise(d, [], feats)
    return scaled.select("post_id", *[F.round(M.q(c), 6).alias(c) for c in feats])


_GROUP = "CAST(CASE WHEN exp_years < 2 THEN 0 WHEN exp_years < 4 THEN 1 ELSE 2 END * 10 + CASE WHEN salary < 15 THEN 0 WHEN salary < 30 THEN 1 ELSE 2 END AS INTEGER)"
register("cluster_name", W(ENRICHED, f"""SELECT cluster, CASE WHEN e < 2 AND s < 15 THEN 'Entry/Junior Level'
    WHEN e >= 4 AND s >= 30 THEN 'Senior/Expert & High Paid' WHEN e >= 2 AND e < 4 THEN 'Mid-level Professional'
    ELSE 'Specialized/Other' END AS name FROM (SELECT {_GROUP} AS cluster, avg(exp_years) AS e,
    avg(salary) AS s FROM enriched GROUP BY 1)"""))(
    lambda spark, sf: enriched(spark, sf).groupBy(F.expr(_GROUP).alias("cluster")).agg(
        F.avg("exp_years").alias("e"), F.avg("salary").alias("s")).select(
        "cluster", M.cluster_name(F.col("e"), F.col("s")).alias("name")))
