"""Queries: feature preparation, models, evaluation, scoring and clustering."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.constants import BIG_CITIES, CITY_MULTIPLIER_DEFAULT, CITY_MULTIPLIERS, SERVING_HIGH_VALUE, SKILL_COMBOS, VALID_IT_SKILLS
from ..operators import boosting as B
from ..operators import enrich as E
from ..operators import ml as M
from ..operators.sampling import balance_all
from ..session import fingerprint, layer, materialise
from ..sources.feeds import scratch_path
from . import clean as C
from . import oracle as O
from .catalog import register
from .q_rules import q_recommend_from_rules

CLEAN = O.clean_ctes()
ENRICHED = O.enriched_ctes()
W = O.with_ctes


def balanced_layer(spark, sf):
    """enriched -> balanced -> repaired skills -> adjusted salaries (the training table).

    300 rows a salary bracket whatever the input: one file, so that a step of a fit is one task."""
    return layer(spark, "balanced", C.inputs(sf), lambda: E.salary_outlier_adjust(
        E.skill_repair_high_pay(balance_all(C.enriched_layer(spark, sf)))).coalesce(1))


def prepared(spark, sf):
    """The split, scaled training table.  Few rows (300 a salary bracket): one
    partition, so a boosting round isn't all task overhead."""
    p = M.prepare_training(M.with_skill_flags(balanced_layer(spark, sf)))
    return M.Prepared(p.train.coalesce(1), p.test.coalesce(1), p.features, p.scaler)


#: fits are shared by the queries of one application, per state of the input files
_FITS: dict = {}


def fitted(spark, sf, only=None):
    """(metrics, models, prepared) of the named models, or of all; each is fitted once."""
    key = (spark.sparkContext.applicationId, fingerprint(spark, C.inputs(sf)))
    for old in [k for k in _FITS if k[0] != key[0]]:  # another application's models are gone
        del _FITS[old]
    if key not in _FITS:
        _FITS[key] = (prepared(spark, sf), [], {})
    data, rows, models = _FITS[key]
    todo = [n for n, _ in M.model_specs() if n not in models and (only is None or n in only)]
    if todo:
        metrics, found = M.train_models(data, only=todo)
        rows.extend(tuple(r) for r in metrics.collect())  # one row a model
        models.update(found)
    names = only or [n for n, _ in M.model_specs()]
    return spark.createDataFrame([r for r in sorted(rows, key=lambda r: r[1]) if r[0] in names], M.METRICS_DDL), models, data


# ------------------------------------------------------------ value-checked parts
@register("train_test_split", W(CLEAN, """SELECT post_id,
    CAST(row_number() OVER (ORDER BY md5(CAST(post_id AS VARCHAR) || ':42'), post_id)
         <= ceil((SELECT count(*) FROM clean) * 0.2) AS INTEGER) AS is_test FROM clean"""))
def q_split(spark, sf):
    return M.split_flags(C.clean_postings(spark, sf).select("post_id"))


_STD = ", ".join(f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0 ELSE ({c} - avg({c}) OVER ()) / "
                 f"stddev_pop({c}) OVER () END, 6) AS {c}" for c in M.CLUSTER_FEATURES)


@register("standardise", W(ENRICHED, f"SELECT post_id, {_STD} FROM enriched"))
def q_standardise(spark, sf):
    d = C.enriched_layer(spark, sf).select("post_id", *M.CLUSTER_FEATURES)
    s, _ = M.standardise(d, [], M.CLUSTER_FEATURES)
    return s.select("post_id", *[F.round(c, 6).alias(c) for c in M.CLUSTER_FEATURES])


PRED_SQL = "salary * (1 + (CAST(post_id % 7 AS DOUBLE) - 3) / 100.0)"


def predictions(spark, sf):
    c = C.clean_postings(spark, sf)
    return c.select("post_id", "exp_years", "num_skills", F.col("salary").alias("label"),
                    (F.col("salary") * (1 + ((F.col("post_id") % 7).cast("double") - 3) / 100.0)).alias("prediction"))


_METRICS_SQL = """round(avg(abs(y - p)), 2) AS mae, round(sqrt(avg((y - p) * (y - p))), 2) AS rmse,
    round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(salary) FROM clean)) * (y - (SELECT avg(salary) FROM clean))), 4) AS r2,
    round(avg(abs((y - p) / (y + 0.01))) * 100, 1) AS mape"""


@register("eval_regression", W(CLEAN, f"SELECT {_METRICS_SQL} FROM (SELECT salary AS y, {PRED_SQL} AS p FROM clean)"))
def q_eval(spark, sf):
    return M.regression_metrics(predictions(spark, sf), log_scale=False)


_PSEUDO = [("m7", 7), ("m11", 11), ("m13", 13)]


@register("select_best_model", W(CLEAN, "SELECT model, ord, mae, rmse, r2, mape FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, {i} AS ord, {_METRICS_SQL} FROM (SELECT salary AS y, "
    f"salary * (1 + (CAST(post_id % {m} AS DOUBLE) - {m // 2}) / 100.0) AS p FROM clean)"
    for i, (name, m) in enumerate(_PSEUDO)) + ") ORDER BY r2 DESC, ord LIMIT 1"))
def q_select_best(spark, sf):
    c = C.clean_postings(spark, sf)
    parts = []
    for i, (name, m) in enumerate(_PSEUDO):
        p = c.select(F.col("salary").alias("label"),
                     (F.col("salary") * (1 + ((F.col("post_id") % m).cast("double") - m // 2) / 100.0)).alias("prediction"))
        parts.append(M.regression_metrics(p, log_scale=False).select(F.lit(name).alias("model"), F.lit(i).alias("ord"), "*"))
    met = parts[0]
    for p in parts[1:]:
        met = met.unionByName(p)
    return M.select_best(met)


@register("minmax_scale", W(CLEAN, """SELECT post_id, round((salary - min(salary) OVER ()) /
    (max(salary) OVER () - min(salary) OVER ()), 6) AS salary_scaled FROM clean"""))
def q_minmax(spark, sf):
    return M.minmax_scale(C.clean_postings(spark, sf), "salary").select(
        "post_id", F.round("salary_scaled", 6).alias("salary_scaled"))


#: every feature column of the enriched table, in the order of ``operators.ml.feature_columns``
_SKILL_FLAGS = list(dict.fromkeys(VALID_IT_SKILLS))
_FEATS_SQL = ([(c, c) for c in M.BASE_FEATURES] + [("skill_" + s, f"CAST(list_contains(skills, {O.q(s)}) AS INTEGER)") for s in _SKILL_FLAGS]
              + [("combo_" + n, "combo_" + n) for n, _ in SKILL_COMBOS] + [(c, c) for c in M.INTERACTIONS])


def _kbest_sql(k):
    """One long table of (feature, value, salary), read once for the correlations and once for the joint histograms."""
    pairs = ", ".join(f"{{'f': {O.q(n)}, 'x': CAST(coalesce({e}, 0) AS DOUBLE)}}" for n, e in _FEATS_SQL)
    cut = lambda c, lo, hi: f"CASE WHEN {hi} = {lo} THEN 0 ELSE least(floor(({c} - {lo}) / (({hi} - {lo}) / 16)), 15) END"
    return W(ENRICHED, f""",
long AS MATERIALIZED (SELECT p.f AS feature, p.x AS x, salary AS y FROM (SELECT salary, unnest([{pairs}]) AS p FROM enriched)),
st AS (SELECT feature, corr(x, y) AS r, count(*) AS n, min(x) AS lo, max(x) AS hi, min(y) AS ylo, max(y) AS yhi FROM long GROUP BY feature),
fs AS (SELECT feature, CASE WHEN r IS NULL OR isnan(r) THEN 0 ELSE r * r / (1 - r * r) * (n - 2) END AS f FROM st),
jt AS (SELECT feature, {cut("x", "lo", "hi")} AS bx, {cut("y", "ylo", "yhi")} AS b, CAST(count(*) AS DOUBLE) AS n FROM long JOIN st s USING (feature) GROUP BY 1, 2, 3),
ms AS (SELECT feature, sum(n / t * ln((n / t) / ((nx / t) * (ny / t)))) AS mi FROM (
    SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bx) AS nx, sum(n) OVER (PARTITION BY feature, b) AS ny FROM jt)
    GROUP BY feature),
sc AS (SELECT feature, f, mi, 0.6 * (mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER ())
              + 0.4 * (f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()) AS score FROM fs JOIN ms USING (feature))
SELECT feature, round(f, 4) AS f_score, round(mi, 6) AS mi, round(score, 6) AS score FROM sc
ORDER BY round(score, 9) DESC, feature LIMIT {k}""")


@register("select_k_best", _kbest_sql(30))
def q_kbest(spark, sf):
    d = M.with_skill_flags(C.enriched_layer(spark, sf))
    return M.select_k_best(d, M.feature_columns(d), 30).select("feature", F.round("f_score", 4).alias("f_score"), F.round("mi", 6).alias("mi"),
                                                               F.round("score", 6).alias("score"))


_PROF = ", ".join(f"round(avg({c}), 6) AS {c}" for c in M.CLUSTER_FEATURES)


@register("cluster_profiles", W(ENRICHED, f"""
, lab AS (SELECT *, CAST(post_id % 4 AS INTEGER) AS cluster FROM enriched),
prof AS (SELECT cluster, {_PROF}, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM lab), 6) AS percentage
         FROM lab GROUP BY cluster)
SELECT *, CASE WHEN exp_years < 2 AND salary < 15 THEN 'Entry/Junior Level'
               WHEN exp_years >= 4 AND salary >= 30 THEN 'Senior/Expert & High Paid'
               WHEN exp_years >= 2 AND exp_years < 4 THEN 'Mid-level Professional' ELSE 'Specialized/Other' END AS name
FROM prof""".replace("\n, lab", ",\nlab", 1)))
def q_cluster_profiles(spark, sf):
    d = C.enriched_layer(spark, sf).withColumn("cluster", (F.col("post_id") % 4).cast("int"))
    p = M.cluster_profiles(d, M.CLUSTER_FEATURES)
    return p.select("cluster", *[F.round(c, 6).alias(c) for c in M.CLUSTER_FEATURES], "count",
                    F.round("percentage", 6).alias("percentage"),
                    M.cluster_name(F.col("exp_years"), F.col("salary")).alias("name"))


_HV_SQL = f"list_filter({O.str_list(SERVING_HIGH_VALUE)}, lambda s: list_contains(skills, s))"
_FACTORS_SQL = f"""concat_ws('; ', CASE WHEN exp_years >= 5 THEN 'Senior level experience (+30-40%)' WHEN exp_years >= 3 THEN 'Mid-level experience (+15-25%)' END,
    CASE WHEN len(skills) >= 5 THEN 'Broad skill set (+10-15%)' END,
    CASE WHEN len({_HV_SQL}) > 0 THEN 'High-value skills: ' || array_to_string(({_HV_SQL})[1:3], ', ') || ' (+20-30%)' END,
    CASE WHEN english = 1 THEN 'English proficiency (+10-15%)' END, CASE WHEN city IN ({", ".join(O.q(c) for c in BIG_CITIES)}) THEN 'Major city premium (+10-15%)' END)"""


ASKED = ("post_id", "experience_years", "skills", "asks_english", "city")


def answers(pred):
    """The dashboard's answers to requests (``ASKED``) with a prediction ``p``: capped, with band and key factors."""
    cols = M.predict_caps(F.col("p"), F.col("experience_years"), F.size("skills"))
    factors = M.factor_messages(F.col("experience_years"), F.col("skills"), F.col("asks_english"), F.col("city"))
    return pred.select("post_id", *cols, F.array_join(factors, "; ").alias("factors")).select(
        "post_id", *[F.round(c, 6).alias(c) for c in ("capped", "band_lower", "band_upper")], "factors")


@register("predict_caps_rules", W(CLEAN, f"""SELECT post_id, round(c, 6) AS capped, round(c - 4.89, 6) AS band_lower,
    round(c + 4.89, 6) AS band_upper, factors FROM (SELECT post_id, {_FACTORS_SQL} AS factors, CASE WHEN exp_years < 1 AND num_skills <= 2
    THEN least({PRED_SQL}, 12.0) ELSE {PRED_SQL} END AS c FROM clean)"""))
def q_predict_caps_rules(spark, sf):
    """What ``predict_caps`` does with a prediction, on predictions that SQL can give."""
    given = (F.col("salary") * (1 + ((F.col("post_id") % 7).cast("double") - 3) / 100.0)).alias("p")
    return answers(C.clean_postings(spark, sf).select(
        "post_id", F.col("exp_years").alias("experience_years"), "skills", (F.col("english") == 1).alias("asks_english"), "city", given))


@register("predict_caps")
def q_predict_caps(spark, sf):
    """Every clean posting as a request of the dashboard: its features, scaled and scored by the
    dashboard's model (XGBoost, whose error its band is), capped, with band and key factors."""
    _metrics, models, data = fitted(spark, sf, ["XGBoost"])
    features = M.with_skill_flags(M.request_features(requests(spark, sf).withColumn("asks_english", F.col("english"))))
    return answers(materialise(M.Scorer(models["XGBoost"], data.features, data.scaler).score(features, keep=ASKED)))


def requests(spark, sf):
    c = C.clean_postings(spark, sf)
    return c.select("post_id", F.col("exp_years").alias("experience_years"), "skills",
                    (F.col("remote") == 1).alias("remote"), (F.col("english") == 1).alias("english"), "city")


@register("predict_features", W(CLEAN, f"""SELECT post_id, exp_years, num_skills,
    CAST(city IN ('Ho Chi Minh City', 'Hanoi') AS INTEGER) AS is_big_city,
    CAST(CASE {" ".join(f"WHEN city = '{c}' THEN {m}" for c, m in CITY_MULTIPLIERS)} ELSE {CITY_MULTIPLIER_DEFAULT} END AS DOUBLE)
      AS city_multiplier,
    round(exp_years * exp_years, 6) AS exp_squared, round(exp_years * num_skills, 6) AS exp_skill_interaction,
    CAST(len(list_filter(skills, lambda s: s IN ('python', 'aws', 'docker', 'kubernetes', 'devops'))) AS INTEGER)
      AS num_high_value_skills,
    CAST(remote = 1 AND english = 1 AS INTEGER) AS remote_english FROM clean"""))
def q_predict_features(spark, sf):
    f = M.request_features(requests(spark, sf))
    return f.select("post_id", "exp_years", "num_skills", "is_big_city", "city_multiplier",
                    F.round("exp_squared", 6).alias("exp_squared"),
                    F.round("exp_skill_interaction", 6).alias("exp_skill_interaction"),
                    "num_high_value_skills", "remote_english")


# ------------------------------------------------------------ first trees and lines, value-checked
TREE_FEATURES = ["exp_years", "num_skills", "remote", "english", "city_multiplier", "is_big_company"]
NEWTON = B.Spec(rounds=1, depth=3, rate=0.05)
LEAF_WISE = B.Spec(rounds=1, depth=10, rate=0.05, leaves=7, l2=0.0, min_hessian=1e-3, min_rows=20, bins=255)


def first_tree(spark, sf, spec):
    """Splits of the first tree for log1p(salary) over all enriched postings: node
    (1, then 2n and 2n + 1), step (order of the splits, from 1) and what each split is."""
    d = C.enriched_layer(spark, sf).where("salary is not null")
    x = F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("double") for c in TREE_FEATURES])
    nodes = B.fit(d.select(x.alias("features"), F.log1p("salary").alias("label")), spec).trees[0]
    path = {0: 1}
    for i in range(len(nodes.feature)):  # children come after their parent
        if nodes.feature[i] >= 0:
            path |= {int(nodes.left[i]): 2 * path[i], int(nodes.right[i]): 2 * path[i] + 1}
    rows = [(path[i], s + 1, TREE_FEATURES[nodes.feature[i]], float(nodes.cut[i]), round(float(nodes.gain[i]), 6),
             round(float(nodes.value[nodes.left[i]]), 6), round(float(nodes.value[nodes.right[i]]), 6)) for s, i in enumerate(nodes.order)]
    return spark.createDataFrame(rows, "node int, step int, feature string, cut double, gain double, left_value double, right_value double")


def _tree_sql(spec, steps, leaf_wise):
    """A chain of steps: unpivot, running sums a (node, feature), best split, rows go on to its sides."""
    names, x = [f"'{f}'" for f in TREE_FEATURES], [f"x{i}" for i in range(len(TREE_FEATURES))]
    cols = ", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {c}" for f, c in zip(TREE_FEATURES, x))
    pairs = ", ".join("{'f': %d, 'v': %s}" % (i, c) for i, c in enumerate(x))
    score = lambda g, h: f"{g} * {g} / ({h} + {spec.l2})"
    least = max(spec.min_rows, spec.min_hessian, 1)
    out = f"""
, lab AS (SELECT {cols}, ln(1 + salary) AS y FROM enriched WHERE salary IS NOT NULL),
r0 AS (SELECT *, (SELECT avg(y) FROM lab) - y AS g, CAST(1 AS BIGINT) AS node FROM lab)"""
    for k in range(steps):
        best = "ORDER BY round(gain, 9) DESC, node, f, v" if leaf_wise else "PARTITION BY node ORDER BY round(gain, 9) DESC, f, v"
        out += f""",
u{k} AS (SELECT node, p.f AS f, p.v AS v, sum(g) AS g, count(*) AS n FROM (SELECT node, g, unnest([{pairs}]) AS p FROM r{k}) GROUP BY ALL),
c{k} AS (SELECT node, f, v, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER t AS gt, sum(n) OVER t AS nt FROM u{k}
        WINDOW w AS (PARTITION BY node, f ORDER BY v), t AS (PARTITION BY node, f)),
b{k} AS (SELECT *, 0.5 * ({score("gl", "nl")} + {score("(gt - gl)", "(nt - nl)")} - {score("gt", "nt")}) AS gain
        FROM c{k} WHERE least(nl, nt - nl) >= {least} AND 0.5 * ({score("gl", "nl")} + {score("(gt - gl)", "(nt - nl)")} - {score("gt", "nt")}) > 1e-12
        QUALIFY row_number() OVER ({best}) = 1),
r{k + 1} AS (SELECT {", ".join(x)}, g, CASE WHEN b.node IS NULL THEN r.node
               ELSE 2 * r.node + CAST(CASE f {" ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(x))} END > v AS INTEGER) END AS node
        FROM (SELECT {", ".join(x)}, g, node FROM r{k}) r {"LEFT" if leaf_wise else ""} JOIN b{k} b ON r.node = b.node)"""
    number = "k" if leaf_wise else "row_number() OVER (ORDER BY node)"
    return W(ENRICHED, (out + f"""
SELECT CAST(node AS INTEGER) AS node, CAST({number} AS INTEGER) AS step, [{", ".join(names)}][f + 1] AS feature, v AS cut, round(gain, 6) AS gain,
       round(-{spec.rate} * gl / (nl + {spec.l2}), 6) AS left_value, round(-{spec.rate} * (gt - gl) / (nt - nl + {spec.l2}), 6) AS right_value
FROM ({" UNION ALL ".join(f"SELECT {k + 1} AS k, * FROM b{k}" for k in range(steps))})""").replace("\n, lab", ",\nlab", 1))


@register("train_gbt_xgb_first_tree", _tree_sql(NEWTON, NEWTON.depth, False))
def q_newton_tree(spark, sf):
    return first_tree(spark, sf, NEWTON)


@register("train_gbt_lgbm_first_tree", _tree_sql(LEAF_WISE, LEAF_WISE.leaves - 1, True))
def q_leafwise_tree(spark, sf):
    return first_tree(spark, sf, LEAF_WISE)


@register("train_linear_one_feature", W(ENRICHED, """SELECT round(regr_slope(ln(1 + salary), exp_years), 6) AS slope,
    round(regr_intercept(ln(1 + salary), exp_years), 6) AS intercept FROM enriched"""))
def q_linear_one(spark, sf):
    """The linear model on one feature is the regression line."""
    d = C.enriched_layer(spark, sf).select("exp_years", F.log1p("salary").alias("label"))
    model = LinearRegression(featuresCol="features", labelCol="label").fit(VectorAssembler(inputCols=["exp_years"], outputCol="features").transform(d))
    return spark.createDataFrame([(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))], "slope double, intercept double")


# ------------------------------------------------------------ rows-only (models)
@register("train_all")
def q_train_all(spark, sf):
    metrics, _models, _f = fitted(spark, sf)
    return metrics


def _one_model(name):
    return lambda spark, sf: fitted(spark, sf, [name])[0]


for _key, _name in (("train_linear", "Linear Regression"), ("train_forest", "Random Forest"), ("train_gbt_xgb", "XGBoost"),
                    ("train_gbt_lgbm", "LightGBM"), ("train_gbt", "Gradient Boosting")):
    register(_key)(_one_model(_name))


def scorer(spark, sf):
    metrics, models, data = fitted(spark, sf)
    return M.best_scorer(data, metrics, models)


@register("feature_importance_topk")
def q_importance(spark, sf):
    best = scorer(spark, sf)
    return spark.createDataFrame(M.feature_importance(best.model, best.features), "feature string, importance double")


@register("predict_batch")
def q_predict_batch(spark, sf):
    """Every clean posting as a request, scored by the saved best model, with its
    bands, key factors and the skills to learn next (with their salary gain)."""
    path = scratch_path(spark, "scorer")
    scorer(spark, sf).save(path)
    best = M.Scorer.load(spark, path)
    req = requests(spark, sf)
    pred = best.score(M.with_skill_flags(M.request_features(req)))
    factors = M.factor_messages(F.col("experience_years"), F.col("skills"), F.col("english"), F.col("city"))
    recs = (q_recommend_from_rules(spark, sf).where("rank <= 5").groupBy("profile_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "skill", "salary_increase"))).alias("r"))
            .select(F.col("profile_id").alias("post_id"),
                    F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["skill"], x["salary_increase"].cast("string"))), ",")
                    .alias("recommendations")))
    return (pred.join(req.select("post_id", F.array_join(factors, "; ").alias("factors")), "post_id").join(recs, "post_id", "left")
            .select("post_id", *M.prediction_band(F.col("p")), "factors", F.coalesce("recommendations", F.lit("")).alias("recommendations")))


def _kmeans_sql(k=4, restarts=10, seed=42, steps=60):
    """Seeds by weighted hash draws, then Lloyd steps as a recursion over all restarts."""
    zs = ["z0", "z1", "z2", "z3"]
    std = ", ".join(f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {z}"
                    for c, z in zip(M.CLUSTER_FEATURES, zs))
    u = lambda s: f"CAST(('0x' || substr(md5(CAST(post_id AS VARCHAR) || ':' || CAST(r AS VARCHAR) || ':{s}'), 1, 8)) AS BIGINT) / 4294967296.0"
    dist = lambda c: "(" + " + ".join(f"({z} - {c}[{i + 1}]) * ({z} - {c}[{i + 1}])" for i, z in enumerate(zs)) + ")"
    point = f"[{', '.join(zs)}]"
    out = f""",
pts AS MATERIALIZED (SELECT post_id, {", ".join(M.CLUSTER_FEATURES)}, {std} FROM enriched),
rs AS (SELECT unnest(range({seed}, {seed + restarts})) AS r),
s0 AS MATERIALIZED (SELECT r, [arg_min({point}, {{'u': u, 'i': post_id}})] AS cs FROM (SELECT *, {u(0)} AS u FROM pts, rs) GROUP BY r)"""
    for s in range(1, k):
        out += f""",
s{s} AS MATERIALIZED (SELECT r, list_append(any_value(cs), arg_min({point}, {{'u': -ln(1 - u) / d, 'i': post_id}})) AS cs
  FROM (SELECT *, {u(s)} AS u, list_min(list_transform(cs, lambda c: {dist("c")})) AS d FROM pts, s{s - 1}) WHERE d > 0 GROUP BY r)"""
    near = f"list_sort(list_transform(cs, lambda c, i: {{'d': {dist('c')}, 'c': i}}))[1]"
    return W(ENRICHED, out + f""",
st AS (SELECT 0 AS step, r, cs FROM s{k - 1} UNION ALL
  SELECT step + 1, r, list(ctr ORDER BY c) FROM (SELECT step, r, n.c AS c, [{", ".join(f"avg({z})" for z in zs)}] AS ctr
    FROM (SELECT step, r, {", ".join(zs)}, {near} AS n FROM st, pts WHERE step < {steps}) GROUP BY step, r, n.c) GROUP BY step, r),
lab AS (SELECT r, n.c - 1 AS cluster, n.d AS d, {", ".join(M.CLUSTER_FEATURES)} FROM (SELECT *, {near} AS n FROM pts, st WHERE step = {steps})),
best AS (SELECT r FROM lab GROUP BY r ORDER BY round(sum(d), 6), r LIMIT 1)
SELECT CAST(cluster AS INTEGER) AS cluster, {_PROF}, count(*) AS count FROM lab JOIN best USING (r) GROUP BY cluster""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("cluster_market_all", _kmeans_sql())
def q_cluster_all(spark, sf):
    """The clusters of all enriched postings, by size and mean."""
    labelled, feats = M.cluster_market(C.enriched_layer(spark, sf))
    return labelled.groupBy("cluster").agg(*[F.round(F.avg(c), 6).alias(c) for c in feats], F.count(F.lit(1)).alias("count"))


@register("cluster_market")
def q_cluster_market(spark, sf):
    labelled, feats = M.cluster_market(balanced_layer(spark, sf))
    return M.cluster_profiles(labelled, feats).withColumn("name", M.cluster_name(F.col("exp_years"), F.col("salary")))


@register("cluster_scatter")
def q_cluster_scatter(spark, sf):
    labelled, _ = M.cluster_market(balanced_layer(spark, sf))
    return labelled.select("exp_years", "salary", "cluster", "num_skills")
