"""Salary models, evaluation, scaling, feature scores and market clustering.

Feature preparation stays in DataFrame expressions (one projection); Spark
ML does the fitting.  Global statistics (means, population std, quantiles,
correlations) are single aggregate passes; Catalyst merges the scalar
subqueries over the same input into one job.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import BIG_CITIES, SERVING_HIGH_VALUE, VALID_IT_SKILLS
from ..functions.skills import skill_one_hot
from ..session import materialise, path_exists
from . import boosting, clustering
from .enrich import city_multiplier, combo_flags
from .relational import scalar, trim_quantiles
from .sampling import flag_exact_global

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE_FEATURES = ["exp_years", "num_skills", "remote", "english", "is_big_city", "city_multiplier", "is_big_company"]
INTERACTIONS = ["exp_skill_interaction", "exp_high_value", "remote_english", "remote_big_city", "exp_squared"]
# --- FIXED VALUES: the alternative fixed feature list (33 names).
ALT_FEATURES = [
    "exp_years", "exp_squared", "exp_skill_interaction", "exp_high_value",
    "num_skills", "num_high_value_skills", "salary_per_skill",
    "remote", "english", "remote_english", "remote_big_city",
    "is_big_city", "city_multiplier", "is_big_company",
    "skill_python", "skill_java", "skill_javascript", "skill_react",
    "skill_aws", "skill_docker", "skill_kubernetes", "skill_sql",
    "skill_devops", "skill_tensorflow", "skill_pytorch", "skill_git",
    "combo_fullstack_data", "combo_devops_stack", "combo_fullstack_js",
    "combo_java_enterprise", "combo_cloud_native", "combo_ai_stack", "combo_data_stack",
]


def with_skill_flags(df: DataFrame, vocabulary=VALID_IT_SKILLS) -> DataFrame:
    """Add the ``skill_<name>`` 0/1 columns (ML edge only; the array stays canonical)."""
    return df.select("*", *skill_one_hot("skills", list(dict.fromkeys(vocabulary))))


def feature_columns(df: DataFrame) -> list:
    """Base + skill flags + combos + interactions that exist, in that order."""
    cols = BASE_FEATURES + [c for c in df.columns if c.startswith("skill_")] + \
        [c for c in df.columns if c.startswith("combo_")] + INTERACTIONS
    seen, out = set(), []
    for c in cols:
        if c in df.columns and c not in seen:
            seen.add(c)
            out.append(c)
    return out


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def split_flags(df: DataFrame, test_fraction: float = 0.2, id_col: str = "post_id", seed: int = 42) -> DataFrame:
    """All rows with ``is_test``: 1 for exactly ceil(fraction * n) of them, by hash order.

    One flag per row, so rows that repeat an id (a bootstrap does) are all kept
    and every row is in exactly one part."""
    return flag_exact_global(df, fraction=test_fraction, id_col=id_col, seed=seed, flag="is_test")


def exact_split(df: DataFrame, test_fraction: float = 0.2, id_col: str = "post_id", seed: int = 42):
    """(train, test) by ``split_flags``, written once so that both parts come from the same flags."""
    flagged = materialise(split_flags(df, test_fraction, id_col, seed))
    return flagged.where("is_test = 0").drop("is_test"), flagged.where("is_test = 1").drop("is_test")


def fit_scaler(train: DataFrame, cols) -> dict:
    """Means and population stds of ``cols`` in one aggregate pass (2 numbers per
    feature: the fitted model parameters, fetched once)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(q(c)).alias(f"m{i}"), F.stddev_pop(q(c)).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def apply_scaler(df: DataFrame, params: dict) -> DataFrame:
    """(x - mean) / std; a constant column (std 0 or undefined) -> 0."""
    def z(c, m, s):
        if m is None or s is None or s == 0 or (isinstance(s, float) and math.isnan(s)):
            return F.lit(0.0).alias(c)
        return ((q(c) - F.lit(m)) / F.lit(s)).alias(c)
    return df.select(*[q(c) for c in df.columns if c not in params], *[z(c, m, s) for c, (m, s) in params.items()])


def standardise(train: DataFrame, others, cols) -> tuple:
    """Scale ``train`` and ``others`` with statistics from ``train`` only."""
    params = fit_scaler(train, cols)
    return apply_scaler(train, params), [apply_scaler(o, params) for o in others]


@dataclass
class Prepared:
    """Scaled train and test rows (post_id, features, label), and what serving needs."""

    train: DataFrame
    test: DataFrame
    features: list
    scaler: dict


def assemble(df: DataFrame, features: list, scaler: dict, keep) -> DataFrame:
    """Scale with fitted parameters and assemble the feature vector, in the fitted order."""
    scaled = apply_scaler(df.select(*keep, *[q(c) for c in features]).na.fill(0, subset=features), {c: scaler[c] for c in features})
    return VectorAssembler(inputCols=features, outputCol="features").transform(scaled).select(*keep, "features")


def prepare_training(df: DataFrame, lo: float = 0.02, hi: float = 0.98, seed: int = 42) -> Prepared:
    """null -> 0, quantile trim of salary, log1p target, exact 80/20 split, scaling on train."""
    feats = feature_columns(df)
    narrow = df.select("post_id", "salary", *[q(c) for c in feats if c not in ("post_id", "salary")]).na.fill(0, subset=feats)
    train, test = exact_split(trim_quantiles(narrow, "salary", lo, hi).withColumn("label", F.log1p("salary")), 0.2, seed=seed)
    scaler = fit_scaler(train, feats)
    parts = [assemble(d, feats, scaler, ["post_id", "label"]) for d in (train, test)]
    return Prepared(parts[0], parts[1], feats, scaler)


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       log_scale: bool = True) -> DataFrame:
    """MAE, RMSE, R2, MAPE on the original scale (expm1 when fitted on log1p), one pass."""
    y = F.expm1(label) if log_scale else F.col(label)
    p = F.expm1(prediction) if log_scale else F.col(prediction)
    d = pred.select(y.alias("y"), p.alias("p"))
    # one pass; the variance is accumulated around the running mean, so it doesn't cancel
    e = F.col("y") - F.col("p")
    sst = F.var_pop("y") * F.count("y")
    agg = d.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                (1 - F.sum(e * e) / sst).alias("r2"),
                (F.avg(F.abs(e / (F.col("y") + 0.01))) * 100).alias("mape"))
    return agg.select(F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"),
                      F.round("r2", 4).alias("r2"), F.round("mape", 1).alias("mape"))


def select_best(metrics: DataFrame) -> DataFrame:
    """Strict maximum of r2; the earlier model (``ord``) wins ties."""
    return metrics.orderBy(F.desc("r2"), F.asc("ord")).limit(1)


def model_specs(seed: int = 42, rounds: int = 200, trees=(100, 200), depths=(10, 15), folds: int = 5) -> list:
    """(name, estimator or CrossValidator), the reference's configuration by default.

    The forest grid has 16 candidates: trees x depth x minimum leaf size x
    minimum information gain, the last in place of a minimum split size, which
    Spark's trees don't have.  Boosting runs ``rounds`` rounds: depth-wise and
    leaf-wise on second-order histograms (``operators.boosting``), and Spark's own.
    """
    lin = LinearRegression(featuresCol="features", labelCol="label", regParam=0.0, elasticNetParam=0.0)
    # with cached node ids a pass doesn't carry the trees so far (17 s instead of 31 s for 200 trees of depth 15)
    rf = RandomForestRegressor(featuresCol="features", labelCol="label", seed=seed, cacheNodeIds=True, checkpointInterval=-1)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths))
            .addGrid(rf.minInstancesPerNode, [2, 4]).addGrid(rf.minInfoGain, [0.0, 0.001]).build())
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, numFolds=folds, seed=seed, parallelism=8,
                        evaluator=RegressionEvaluator(labelCol="label", metricName="r2"))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=0.05, subsamplingRate=0.8, seed=seed, maxDepth=5)
    return [("Linear Regression", lin), ("Random Forest", cv),
            ("XGBoost", boosting.Spec(rounds, depth=7, rate=0.05, subsample=0.8, columns=0.8, seed=seed)),
            # a share of rows without a bagging frequency samples nothing there, so there is no subsample here
            ("LightGBM", boosting.Spec(rounds, depth=10, rate=0.05, leaves=31, l2=0.0, min_hessian=1e-3, min_rows=20, columns=0.8, bins=255,
                                       importance="split", seed=seed)),
            ("Gradient Boosting", gbt)]


METRICS_DDL = "model string, ord int, mae double, rmse double, r2 double, mape double"


def train_models(prepared: Prepared, seed: int = 42, only=None, **size) -> tuple:
    """Fit the models (all, or those named in ``only``) on one split; (metrics, models by name).

    ``metrics``: model, ord, mae, rmse, r2, mape on the test part, original scale.
    """
    train, test = prepared.train.persist(), prepared.test
    wanted = [(i, name, est) for i, (name, est) in enumerate(model_specs(seed, **size)) if not only or name in only]

    def one(i, name, est):
        model = boosting.fit(train, est) if isinstance(est, boosting.Spec) else est.fit(train)
        model = getattr(model, "bestModel", model)
        m = regression_metrics(model.transform(test)).first()
        return (name, i, float(m["mae"]), float(m["rmse"]), float(m["r2"]), float(m["mape"])), model

    try:
        train.count()
        # side by side: a round on a small table is mostly waiting for its tasks
        with ThreadPoolExecutor(len(wanted) or 1) as pool:
            fits = list(pool.map(lambda w: inheritable_thread_target(test.sparkSession)(one)(*w), wanted))
    finally:
        train.unpersist()
    return (test.sparkSession.createDataFrame([row for row, _ in fits], METRICS_DDL),
            {name: model for (_, name, _), (_, model) in zip(wanted, fits)})


@dataclass
class Scorer:
    """A fitted model with the scaler and the feature list it was fitted with."""

    model: Model | boosting.Boosted
    features: list
    scaler: dict

    def score(self, df: DataFrame, keep=("post_id",)) -> DataFrame:
        """``keep`` columns and the predicted salary ``p`` (original scale); a feature that ``df`` lacks is 0."""
        df = df.select("*", *[F.lit(0).alias(c) for c in self.features if c not in df.columns])
        return self.model.transform(assemble(df, self.features, self.scaler, list(keep))).select(*keep, F.expm1("prediction").alias("p"))

    def save(self, path: str) -> None:
        """Model, scaler and feature list together, under one folder."""
        spark = SparkSession.getActiveSession()
        if isinstance(self.model, boosting.Boosted):
            self.model.save(f"{path}/boosted")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        rows = [(i, c, *self.scaler[c]) for i, c in enumerate(self.features)]
        spark.createDataFrame(rows, "position int, feature string, mean double, std double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(spark, path: str) -> "Scorer | None":
        """None if nothing was saved there; an unreadable folder is an error."""
        if not path_exists(spark, f"{path}/features/_SUCCESS"):
            return None
        rows = spark.read.parquet(f"{path}/features").orderBy("position").collect()  # one row a feature
        boosted = path_exists(spark, f"{path}/boosted/model/_SUCCESS")
        model = boosting.Boosted.load(spark, f"{path}/boosted") if boosted else PipelineModel.load(f"{path}/model").stages[0]
        return Scorer(model, [r["feature"] for r in rows], {r["feature"]: (r["mean"], r["std"]) for r in rows})


def best_scorer(prepared: Prepared, metrics: DataFrame, models: dict) -> Scorer:
    return Scorer(models[select_best(metrics).first()["model"]], prepared.features, prepared.scaler)


def feature_importance(model, feats, k: int = 15):
    """(feature, importance) top k of a tree model (boosted trees by mean gain or by splits); a linear model's are the shares of its absolute coefficients."""
    if isinstance(model, boosting.Boosted):
        imp = model.importances.tolist()
    elif hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray().tolist()
    else:
        w = [abs(x) for x in model.coefficients.toArray().tolist()]
        imp = [x / (sum(w) or 1.0) for x in w]
    return sorted(zip(feats, imp), key=lambda t: (-t[1], t[0]))[:k]


# ------------------------------------------------------------------ scores
def feature_arrays(df: DataFrame, feats, target: str) -> DataFrame:
    """(x, y): all features of a row as one array, for the passes that walk them in numpy.

    Hundreds of aggregates in one pass make a method that the JVM never compiles."""
    x = F.transform(F.array(*[q(c).cast("double") for c in feats]), lambda v: v)  # a higher-order function: evaluated in small pieces
    return df.select(x.alias("x"), F.col(target).cast("double").alias("y"))


def _values(b: pa.RecordBatch, width: int) -> tuple:
    """Rows x features and target of a batch, nulls as NaN, and which targets are null."""
    x, y = b.column(0).flatten(), b.column(1)
    none = y.is_null().to_numpy(zero_copy_only=False)
    return (x.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width), y.to_numpy(zero_copy_only=False).astype(np.float64), none)


def _center(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Means over axis 0 of n values each (the others are NaN), around a first value: exact for a constant."""
    first = np.nan_to_num(v[np.argmax(~np.isnan(v), axis=0), np.arange(v.shape[1])])
    return first + np.nansum(v - first, axis=0) / np.maximum(n, 1)


#: what is kept of each feature: values, mean, sum of squares, least, largest; rows with a target too, both means, sum of products
_STATE = ("n", "mean", "m2", "low", "high", "k", "px", "py", "c")


def _merge_moments(a: dict | None, b: dict) -> dict:
    if a is None:
        return b
    n, k = a["n"] + b["n"], a["k"] + b["k"]
    share, d = b["n"] / np.maximum(n, 1), b["mean"] - a["mean"]
    pair, dx, dy = b["k"] / np.maximum(k, 1), b["px"] - a["px"], b["py"] - a["py"]
    return {"n": n, "mean": a["mean"] + d * share, "m2": a["m2"] + b["m2"] + d * d * a["n"] * share,
            "low": np.fmin(a["low"], b["low"]), "high": np.fmax(a["high"], b["high"]),
            "k": k, "px": a["px"] + dx * pair, "py": a["py"] + dy * pair, "c": a["c"] + b["c"] + dx * dy * a["k"] * pair}


def _moments(width: int, merge: bool):
    """One row a task: the moments of its rows, or of the tasks' rows it gets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if merge:
                for row in b.column(0).to_pylist():
                    total = _merge_moments(total, dict(zip(_STATE, np.array(row).reshape(len(_STATE), -1))))
            elif b.num_rows:
                x, y, none = _values(b, width)
                v = np.column_stack([x, y])  # the target is its own last feature
                known, both = ~np.isnan(v), ~np.isnan(v) & ~none[:, None]
                n, k = known.sum(0).astype(float), both.sum(0).astype(float)
                pv, py = np.where(both, v, np.nan), np.where(both, y[:, None], np.nan)
                mean, px, my = _center(v, n), _center(pv, k), _center(py, k)
                total = _merge_moments(total, {
                    "n": n, "mean": mean, "m2": np.nansum((v - mean) ** 2, axis=0), "low": np.fmin.reduce(v), "high": np.fmax.reduce(v),
                    "k": k, "px": px, "py": my, "c": np.nansum((pv - px) * (py - my), axis=0)})
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total[s] for s in _STATE])], pa.list_(pa.float64()))], ["s"])

    return run


def feature_moments(df: DataFrame, feats, target: str) -> dict | None:
    """Moments of every feature, of the target (last) and of their pairs, in one pass; None without rows."""
    width = len(list(feats))
    parts = feature_arrays(df, feats, target).mapInArrow(_moments(width, False), "s array<double>")
    row = parts.repartition(1).mapInArrow(_moments(width, True), "s array<double>").first()  # nine numbers a feature
    return None if row is None else dict(zip(_STATE, np.array(row[0]).reshape(len(_STATE), -1)))


def f_scores(df: DataFrame, feats, target: str = "salary", moments: dict | None = None) -> DataFrame:
    """Univariate regression F score per feature: r^2 / (1 - r^2) * (n - 2); null for a constant column."""
    n = df.count()
    m = moments or feature_moments(df, feats, target)
    out = []
    for i, c in enumerate(feats):
        r = math.nan
        if m is not None and m["k"][i] and m["m2"][i] > 0 and m["m2"][-1] > 0:
            r = (m["c"][i] / m["k"][i]) / (math.sqrt(m["m2"][i] / m["n"][i]) * math.sqrt(m["m2"][-1] / m["n"][-1]))
        if math.isnan(r):
            out.append((c, None))
        else:
            out.append((c, float((r * r) / (1 - r * r) * (n - 2)) if r * r < 1 else float("inf")))
    return df.sparkSession.createDataFrame(out, "feature string, f_score double")


def _joint(lows: list, highs: list, bins: int):
    """(feature number, bin, target's bin, rows) of the rows of a task."""
    def cut(v, lo, hi):
        if math.isnan(lo) or lo == hi:
            return np.zeros(len(v), np.int64)
        return np.minimum(np.nan_to_num(np.floor((v - lo) / ((hi - lo) / bins))), bins - 1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, total = len(lows) - 1, {}
        for b in batches:
            x, y, none = _values(b, width)
            by = cut(np.where(none, highs[-1], y), lows[-1], highs[-1])  # a missing target goes to the last bin
            for i in range(width if len(y) else 0):
                key = cut(x[:, i], lows[i], highs[i]) * bins + by
                counts = np.bincount(key - key.min())
                for at in np.flatnonzero(counts).tolist():
                    pair = (i, *divmod(at + int(key.min()), bins))
                    total[pair] = total.get(pair, 0) + int(counts[at])
        if total:
            cols = [*zip(*total), tuple(total.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["i", "bx", "by", "n"])

    return run


def mutual_information(df: DataFrame, feats, target: str = "salary", bins: int = 16, moments: dict | None = None) -> DataFrame:
    """Mutual information (nats) of each feature with the target, both cut into
    ``bins`` equal-width bins over their ranges.

    One pass for the ranges, one for all joint histograms (at most bins^2 rows
    a feature and task); marginals are windows over those rows."""
    cols = list(feats)
    m = moments or feature_moments(df, cols, target)
    low, high = ([math.nan] * (len(cols) + 1),) * 2 if m is None else (m["low"].tolist(), m["high"].tolist())
    joint = (feature_arrays(df.na.fill(0, subset=cols), cols, target).mapInArrow(_joint(low, high, bins), "i long, bx long, by long, n long")
             .groupBy("i", "bx", "by").agg(F.sum("n").alias("n")))
    joint = joint.withColumn("feature", F.array(*[F.lit(c) for c in cols])[F.col("i").cast("int")])
    of = lambda *k: F.sum("n").over(Window.partitionBy("feature", *k))
    terms = joint.select("feature", (F.col("n") / of()).alias("pxy"), (of("bx") / of()).alias("px"), (of("by") / of()).alias("py"))
    return terms.groupBy("feature").agg(F.sum(F.col("pxy") * F.log(F.col("pxy") / (F.col("px") * F.col("py")))).alias("mi"))


def select_k_best(df: DataFrame, feats, k: int = 30, target: str = "salary") -> DataFrame:
    """(feature, f_score, mi, score), the k best by 0.6 x mutual information +
    0.4 x F score, each scaled to [0, 1] over the features; ties by name.  A missing value is 0."""
    df = df.na.fill(0, subset=list(feats))
    m = feature_moments(df, feats, target)
    d = f_scores(df, feats, target, m).join(mutual_information(df, feats, target, moments=m), "feature").na.fill(0.0, ["f_score", "mi"])
    unit = lambda c: F.coalesce(F.try_divide(F.col(c) - F.min(c).over(w), F.max(c).over(w) - F.min(c).over(w)), F.lit(0.0))
    w = Window.partitionBy(F.lit(0))  # one row a feature
    return (d.withColumn("score", 0.6 * unit("mi") + 0.4 * unit("f_score"))
            .orderBy(F.desc(F.round("score", 9)), F.asc("feature")).limit(k))


def minmax_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    lo, hi = scalar(df, F.min(col)), scalar(df, F.max(col))
    return df.withColumn(out or f"{col}_scaled", F.try_divide(F.col(col) - lo, hi - lo))


# ------------------------------------------------------------------ clustering
CLUSTER_FEATURES = ["exp_years", "num_skills", "salary", "is_big_city"]


def cluster_market(df: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42, id_col: str = "post_id"):
    """Standardise the features that exist, K-means from ``restarts`` k-means++ seedings, keep
    the lowest cost.  Returns (all rows with ``cluster``, features) or None.

    The label is a column of the same rows: nothing is joined back, so rows
    that repeat an id keep their own.  Without rows every label is null."""
    feats = [c for c in CLUSTER_FEATURES if c in df.columns]
    if not feats:
        return None
    d = df.na.fill(0, subset=feats)
    params = fit_scaler(d, feats)
    z = {f"__z{i}": F.lit(0.0) if not params[c][1] else (q(c) - F.lit(params[c][0])) / F.lit(params[c][1]) for i, c in enumerate(feats)}
    data = d.withColumns(z)
    points = data.select(id_col, *z).persist()
    try:
        found = clustering.kmeans(points, list(z), k, [seed + r for r in range(restarts)], id_col)
    finally:
        points.unpersist()
    cluster = F.lit(None).cast("int") if found is None else clustering.label(list(z), found[0])
    return data.withColumn("cluster", cluster).drop(*z), feats


def cluster_profiles(labelled: DataFrame, feats) -> DataFrame:
    total = scalar(labelled, F.count(F.lit(1)))
    return labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in feats],
                                           F.count(F.lit(1)).alias("count")) \
        .withColumn("percentage", F.col("count") * 100.0 / total)


def cluster_name(exp: Column, salary: Column) -> Column:
    return (F.when((exp < 2) & (salary < 15), F.lit("Entry/Junior Level"))
            .when((exp >= 4) & (salary >= 30), F.lit("Senior/Expert & High Paid"))
            .when((exp >= 2) & (exp < 4), F.lit("Mid-level Professional"))
            .otherwise(F.lit("Specialized/Other")))


# ------------------------------------------------------------------ scoring
def request_features(requests: DataFrame) -> DataFrame:
    """The training features from (experience_years, skills, remote, english, city).

    Same definitions as in training (city multiplier table, combos, flags), so a
    row scores alike either way; what a request can't know (company size,
    salary per skill) is 0."""
    hv = F.array(*[F.lit(s) for s in SERVING_HIGH_VALUE])
    y = F.col("experience_years")
    nsk = F.size("skills")
    big = F.coalesce(F.col("city").isin(BIG_CITIES), F.lit(False))
    nhv = F.size(F.array_intersect("skills", hv))
    d = requests.withColumnsRenamed({"remote": "__remote", "english": "__english"})
    return d.select(
        "*", y.alias("exp_years"), nsk.alias("num_skills"), F.col("__remote").cast("int").alias("remote"),
        F.col("__english").cast("int").alias("english"), big.cast("int").alias("is_big_city"),
        city_multiplier(F.col("city")).alias("city_multiplier"),
        F.lit(0).alias("is_big_company"), (y * y).alias("exp_squared"), (y * nsk).alias("exp_skill_interaction"),
        (y * nhv).alias("exp_high_value"), (F.col("__remote") & F.col("__english")).cast("int").alias("remote_english"),
        (F.col("__remote") & big).cast("int").alias("remote_big_city"), F.lit(0.0).alias("salary_per_skill"),
        nhv.alias("num_high_value_skills"), *combo_flags(F.col("skills"))).drop("__remote", "__english")


def factor_messages(years: Column, skills: Column, english: Column, city: Column) -> Column:
    """Key factors of a prediction, in display order."""
    hv = F.array_intersect(F.array(*[F.lit(s) for s in SERVING_HIGH_VALUE]), skills)
    return F.array_compact(F.array(
        F.when(years >= 5, F.lit("Senior level experience (+30-40%)")).when(years >= 3, F.lit("Mid-level experience (+15-25%)")),
        F.when(F.size(skills) >= 5, F.lit("Broad skill set (+10-15%)")),
        F.when(F.size(hv) > 0, F.concat(F.lit("High-value skills: "), F.array_join(F.slice(hv, 1, 3), ", "), F.lit(" (+20-30%)"))),
        F.when(english, F.lit("English proficiency (+10-15%)")),
        F.when(city.isin(BIG_CITIES), F.lit("Major city premium (+10-15%)"))))


def prediction_band(pred: Column) -> list:
    return [F.round(pred, 1).alias("predicted_salary"), F.round(pred * 0.85, 1).alias("confidence_lower"),
            F.round(pred * 1.15, 1).alias("confidence_upper")]


def predict_caps(pred: Column, years: Column, n_skills: Column, band: float = 4.89) -> list:
    capped = F.when((years < 1) & (n_skills <= 2), F.least(pred, F.lit(12.0))).otherwise(pred)
    return [capped.alias("capped"), (capped - band).alias("band_lower"), (capped + band).alias("band_upper")]
