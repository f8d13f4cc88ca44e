"""Invariants of the scale-oriented operators (no oracle needed)."""

import random

import pytest
from pyspark.sql import functions as F

from hiresight.functions.skills import alias_map, lexicon_entries, pattern_pairs, skill_extract
from hiresight.functions.text import normalise_for_skills
from hiresight.operators.relational import keep_first
from hiresight.operators.sampling import level_targets, sample_exact_per_group


def test_lexicon_counts():
    ents = lexicon_entries()
    assert len(ents) == 164
    assert sum(len(a) for *_, a in ents) == 379
    assert len({c for _, c, _, _ in ents}) == 16
    m = alias_map()
    assert m["django"] == "django" and m["kafka"] == "message queue" and m["aws lambda"] == "serverless"


WORDS = ["python", "java", "javascript", "react native", "es", "rn", "docker", "aws", "k8s", "rb", "go", "sql",
         "mysql", "spring boot", "c++", "node.js", "platform", "clients", "kafka", "gitlab", "x", "-", "lập trình"]


@pytest.mark.parametrize("seed", [7, 8, 9])
def test_trie_regex_matches_naive_substring(spark, seed):
    """The one-pass trie regex gives exactly the naive 'every pattern as a substring' result."""
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: list(r["s"]) for r in df.select("i", skill_extract(F.col("t")).alias("s")).collect()}
    norms = {r["i"]: r["n"] for r in df.select("i", normalise_for_skills(F.col("t")).alias("n")).collect()}
    pairs = pattern_pairs()
    for i, t in enumerate(texts):
        if not t:
            assert got[i] == []
            continue
        n = norms[i]
        exp = {s for p, s in pairs if p in n}
        if "rb" in n.split():
            exp.add("ruby")
        assert got[i] == sorted(exp), (t, got[i], sorted(exp))


def test_keep_first_picks_smallest_order(spark):
    rows = [(1, 1, "a", "x"), (2, 0, "a", "x"), (3, 0, "a", "x"), (4, 1, "b", "y"), (5, 1, "", "")]
    df = spark.createDataFrame(rows, "post_id int, source_rank int, title string, company string")
    got = sorted(r[0] for r in keep_first(df.repartition(3), ["title", "company"], ["source_rank", "post_id"])
                 .select("post_id").collect())
    assert got == [2, 4, 5]


def test_exact_sample_sizes_and_determinism(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("post_id"),
                                     F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid")
                                     .otherwise("small").alias("level"))
    targets = spark.createDataFrame([("big", 1234), ("mid", 999), ("small", 2000)], "level string, target long")
    a = sample_exact_per_group(df.repartition(1), ["level"], targets)
    b = sample_exact_per_group(df.repartition(7), ["level"], targets)
    sizes = {r[0]: r[1] for r in a.groupBy("level").count().collect()}
    assert sizes == {"big": 1234, "mid": 999, "small": 500}
    assert sorted(r[0] for r in a.select("post_id").collect()) == sorted(r[0] for r in b.select("post_id").collect())
    # same rows as a global sort by (md5, id)
    w = df.withColumn("h", F.md5(F.concat(F.col("post_id").cast("string"), F.lit(":42"))))
    exp = set()
    for lvl, k in (("big", 1234), ("mid", 999), ("small", 2000)):
        rows = sorted((r["h"], r["post_id"]) for r in w.where(F.col("level") == lvl).collect())[:k]
        exp |= {pid for _, pid in rows}
    assert {r[0] for r in a.select("post_id").collect()} == exp


def test_level_targets(spark):
    df = spark.createDataFrame([("Junior",)] * 3000 + [("Middle",)] * 400 + [("Senior",)] * 300, "level string")
    t = {r[0]: r[1] for r in level_targets(df).collect()}
    assert t == {"Junior": 2100, "Middle": 400, "Senior": 300}


def test_rules_lift_symmetry(spark):
    from hiresight.operators.rules import association_rules, frequent_itemsets
    b = spark.createDataFrame([(i, items) for i, items in enumerate(
        [["a", "b"], ["a", "b", "c"], ["a"], ["b", "c"], ["a", "b", "c"], ["c"]] * 5)], "profile_id int, items array<string>")
    rules = association_rules(frequent_itemsets(b, 0.1), min_lift=0.0)
    lifts = {(",".join(r["antecedents"]), ",".join(r["consequents"])): r["lift"] for r in rules.collect()}
    for (a, c), l in lifts.items():
        assert abs(lifts[(c, a)] - l) < 1e-12


def test_synthetic_rows_are_deterministic_and_in_range(spark):
    from hiresight.operators.augment import synth_fresher, synth_level
    a = synth_level(spark, "Junior", 300).collect()
    b = synth_level(spark, "Junior", 300).repartition(5).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    for r in a:
        assert 1 <= r["exp_years"] < 3 and 10 <= r["salary"] < 18 and 3 <= r["num_skills"] < 6
        assert r["city"] in ("Hanoi", "Ho Chi Minh City", "Da Nang", "Hai Phong")
    f = synth_fresher(spark, 200).collect()
    assert all(5 <= r["salary"] <= 12 and 1 <= r["num_skills"] <= 4 for r in f)


def test_bootstrap_of_any_group_size(spark):
    import hashlib
    df = spark.createDataFrame([(i, "big" if i < 2000 else "small", i % 7) for i in range(2003)], "post_id long, g string, x int").repartition(5)
    from hiresight.operators.sampling import bootstrap_n
    got = sorted((r.g, r.post_id, r.x) for r in bootstrap_n(df, "g", 50).collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    want = []
    for g, ids in (("big", range(2000)), ("small", range(2000, 2003))):
        order = sorted(ids, key=lambda i: (md5(f"{i}:42"), i))
        for draw in range(1, 51):
            i = order[int(md5(f"{g}:{draw}:42")[:8], 16) % len(order)]
            want.append((g, i, i % 7))
    assert got == sorted(want)


def test_split_keeps_every_row_when_ids_repeat(spark):
    from hiresight.operators.ml import exact_split
    df = spark.createDataFrame([(i // 3, i) for i in range(298)], "post_id long, n int").repartition(4)
    train, test = exact_split(df)
    a, b = [r.n for r in train.collect()], [r.n for r in test.collect()]
    assert len(b) == 60 and sorted(a + b) == list(range(298))
    assert [x.count() for x in exact_split(df.limit(0))] == [0, 0]
    assert [x.count() for x in exact_split(df.where("n = 5"))] == [0, 1]


def test_tail_limit_holds_the_cap(spark):
    from hiresight.operators.augment import aug_limit_tail
    df = spark.createDataFrame([(i, 0) for i in range(100)] + [(1000 + i, 1) for i in range(5)], "post_id long, origin_rank int")
    assert aug_limit_tail(df, 50, 0.1).count() == 55 and aug_limit_tail(df, 100, 0.03).where("origin_rank = 1").count() == 3
    assert aug_limit_tail(df, 100, 0.3).count() == 105


def test_synthetic_ids_never_meet(spark):
    from hiresight.operators.augment import SYNTH_TAGS, synth_fresher, synth_level
    parts = [synth_level(spark, "Junior", 50, tag=t) for t in SYNTH_TAGS[:-1]]
    ids = [r.post_id for p in parts for r in p.select("post_id").collect()] + [r.post_id for r in synth_fresher(spark, 50).collect()]
    assert len(set(ids)) == len(ids) and max(ids) < 0
    a, b = ([r.salary for r in synth_level(spark, "Junior", 20, tag=t).collect()] for t in ("10-15M", "15-20M"))
    assert a != b


def test_balancing_fills_what_is_empty(spark):
    from hiresight.functions.parsing import seniority_level  # noqa: F401
    from hiresight.operators.augment import synth_level
    from hiresight.operators.sampling import balance_all, balance_brackets, salary_bracket
    one = synth_level(spark, "Middle", 40)
    got = {r[0]: r[1] for r in balance_brackets(one, 30).withColumn("b", salary_bracket()).groupBy("b").count().collect()}
    assert sum(got.values()) == 180 and got["15-20M"] >= 30
    empty = balance_all(one.limit(0))
    assert empty.count() == 1800


def test_clusters_keep_rows_that_repeat_an_id(spark):
    from hiresight.operators.ml import cluster_market
    rows = [(i // 2, float(i % 9), i % 5, 10.0 + i % 30, i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "post_id long, exp_years double, num_skills int, salary double, is_big_city int")
    best, feats = cluster_market(df, restarts=4)
    assert best.count() == 120 and best.columns == [*df.columns, "cluster"]

    def cost(d):
        from hiresight.operators.ml import fit_scaler
        p = fit_scaler(d.drop("cluster"), feats)
        pts = [(r.cluster, [(r[c] - p[c][0]) / p[c][1] for c in feats]) for r in d.collect()]
        total = 0
        for k in {c for c, _ in pts}:
            own = [x for c, x in pts if c == k]
            mid = [sum(v) / len(own) for v in zip(*own)]
            total += sum((a - b) ** 2 for x in own for a, b in zip(x, mid))
        return total

    assert all(cost(best) <= cost(cluster_market(df, restarts=1, seed=42 + r)[0]) + 1e-6 for r in range(4))


def test_scorer_scores_like_the_fit_and_survives_saving(spark):
    from hiresight.operators import ml as M
    from hiresight.sources.feeds import scratch_path
    df = spark.range(400).select(F.col("id").alias("post_id"), (F.col("id") % 11).cast("double").alias("exp_years"),
                                 (F.col("id") % 6).alias("num_skills"), (F.col("id") % 2).alias("remote"),
                                 (10 + F.col("id") % 11 * 2 + F.col("id") % 6).cast("double").alias("salary"))
    p = M.prepare_training(df)
    metrics, models = M.train_models(p, only=["Linear Regression", "Gradient Boosting"], rounds=5)
    best = M.best_scorer(p, metrics, models)
    path = scratch_path(spark, "test-scorer")
    assert M.Scorer.load(spark, path) is None
    best.save(path)
    again = M.Scorer.load(spark, path)
    want = {r.post_id: r.p for r in best.model.transform(p.test).select("post_id", F.expm1("prediction").alias("p")).collect()}
    got = {r.post_id: r.p for r in again.score(df).collect()}
    assert len(got) == 400 and all(abs(got[i] - v) < 1e-9 for i, v in want.items())
    r2 = {r.model: r.r2 for r in metrics.collect()}
    assert r2["Linear Regression"] > 0.9 and r2["Gradient Boosting"] > 0


def test_linear_model_on_one_feature_is_the_regression_line(spark, duck):
    from hiresight.operators import ml as M
    df = spark.range(300).select(F.col("id").alias("post_id"), (F.col("id") % 13).cast("double").alias("exp_years"),
                                 (8 + F.col("id") % 13 * 1.5 + F.col("id") % 4).cast("double").alias("salary"))
    p = M.prepare_training(df)
    _, models = M.train_models(p, only=["Linear Regression"])
    rows = [(r.label, float(r.features[0])) for r in p.train.collect()]
    n, mx, my = len(rows), sum(x for _, x in rows) / len(rows), sum(y for y, _ in rows) / len(rows)
    slope = sum((x - mx) * (y - my) for y, x in rows) / sum((x - mx) ** 2 for _, x in rows)
    m = models["Linear Regression"]
    assert n > 200
    assert abs(m.coefficients[0] - slope) < 1e-6 and abs(m.intercept - (my - slope * mx)) < 1e-6


def test_forest_grid_is_whole():
    from hiresight.operators.ml import model_specs
    specs = dict(model_specs())
    assert len(specs["Random Forest"].getEstimatorParamMaps()) == 16 and specs["Random Forest"].getNumFolds() == 5
    assert {specs["XGBoost"].rounds, specs["LightGBM"].rounds, specs["Gradient Boosting"].getMaxIter()} == {200}
    assert (specs["XGBoost"].depth, specs["XGBoost"].leaves, specs["LightGBM"].depth, specs["LightGBM"].leaves) == (7, None, 10, 31)


def test_r2_does_not_cancel(spark):
    from hiresight.operators.ml import regression_metrics
    df = spark.createDataFrame([(1e9 + i, 1e9 + i + (0.1 if i % 2 else -0.1)) for i in range(100)], "label double, prediction double")
    r = regression_metrics(df, log_scale=False).first()
    sst = sum((i - 49.5) ** 2 for i in range(100))
    assert abs(r.r2 - round(1 - 1.0 / sst, 4)) < 1e-4
