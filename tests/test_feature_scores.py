"""Feature scores are sums by task in numpy; categories are found once a row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.functions import skills as K
from hiresight.operators import ml as M
from hiresight.operators.relational import concat_text
from hiresight.plans import q_core


def _rows(n=400):
    rng = np.random.default_rng(5)
    a, b = rng.normal(1e6, 1, n), rng.integers(0, 2, n)
    y = 3 * (a - 1e6) + b + rng.normal(0, 1, n)
    return [(float(a[i]), None if i % 50 == 7 else int(b[i]), 0.1, None if i % 40 == 3 else float(y[i])) for i in range(n)]


DDL, FEATS = "a double, b int, flat double, salary double", ["a", "b", "flat"]


def test_moments_match_plain_sums_whatever_the_partitions(spark):
    rows = _rows()
    m = M.feature_moments(spark.createDataFrame(rows, DDL).repartition(7), FEATS, "salary")
    for i, c in enumerate(FEATS):
        x = [r[i] for r in rows if r[i] is not None]
        pairs = [(r[i], r[3]) for r in rows if r[i] is not None and r[3] is not None]
        assert (m["n"][i], m["k"][i], m["low"][i], m["high"][i]) == (len(x), len(pairs), min(x), max(x))
        assert m["m2"][i] == pytest.approx(np.var(x) * len(x), rel=1e-6, abs=1e-9)
        assert m["c"][i] / m["k"][i] == pytest.approx(np.cov(np.array(pairs).T, bias=True)[0, 1], rel=1e-6, abs=1e-9)
    assert m["m2"][2] == 0  # a constant column has no spread at all


def test_scores_match_spark_aggregates(spark):
    df = spark.createDataFrame(_rows(), DDL).na.fill(0).repartition(3).persist()
    got = {r["feature"]: r for r in M.select_k_best(df, FEATS, 3).collect()}
    n = df.count()
    for c in FEATS:
        r = df.select(F.try_divide(F.covar_pop(c, "salary"), F.stddev_pop(c) * F.stddev_pop("salary"))).first()[0]
        assert got[c]["f_score"] == pytest.approx(0 if r is None else r * r / (1 - r * r) * (n - 2), rel=1e-9)
    v = df.toPandas()
    for c in FEATS:
        cut = lambda s: np.zeros(n) if s.min() == s.max() else np.minimum(np.floor((s - s.min()) / ((s.max() - s.min()) / 16)), 15)
        joint = np.histogram2d(cut(v[c]), cut(v["salary"]), bins=16, range=((0, 16), (0, 16)))[0] / n
        outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
        assert got[c]["mi"] == pytest.approx(sum(p * math.log(p / q) for p, q in zip(joint.ravel(), outer.ravel()) if p), abs=1e-9)


def test_scores_of_no_rows(spark):
    assert M.select_k_best(spark.createDataFrame([], DDL), FEATS, 3).collect() == []


def test_categories_extract_the_skills_once_a_row(spark, monkeypatch):
    rows = [(1, "Python, Django and SQL; docker on AWS"), (2, ""), (3, None)]
    monkeypatch.setattr(q_core.C, "postings", lambda s, d: s.createDataFrame(rows, "post_id long, description string"))
    got = q_core.q_skill_categories(spark, "")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    found = spark.createDataFrame(rows, "post_id long, description string").select(K.skill_extract("description")).first()[0]
    category = {e[0]: e[1] for e in K.lexicon_entries()}
    want = {}
    for s in found:
        want[category[s]] = want.get(category[s], 0) + 1
    assert want and sorted(map(tuple, got.collect())) == sorted((1, c, n) for c, n in want.items())


def test_concat_text_strips_all_unicode_white_space(spark):
    pad = "".join(chr(i) for i in range(0x3100) if chr(i) in "\t\n\x0b\x0c\r \x85\xa0     　" or 0x2000 <= i <= 0x200A)
    df = spark.createDataFrame([(f"{pad}a {pad} b", f"c{pad}\n"), (pad, None), ("​x​", "")], "job_description string, qualifications string")
    pattern = F.regexp_replace(F.concat(F.lit(" "), F.coalesce("job_description", F.lit("")), F.lit(" "), F.coalesce("qualifications", F.lit(""))), "(?U)^\\s+|\\s+$", "")
    assert [r[0] for r in df.select(concat_text(df)).collect()] == [r[0] for r in df.select(pattern).collect()]
