"""The dashboard's answers: scored by a fitted model, capped, with band and key factors."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from hiresight.operators import ml as M
from hiresight.plans import clean as C
from hiresight.plans import q_ml


def test_caps_are_taken_of_the_model_s_score(spark, monkeypatch):
    from pyspark.sql import functions as F
    data = q_ml.prepared(spark, SF_SMALL)
    metrics, models = M.train_models(data, only=["XGBoost"], rounds=8)
    asked = []
    monkeypatch.setattr(q_ml, "fitted", lambda spark, sf, only=None: asked.append(only) or (metrics, models, data))
    got = {r.post_id: r for r in E.queries()["predict_caps"](spark, SF_SMALL).collect()}
    assert asked == [["XGBoost"]]
    feats = M.with_skill_flags(M.request_features(q_ml.requests(spark, SF_SMALL)))
    score = {r.post_id: r.p for r in M.Scorer(models["XGBoost"], data.features, data.scaler).score(feats).collect()}
    rows = C.clean_postings(spark, SF_SMALL).withColumn("formula", F.expr(q_ml.PRED_SQL)).collect()
    assert len(got) == len(rows) and len({round(p, 6) for p in score.values()}) > 3
    for r in rows:
        p = min(score[r.post_id], 12.0) if r.exp_years < 1 and len(r.skills) <= 2 else score[r.post_id]
        g = got[r.post_id]
        assert (g.capped, g.band_lower, g.band_upper) == pytest.approx((p, p - 4.89, p + 4.89), abs=2e-6) and math.isfinite(p)
        high = [s for s in ("python", "aws", "docker", "kubernetes", "devops") if s in r.skills]
        want = ["Senior level experience (+30-40%)"] if r.exp_years >= 5 else ["Mid-level experience (+15-25%)"] if r.exp_years >= 3 else []
        want += ["Broad skill set (+10-15%)"] * (len(r.skills) >= 5) + [f"High-value skills: {', '.join(high[:3])} (+20-30%)"] * bool(high)
        want += ["English proficiency (+10-15%)"] * r.english + ["Major city premium (+10-15%)"] * (r.city in ("Hanoi", "Ho Chi Minh City"))
        assert g.factors == "; ".join(want)
    assert len({g.factors for g in got.values()}) > 5


def test_rules_on_given_predictions_match_the_sql(spark, duck):
    got = E.queries()["predict_caps_rules"](spark, SF_SMALL).collect()
    cur = duck.execute(E.oracle_sql()["predict_caps_rules"])
    names = [d[0] for d in cur.description]
    key = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted(key([r[n] for n in names]) for r in got) == sorted(map(key, cur.fetchall()))
    assert "predict_caps" not in E.oracle_sql()
