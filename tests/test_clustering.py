"""K-means by hash draws against a plain version of it."""

import hashlib
import math

import numpy as np
import pytest

from hiresight.operators import clustering as C
from hiresight.operators.ml import cluster_market


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 4294967296.0


def plain(points, k, restarts):
    best = None
    for r in restarts:
        centres = [min(points, key=lambda p: (uniform(p[0], r, 0), p))[1]]
        for s in range(1, k):
            d2 = {p: min(sum((a - b) ** 2 for a, b in zip(p[1], c)) for c in centres) for p in points}
            drawn = [p for p in points if d2[p] > 0]
            if drawn:
                centres.append(min(drawn, key=lambda p: (-math.log(1 - uniform(p[0], r, s)) / d2[p], p))[1])
        for _ in range(300):
            x, c = np.array([p[1] for p in points]), np.array(centres)
            d = ((x[:, None] - c[None]) ** 2).sum(2)
            near = d.argmin(1)
            new = [tuple(x[near == i].mean(0)) if (near == i).any() else centres[i] for i in range(len(centres))]
            cost, done = d.min(1).sum(), np.allclose(new, centres, atol=1e-9, rtol=0)
            centres = new
            if done:
                break
        if best is None or (round(cost, 6), r) < (round(best[1], 6), best[2]):
            best = (centres, cost, r)
    return best


@pytest.mark.parametrize("parts", [1, 5])
def test_kmeans_equals_the_plain_version(spark, parts):
    rng = np.random.default_rng(3)
    points = [(i, tuple(np.round(rng.normal(size=2) + 3 * rng.integers(0, 4, 2), 3).tolist())) for i in range(300)]
    df = spark.createDataFrame([(i, *p) for i, p in points], "post_id long, a double, b double").repartition(parts)
    centres, cost = C.kmeans(df, ["a", "b"], 4, [42, 43, 44])
    want = plain(points, 4, [42, 43, 44])
    assert np.allclose(centres, want[0]) and cost == pytest.approx(want[1])
    labels = {r.post_id: r.c for r in df.select("post_id", C.label(["a", "b"], centres).alias("c")).collect()}
    near = ((np.array([p for _, p in points])[:, None] - np.array(centres)[None]) ** 2).sum(2).argmin(1)
    assert labels == dict(enumerate(near.tolist()))


def test_few_points(spark):
    df = spark.createDataFrame([(i, 1.0 + i % 2, 2.0, 3.0, 0) for i in range(9)], "post_id long, exp_years double, num_skills double, salary double, is_big_city int")
    rows = cluster_market(df, restarts=2)[0].collect()
    assert len(rows) == 9 and len({r.cluster for r in rows}) == 2
    assert {r.cluster for r in cluster_market(df.where("post_id = 0"), restarts=2)[0].collect()} == {0}
    assert cluster_market(df.limit(0), restarts=2)[0].collect() == [] and cluster_market(df.select("post_id")) is None
