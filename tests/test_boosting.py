"""Boosted trees against a plain builder that tries every split on the raw values."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.operators import boosting as B


def plain_tree(x, gradient, spec, allowed=None):
    """[(rows, gain, feature, cut)] of the splits in order, and the value of each row."""
    score = lambda g, h: g * g / (h + spec.l2) if h + spec.l2 > 0 else 0.0

    def split(rows, depth):
        best = None
        for f in range(x.shape[1]) if allowed is None else allowed:
            for cut in sorted(set(x[rows, f]))[:-1]:
                left = rows[x[rows, f] <= cut]
                right = rows[x[rows, f] > cut]
                if depth >= spec.depth or min(len(left), len(right)) < max(spec.min_rows, spec.min_hessian):
                    continue
                gain = 0.5 * (score(gradient[left].sum(), len(left)) + score(gradient[right].sum(), len(right))
                              - score(gradient[rows].sum(), len(rows))) - spec.gamma
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, left, right)
        return best

    leaves, order, values, made, level = [], [], np.zeros(len(x)), 0, []
    root = (np.arange(len(x)), 0)
    heap = []

    def push(node, number):
        found = split(*node)
        if found:
            heapq.heappush(heap, (-found[0] if spec.leaves else number, number, node, found))
        else:
            leaves.append(node)

    push(root, made)
    count = 1
    while heap and (spec.leaves is None or count < spec.leaves):
        _, _, (rows, depth), (gain, f, cut, left, right) = heapq.heappop(heap)
        order.append((len(rows), gain, f, cut))
        count += 1
        for side in (left, right):
            made += 1
            push((side, depth + 1), made)
    leaves += [h[2] for h in heap]
    for rows, _ in leaves:
        values[rows] = -spec.rate * gradient[rows].sum() / (len(rows) + spec.l2)
    return order, values


def data(n=300, seed=0, features=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, k, n) for k in (12, 2, 40)][:features], axis=1).astype(float)
    y = x[:, 0] * 0.7 + (np.sin(x[:, -1]) if features > 1 else np.sin(3 * x[:, 0])) + rng.normal(size=n) * 0.1
    return x, y


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(i, a.tolist(), float(b), "extra") for i, (a, b) in enumerate(zip(x, y))],
                                 "id int, features array<double>, label double, row string").repartition(parts)


SPECS = {
    "one feature": (1, B.Spec(rounds=1, depth=4)),
    "depth-wise": (3, B.Spec(rounds=1, depth=4, min_hessian=5.0, gamma=0.01)),
    "leaf-wise": (3, B.Spec(rounds=1, depth=6, leaves=9, l2=0.0, min_rows=4, min_hessian=1e-3)),
    "leaf-wise, one leaf more than fits": (1, B.Spec(rounds=1, depth=2, leaves=40, l2=0.5)),
}


@pytest.mark.parametrize("name", SPECS)
def test_first_tree_is_the_best_of_all_splits(spark, name):
    features, spec = SPECS[name]
    x, y = data(features=features)
    model = B.fit(frame(spark, x, y), spec)
    order, values = plain_tree(x, y.mean() - y, spec)
    tree = model.trees[0]
    got = [(tree.gain[i], tree.feature[i], tree.cut[i]) for i in tree.order]
    assert len(got) == len(order)
    if spec.leaves is None:  # plain order is by level, too
        got, order = sorted(got), sorted(order, key=lambda o: o[1])
    for (gain, f, cut), (_, want, g, c) in zip(got, order):
        assert gain == pytest.approx(want) and (f, cut) == (g, c)
    assert np.allclose(model.values(x), y.mean() + values)


@pytest.mark.parametrize("leaves", [None, 7])
def test_rounds_follow_the_plain_builder(spark, leaves, monkeypatch):
    """Margins written down every two rounds; each round fits what the ones before left."""
    monkeypatch.setattr(B, "ROUNDS_KEPT", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    x, y = data(200, 3)
    spec = B.Spec(rounds=6, depth=4, rate=0.3, leaves=leaves)
    model = B.fit(frame(spark, x, y, 5), spec)
    margin = np.full(len(y), y.mean())
    for _ in range(6):
        margin += plain_tree(x, margin - y, spec)[1]
    assert np.allclose(model.values(x), margin)


def test_samples_of_rows_and_columns_are_hashes(spark):
    x, y = data(500, 5)
    spec = B.Spec(rounds=4, depth=3, subsample=0.5, columns=0.67, rate=0.5)
    d = frame(spark, x, y, 1)
    a, b = B.fit(d, spec), B.fit(d, spec)
    assert [r[:9] for r in a.rows()] == [r[:9] for r in b.rows()]
    assert all(len({int(f) for f in t.feature if f >= 0}) <= 2 for t in a.trees)
    share = B.mix(np.arange(20000), 7)
    assert abs((share < 0.5).mean() - 0.5) < 0.02 and abs(np.corrcoef(share, B.mix(np.arange(20000), 8))[0, 1]) < 0.03


def test_transform_save_and_load(spark, tmp_path):
    x, y = data(120, 2)
    d = frame(spark, x, y)
    model = B.fit(d, B.Spec(rounds=5, depth=3, importance="split"))
    want = dict(zip(range(120), model.values(x)))
    got = {r.id: r.prediction for r in model.transform(d).collect()}
    assert all(got[i] == pytest.approx(want[i]) for i in want)
    model.save(str(tmp_path / "m"))
    again = B.Boosted.load(spark, str(tmp_path / "m"))
    assert np.allclose(again.values(x), model.values(x)) and again.rows() == model.rows()
    splits = np.bincount([f for t in model.trees for f in t.feature if f >= 0], minlength=3)
    assert np.allclose(model.importances, splits / splits.sum())


def test_awkward_tables(spark):
    x, y = data(50, 1)
    d = frame(spark, x, y)
    empty = B.fit(d.limit(0), B.Spec(rounds=2))
    assert empty.trees == [] and [r.prediction for r in empty.transform(d).collect()] == [0.0] * 50
    flat = B.fit(d.withColumn("features", F.array(F.lit(1.0), F.lit(2.0))), B.Spec(rounds=3))
    assert len(flat.trees) == 1 and np.allclose(flat.values(np.ones((2, 2))), y.mean())
    nulls = B.fit(d.withColumn("label", F.when(F.col("id") < 25, F.col("label"))), B.Spec(rounds=2, depth=2))
    assert nulls.base == pytest.approx(y[:25].mean())


def test_many_values_are_cut_at_quantiles(spark):
    d = spark.range(20000).select((F.col("id") / 7).alias("v")).select(F.array("v").alias("x"))
    cuts = B.bin_cuts(d, 1, bins=64)[0]
    assert 60 <= len(cuts) <= 63
    counts = np.diff(np.searchsorted(np.arange(20000) / 7, [-1, *cuts, 1e9], "right"))
    assert counts.max() < 2 * 20000 / 64
