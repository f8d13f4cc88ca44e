"""Exact quantiles by range refinement against sorted values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.operators import quantiles as Q
from hiresight.operators.relational import fill_missing_median, trim_quantiles

SHARES = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]


def plain(values, shares=SHARES):
    s = sorted(values)
    out = []
    for p in shares:
        at = p * (len(s) - 1)
        i = int(at)
        out.append(s[i] if at == i else (i + 1 - at) * s[i] + (at - i) * s[i + 1])
    return out


@pytest.mark.parametrize("limit", [4, 50, Q.LIMIT])
@pytest.mark.parametrize("name", ["distinct", "ties", "two values", "powers", "normal", "few"])
def test_equals_sorting(spark, name, limit):
    rng = random.Random(len(name))
    values = {
        "distinct": [i * 0.37 - 300 for i in range(3001)],
        "ties": [float(rng.choice([1, 1, 1, 1, 2, 3, 50]) + (rng.random() < 0.1) * rng.random()) for _ in range(3000)],
        "two values": [0.0] * 1500 + [1.0] * 1500,
        "powers": [s * 2.0 ** k for k in range(-900, 900) for s in (1, -1)],
        "normal": [rng.gauss(0, 1) for _ in range(2500)],
        "few": [3.5, -1.0, 2.0],
    }[name]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, 1) for v in [*values, None, None]], "v double, x int").repartition(5)
    assert Q.exact_quantiles(df, "v", SHARES, limit) == pytest.approx(plain(values), rel=1e-15)


def test_ten_million_distinct_doubles_with_bounded_state(spark, monkeypatch):
    """Equals the value by rank, and no more than a small range is ever fetched."""
    fetched = []
    sort = np.sort
    monkeypatch.setattr(np, "sort", lambda a: fetched.append(len(a)) or sort(a))
    n = 10_000_000
    # a permutation of 0..n-1, stretched
    df = spark.range(n).select((((F.col("id") * 7919 + 13) % n).cast("double") / 7).alias("v"))
    assert Q.exact_quantiles(df, "v", [0.02, 0.5, 0.98], 20_000) == pytest.approx([p * (n - 1) / 7 for p in (0.02, 0.5, 0.98)], rel=1e-15)
    assert fetched and max(fetched) <= 20_000


def test_no_values_and_special_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert Q.exact_quantiles(df, "v", [0.5]) == [None]
    inf = float("inf")
    df = spark.createDataFrame([(inf,), (-inf,), (0.0,), (float("nan"),), (5.0,)], "v double")
    for limit in (1, 100):
        assert Q.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75], limit) == [-inf, 0.0, 5.0, inf]
    longs = spark.createDataFrame([(4,), (1,), (3,)], "v long")
    assert Q.exact_quantiles(longs, "v", [0.5, 0.75]) == [3.0, 3.5]


def test_fill_and_trim(spark):
    df = spark.createDataFrame([(i, float(i) if i % 3 else None) for i in range(30)], "id int, salary double")
    known = [float(i) for i in range(30) if i % 3]
    filled = {r.id: r.salary for r in fill_missing_median(df).collect()}
    assert all(filled[i] == (float(i) if i % 3 else plain(known, [0.5])[0]) for i in range(30))
    assert {r.salary for r in fill_missing_median(df.where("salary is null")).collect()} == {20.0}
    lo, hi = plain(known, [0.1, 0.9])
    assert sorted(r.salary for r in trim_quantiles(df, "salary", 0.1, 0.9).collect()) == [v for v in known if lo <= v <= hi]
    assert trim_quantiles(df.where("salary is null")).collect() == []
