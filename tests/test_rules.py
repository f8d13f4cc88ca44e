"""Rules grown by level against all splits."""

import random
from itertools import combinations

import pytest

from hiresight.operators.rules import association_rules, frequent_itemsets


def all_rules(support, min_lift, min_confidence):
    out = {}
    for items, s in support.items():
        for k in range(1, len(items)):
            for c in combinations(items, k):
                a = tuple(x for x in items if x not in c)
                conf = s / support[a]
                if conf >= min_confidence and conf / support[c] >= min_lift:
                    out[a, c] = (s, conf, conf / support[c])
    return out


@pytest.mark.parametrize("min_lift,min_confidence", [(1.2, 0.0), (0.0, 0.0), (1.0, 0.6), (3.0, 0.2)])
def test_rules_equal_all_splits(spark, min_lift, min_confidence):
    rng = random.Random(6)
    groups = ["abc", "bde", "fgh", "ade", "abcde"]
    baskets = [sorted({*rng.choice(groups), *rng.sample("abcdefgh", rng.randrange(4))}) for _ in range(150)]
    found = frequent_itemsets(spark.createDataFrame([(b,) for b in baskets], "items array<string>"), 0.05)
    support = {tuple(r["items"]): r.support for r in found.collect()}
    assert max(map(len, support)) >= 5
    got = {(tuple(r.antecedents), tuple(r.consequents)): (r.support, r.confidence, r.lift)
           for r in association_rules(found, min_lift, min_confidence=min_confidence).collect()}
    want = all_rules(support, min_lift, min_confidence)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_long_itemset_ends(spark):
    """30 items with the supports of large subsets only: confident rules have short consequents."""
    items = [f"i{n:02d}" for n in range(30)]
    rows = [(items, 10, 0.1)] + [(sorted(set(items) - {x}), 12, 0.12 if x < "i03" else 0.5) for x in items]
    rows += [([x], 90, 0.09 if x < "i03" else 0.9) for x in items]
    rows += [(sorted(set(items) - {x, y}), 15, 0.6) for x, y in combinations(items[:3], 2)] + [([x, y], 10, 0.1) for x, y in combinations(items[:3], 2)]
    df = spark.createDataFrame(rows, "items array<string>, freq long, support double")
    got = {tuple(r.consequents) for r in association_rules(df, 1.0, min_confidence=0.5).collect()}
    assert got == {("i00",), ("i01",), ("i02",)}


def test_no_itemsets(spark):
    df = spark.createDataFrame([(["a"], 3, 0.5)], "items array<string>, freq long, support double")
    assert association_rules(df).collect() == [] and association_rules(df.limit(0)).collect() == []
