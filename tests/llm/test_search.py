"""Quality vote, hard negatives and lexical search against plain versions of them."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.llm import hard_negatives as hn
from hiresight.llm import lexical_search as ls
from hiresight.llm import quality as q

from . import helpers

# ------------------------------------------------------------------ lexical search
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_search(docs, items, k=20):
    """Counter of (item_id, rank, doc_id, score)."""
    own = lambda t: [helpers.lower(x) for x in TERM.findall(t or "")]
    texts = [(i, own(t)) for i, t in docs]
    texts = [(i, ts) for i, ts in texts if ts]
    n, total, df = len(texts), sum(len(ts) for _, ts in texts), Counter(t for _, ts in texts for t in set(ts))
    out = Counter()
    for item, text in {(i, t) for i, t in items if t is not None}:
        found = []
        for doc, ts in texts:
            tf, m = Counter(ts), 75 + (25 * len(ts) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                        for t in own(text) if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        out.update((item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(found[:k]))
    return out


ITEMS = [(1, "alpha beta ALPHA gamma"), (1, "alpha beta ALPHA gamma"), (1, "one two"), (2, "漢字 ünïcödé zeta"), (3, ""), (4, None),
         (None, "orphan text"), (5, "nowhere-at-all"), (6, "lorem. ipsum, lorem"), (7, "this very line IS repeated"), (8, helpers.LONG)]
ITEM_DDL = "item_id long, text string, doc_id long, score long, rank int, term long, n long"


@pytest.mark.parametrize("bounds", [{}, {"k": 3}, {"block_bytes": 20_000}])
def test_search_equals_brute_force(spark, bounds):
    items = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in ITEMS], ITEM_DDL)
    got = ls.ranked_search(helpers.edge_docs(spark), items, **bounds).collect()
    want = brute_search([r[:2] for r in helpers.edge_rows()], ITEMS, bounds.get("k", 20))
    assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in got) == want


def test_search_random_texts_and_splits(spark):
    rng = random.Random(4)
    words = [a + b for a in ("", "x", "é", "9") for b in "abcdefg"]
    joins = [" ", "  ", "\n", "-", "_", "\x00", "\t", " ", "/"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(joins) for _ in range(n))
    docs = [(i // 2, text(rng.randrange(40))) for i in range(150)]
    items = [(i, text(rng.randrange(1, 9))) for i in range(12)]
    want = brute_search(docs, items)
    for parts in (1, 7):
        got = ls.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
                               spark.createDataFrame(items, "item_id long, text string")).collect()
        assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in got) == want


def test_search_empty_tables(spark):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert ls.ranked_search(helpers.empty_docs(spark), items).collect() == []
    assert ls.ranked_search(helpers.edge_docs(spark), items.limit(0)).collect() == []
    assert ls.ranked_search(helpers.edge_docs(spark), items.withColumn("text", F.lit(" .,"))).collect() == []


# ------------------------------------------------------------------ hard negatives
VECTOR_DDL = "vec_id long, embedding array<float>, label int, id string, c int, a int, score double, positives string, vector int"


def brute_negatives(rows, positives=5, negatives=3, low=50, high=95, scale=256):
    best, out = {}, []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        row = (label, tuple(math.floor(scale * float(np.float32(v))) for v in x))
        best[i] = min(best.get(i, row), row)
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    for i, (label, x) in best.items():
        if i % 50:
            continue
        order = sorted(((-dot(x, y), j, lab) for j, (lab, y) in best.items() if j != i))
        for s, j, _ in [o for o in order if o[2] == label][:positives]:
            far = [(n, k) for n, k, lab in order if lab != label and low * -s <= 100 * -n <= high * -s][:negatives]
            out += [(i, j, r + 1, k, -s, -n) for r, (n, k) in enumerate(far)]
    return Counter(out)


def vectors(rng, n, dims, labels):
    centres = rng.normal(size=(6, dims))
    return [(i, [float(v) for v in np.round((centres[rng.integers(6)] + rng.normal(size=dims) * 0.7) / 8, 3)], int(rng.integers(labels))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, x, lab, "i", 1, 2, 0.5, "p", 3) for i, x, lab in rows], VECTOR_DDL).repartition(3)


def got_negatives(spark, rows, **params):
    out = hn.hard_negatives(frame(spark, rows), **params).collect()
    return Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in out)


@pytest.mark.parametrize("params", [{}, {"block_rows": 90}, {"positives": 2, "negatives": 1, "low": 10, "high": 100}])
def test_negatives_equal_brute_force(spark, params):
    rows = vectors(np.random.default_rng(3), 420, 6, 4)
    want = brute_negatives(rows, **{k: v for k, v in params.items() if k != "block_rows"})
    assert want and got_negatives(spark, rows, **params) == want


def test_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [0.5, -0.25, 0.125]
    rows = [(0, base, 1), (0, base, 1), (1, base, 1), (2, base, 1), (2, [0.5], 0), (3, base, None), (4, None, 1), (None, base, 1), (5, [None, 1.0, 1.0], 1),
            (6, [nan, 1.0, 1.0], 1), (7, [inf, 1.0, 1.0], 2), (8, [], 1), (9, [0.4, -0.2, 0.1], 2), (10, [0.4, -0.2, 0.1], 3), (11, [0.4, -0.2], 2),
            (12, [0.45, -0.2, 0.1, 0.3], 2), (50, [0.0, 0.0, 0.0], 2), (-50, [-0.5, 0.2, 0.0], 7), (13, [-0.5, 0.3, 0.0], 7), (14, [-0.4, 0.3, 0.0], 3),
            (100, [3e5, -3e5, 1.0], 9), (15, [2e5, -2e5, 1.0], 9), (16, [1e5, -1e5, 1.0], 3)]
    rows += [(200 + i, base, 1) for i in range(30)] + [(300 + i, [0.4, -0.25, 0.1], 4) for i in range(30)]
    want = brute_negatives(rows)
    assert want and got_negatives(spark, rows) == want and got_negatives(spark, rows, block_rows=7) == want


def test_negatives_empty_tables(spark):
    assert hn.hard_negatives(frame(spark, [(0, [1.0], 1)]).limit(0)).collect() == []
    assert hn.hard_negatives(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)])).collect() == []


def test_threshold_algorithm_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 100, (5000, 3))
    lists = hn.SortedLists(np.arange(5000), rng.integers(0, 3, 5000), x)
    met = []
    rows, a = lists.exact(100), np.array([7, -3, 0])
    inner = x @ a
    for low, high in ((-math.inf, math.inf), (100, 400)):
        found = lists.search(rows, a, lambda new: met.append(len(new)) or np.ones(len(new), bool), [(low, high)], 4)[0]
        order = sorted((-int(s), i) for i, s in enumerate(inner) if low <= s <= high)[:4]
        assert found == [(-s, i) for s, i in order]
        met.append(-1)
    assert sum(met[:met.index(-1)]) < 1000  # without bounds, a fraction of the rows is met


# ------------------------------------------------------------------ quality
def quality_corpus(n, seed=2):
    rng = random.Random(seed)
    words = ["tion", "ing", "the", "of", "and", "re", "er", "ble", "sha", "ou"]
    word = lambda: "".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(20, 80))]
        good = i % 4 != 0
        text = " ".join(ws).capitalize() if good else rng.choice([" | ".join(ws), " ".join(w + rng.choice(["###", "$$$"]) for w in ws), " ".join(w for w in ws for _ in range(9))])
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


LABEL_DDL = "doc_id long, quality int, text string, score double"


def test_quality_on_held_out_rows(spark):
    docs, labels = quality_corpus(800)
    got = {r.doc_id: r for r in q.quality_scores(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                                 spark.createDataFrame([(i, y, "t", 0.5) for i, y in labels], LABEL_DDL)).collect()}
    assert len(got) == 800
    held = [(i, y) for i, y in labels if helpers.fold(i, 5) == 0]
    assert held and all(got[i].held_out == (helpers.fold(i, 5) == 0) for i, _ in labels)
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


def test_quality_learns_from_its_folds_only_and_from_a_bounded_sample(spark):
    docs, labels = quality_corpus(300)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    odd = [(i, 1 - y if helpers.fold(i, 5) == 0 else y, "t", 0.5) for i, y in labels]  # the held-out labels turned round
    a = q.fit(d, spark.createDataFrame([(i, y, "t", 0.5) for i, y in labels], LABEL_DDL))
    b = q.fit(d, spark.createDataFrame(odd, LABEL_DDL))
    assert all(np.array_equal(x, y) for x, y in zip(a, b))
    small = q.fit(d, spark.createDataFrame(odd, LABEL_DDL), per_label=20)
    assert len(small[3]) == 40 and sorted(small[3].tolist()) == [0] * 20 + [1] * 20


def test_quality_vote_equals_plain_cosines(spark):
    docs, labels = quality_corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = q.fit(d, spark.createDataFrame([(i, y, "t", 0.5) for i, y in labels], LABEL_DDL), per_label=30)
    idf, space, vectors, ys, prior = model
    found = [q.columns(t, q.Terms()) for _, t in docs[:40]]
    for (at, n), s in zip(found, q.vote(model, found, 5)):
        v = sum(float(w) * space[i].astype(float) for i, w in zip(at, q.weigh(at, n, idf)))
        cosine = (vectors @ (v / np.linalg.norm(v))).tolist()
        top = sorted(range(len(ys)), key=lambda i: -cosine[i])[:5]
        top = [i for i in range(len(ys)) if cosine[i] >= cosine[top[-1]] - 1e-6 and cosine[i] > 0]
        assert s == pytest.approx(sum(cosine[i] * ys[i] for i in top) / sum(cosine[i] for i in top), abs=1e-4)


def test_quality_terms_are_of_the_whole_text():
    text = "Foo-bar ### foo FOO 12 (x) x x _y_ 漢字!! " + "z" * 100
    at, n = q.columns(text, q.Terms())
    want = Counter()
    for w in text.split():
        want.update(q.word_terms(w))
    want.update({q.REPEAT: 1, q.column(f"r {10 // len(text.split())}"): 1})
    assert dict(zip(at.tolist(), n.tolist())) == want
    assert q.word_terms("(x).") == (q.column("w x"), q.SHAPES["lower"], q.column("b ("), q.column("e )."))


def test_quality_of_awkward_rows(spark):
    rows = helpers.edge_rows()
    labels = [(r[0], i % 2, "t", 0.1) for i, r in enumerate(rows)] + [(4, 1, "t", 0.1), (4, 0, "t", 0.1), (5, None, "t", 0.1), (None, 1, "t", 0.1), (6, 7, "t", 0.1), (999, 1, "t", 0.1)]
    frame = spark.createDataFrame(labels, LABEL_DDL)
    got = q.quality_scores(helpers.edge_docs(spark), frame).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 and r.held_out == (helpers.fold(r.doc_id, 5) == 0) for r in got)
    empty = {r.doc_id: r.score for r in got if r.doc_id in (1, 2, 3, 10)}
    assert len(set(empty.values())) == 1  # null, empty and blank texts get the share of label 1
    assert q.quality_scores(helpers.empty_docs(spark), frame).collect() == []
    assert {r.score for r in q.quality_scores(helpers.edge_docs(spark), frame.limit(0)).collect()} == {0.5}
