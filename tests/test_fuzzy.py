"""Matching-block ratios against the standard library's."""

import random
from difflib import SequenceMatcher, get_close_matches

from pyspark.sql import functions as F

from hiresight.functions import fuzzy as Z


def words(rng, n, letters="abcé", most=9):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_ratio_equals_difflib(spark):
    rng = random.Random(1)
    pairs = list(zip(words(rng, 300), words(rng, 300))) + [("javascript", "javascripts"), ("pyhton", "python"), ("qabxcd", "abycdf"), ("", ""), ("", "a")]
    pairs += list(zip(words(rng, 60, "ab", 14), words(rng, 60, "ab", 14)))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i: r.s for r in df.select("i", Z.ratio(F.col("a"), F.col("b")).alias("s")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == SequenceMatcher(None, a, b).ratio(), (a, b)


def test_bound_is_above_the_ratio(spark):
    rng = random.Random(2)
    target = "docker"
    ws = words(rng, 200, "dockerx", 10)
    df = spark.createDataFrame([(w,) for w in ws], "w string")
    for r in df.select("w", Z.shared_bound(F.col("w"), target).alias("b")).collect():
        m = SequenceMatcher(None, r.w, target)
        assert r.b == m.quick_ratio() and r.b >= m.ratio()


def test_close_words_equal_get_close_matches(spark):
    rng = random.Random(3)
    targets = ["python", "java", "javascript", "react", "aws"]

    def typo(t):
        t = list(t)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(t))
            t[i:i + 1] = rng.choice([[], [t[i], rng.choice("xyz")], [rng.choice("xyzjs")]])
            if not t:
                t = ["a"]
        return "".join(t)

    rows = [[typo(rng.choice(targets)) for _ in range(rng.randrange(12))] for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, w array<string>")
    got = {r.i: r for r in df.select("i", Z.fuzzy_hits(F.col("w"), targets).alias("hits"),
                                     *[Z.best_close_word(F.col("w"), t).alias(t) for t in targets]).collect()}
    for i, ws in enumerate(rows):
        want = {t: get_close_matches(t, ws, n=1, cutoff=0.8) for t in targets}
        assert got[i].hits == [t for t in targets if want[t]]
        for t in targets:
            assert got[i][t] == (want[t][0] if want[t] else None), (t, ws)
