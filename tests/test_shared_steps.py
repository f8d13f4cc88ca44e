"""Steps that many queries share: lookups, word lists, combos, small samples."""

import re

import pytest
from conftest import one_col
from pyspark.sql import functions as F

from hiresight.functions.constants import IT_KEYWORDS, SKILL_COMBOS, VALID_IT_SKILLS
from hiresight.functions.parsing import clean_city, parse_years
from hiresight.functions.skills import slot_lookup
from hiresight.functions.text import contains_any, normalise_for_skills, normalise_words_only
from hiresight.operators.enrich import combo_flags
from hiresight.operators.rules import skill_matrix
from hiresight.operators.sampling import balance_all, flag_exact_global, sample_exact_global, whole_rows


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_slot_lookup_gives_each_key_its_own_values(spark):
    values = {"it's": ["a'b", "c\\d"], "py": [], "c++": ["c++"], **{f"k{i}": [f"v{i}", "x"] for i in range(300)}}
    got = one_col(spark, list(values), lambda c: slot_lookup(values)(F.col(c)))
    assert got == list(values.values())


def test_word_lists_as_a_trie_find_what_each_word_finds(spark):
    words = [*IT_KEYWORDS, "a.b", "[x]", "go lang"]
    texts = ["", "kotl", "cyber security", "axb", "a.b", "[x", "x [x] y", "gol", "phython", "đàn ai", "scikit learn", "c+", "pen"]
    assert one_col(spark, texts, lambda c: contains_any(F.col(c), words)) == [any(w in t for w in words) for t in texts]
    assert one_col(spark, ["", "x"], lambda c: contains_any(F.col(c), ["", "y"])) == [True, True]
    assert one_col(spark, ["", "x"], lambda c: contains_any(F.col(c), [])) == [False, False]


TEXTS = ["A  b\t\n-c", " !x! ", "C++ / C#, lập-trình", " a b", "_1 ½ ²", "", None, "a - - b", "\x0b\x0c!\r"]


@pytest.mark.parametrize("norm,keep", [(normalise_for_skills, "-"), (normalise_words_only, "")])
def test_normalising_in_one_pattern_is_the_two_steps(spark, norm, keep):
    def two_steps(c):
        x = F.regexp_replace(F.lower(F.col(c)), f"[^\\p{{L}}\\p{{N}}_\\s{keep}]", " ")
        return F.regexp_replace(x, "\\s+", " ")

    assert one_col(spark, TEXTS, lambda c: norm(c)) == one_col(spark, TEXTS, two_steps)


def test_years_and_cities_lower_their_text_once(spark):
    df = spark.createDataFrame([("Senior 3",)], "x string")
    for f in (parse_years, clean_city):
        assert len(re.findall(r"lower\(", plan(df.select(f("x").alias("y"))).split("== Optimized")[1].split("== Physical")[0])) == 1
    assert one_col(spark, [None, "", " ", "2.5 years", "1 - 3", "Junior, Middle", "x"], parse_years)[:5] == [2.0, 2.0, 2.0, 2.5, 2.0]


def test_combos_hold_with_null_skills(spark):
    name, combo = next((n, c) for n, c in SKILL_COMBOS if all(s in VALID_IT_SKILLS for s in c))
    rows = [list(combo), list(combo)[1:], [], None, [None, *combo], [None]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, skills array<string>")
    got = [r[f"combo_{name}"] for r in df.select("i", *combo_flags(F.col("skills"))).orderBy("i").collect()]
    assert got == [1, 0, 0, None, 1, 0]
    assert "array_except" not in plan(df.select(*combo_flags(F.col("skills"))))


@pytest.mark.parametrize("n", [0, 1, 40, 1000])
def test_a_small_sample_is_a_top_k_of_the_same_rows(spark, n):
    df = spark.range(500).select(F.col("id").alias("post_id"), (F.col("id") * 2).alias("v")).repartition(7)
    got = sample_exact_global(df, count=n)
    assert "Window" not in plan(got)
    flagged = flag_exact_global(df, count=n, flag="_in").where("_in = 1").drop("_in")
    assert sorted(got.collect()) == sorted(flagged.collect()) and got.count() == min(n, 500)


def test_whole_rows_takes_as_many_of_equal_rows_as_were_chosen(spark):
    rows = [(1, "a", 1.0, "x"), (1, "a", 1.0, "y"), (1, "a", 1.0, "z"), (2, "a", None, "u"), (None, "a", 2.0, "v"), (None, "b", 2.0, "w"), (3, "a", 9.0, "t")]
    df = spark.createDataFrame(rows, "post_id long, level string, salary double, text string").repartition(3)
    chosen = spark.createDataFrame([(1, "a", 1.0)] * 2 + [(2, "a", None), (None, "a", 2.0)], "post_id long, level string, salary double")
    got = sorted(r.text for r in whole_rows(df, chosen, ["post_id", "level", "salary"]).collect())
    assert len(got) == 4 and got[:2] == ["u", "v"] and set(got[2:]) < {"x", "y", "z"}


def test_balancing_writes_no_whole_rows_of_those_not_drawn(spark, monkeypatch):
    """Rows of each level, salary and text; only ids, classes, salaries and buckets may be written for all of them."""
    from hiresight import session
    df = spark.range(4000).selectExpr("id AS post_id", "CASE id % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Middle' ELSE 'Expert' END AS level",
                                      "CAST(6 + id % 60 AS DOUBLE) AS salary", "'Hanoi' AS city", "CAST(id AS STRING) AS description")
    written, plain = [], session.materialise
    monkeypatch.setattr(session, "materialise", lambda d, *a: written.append(plain(d, *a)) or written[-1])
    out = balance_all(df)
    assert all(w.count() <= 1800 for w in written if "description" in w.columns) and any(w.count() == 4000 for w in written)
    got = out.collect()
    assert len(got) == 1800 and all(r.description == str(r.post_id) for r in got)


def test_baskets_without_an_interpreted_sort(spark):
    df = spark.createDataFrame([(["sql", "b", "aws", "sql", None],), ([],), (None,)], "skills array<string>")
    m = skill_matrix(df, ["sql", "aws", "sql", "git"])
    assert [r.items_ for r in m.withColumnRenamed("items", "items_").collect()] == [["aws", "sql"], [], None]
    assert "lambdafunction" not in plan(m)
