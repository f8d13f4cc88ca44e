"""Spark queries against their DuckDB oracle SQL on the smallest scale factor."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FAST = ["clean_postings", "hot_skills", "dedup_keep_first", "filter_domain", "parse_salary_text_a",
        "parse_salary_text_b", "parse_years", "clean_city_advanced", "skill_extract", "skill_extract_word",
        "enrich_all", "kpi_by_city", "salary_histogram", "salary_box_by_level", "balance_all",
        "frequent_itemsets_baskets", "association_rules", "recommend_from_rules", "html_blocks", "html_links",
        "train_test_split", "eval_regression", "incremental_new_only", "scan_feeds"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 20 and df.columns == ["skill", "demand_count", "demand_percentage", "avg_salary",
                                              "is_high_value"]


def test_registering_needs_no_session():
    import subprocess
    import sys

    from conftest import ROOT
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql()"], cwd=ROOT, check=True, timeout=120)


def test_every_query_has_a_callable_and_oracles_are_subset():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
