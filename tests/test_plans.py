"""Plan shape: no cross joins, no nested-loop joins, no Python row evaluation,
and column pruning at the Parquet scans."""

import pytest

from conftest import SF_SMALL
from hiresight.plans import catalog

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]
# model fits and file round trips execute eagerly and are covered elsewhere
SKIP = {"train_all", "train_linear", "train_forest", "train_gbt_xgb", "train_gbt_lgbm", "train_gbt",
        "feature_importance_topk", "predict_batch", "cluster_market", "cluster_scatter", "model_save_load"}


def _plan(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SKIP))
def test_plan_shape(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_fixture_scan_is_pruned(spark):
    df = catalog.queries()["parse_salary_text_a"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # orders: only the key columns this query needs are read (o_totalprice is pruned too)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "o_orderdate" not in plan and "c_acctbal" not in plan and "c_name" not in plan


def test_keep_first_aggregates_narrow_rows(spark):
    plan = _plan(catalog.queries()["dedup_keep_first"](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "min(" in plan
    assert "o_totalprice" not in plan and "Python, Django" not in plan  # no column that isn't asked for


def test_layers_are_scanned_pruned(spark):
    plan = _plan(catalog.queries()["hot_skills"](spark, SF_SMALL))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    read = {x.split("ReadSchema: ")[1] for x in scans}
    assert read <= {"struct<>", "struct<salary:double,skills:array<string>>"} and len(read) == 2


def test_split_scans_its_table_few_times(spark):
    """Once for the histogram and once for each side of the boundary bucket; of narrow rows."""
    plan = _plan(catalog.queries()["train_test_split"](spark, SF_SMALL))
    scans = {x[x.index("FileScan"):] for x in plan.splitlines() if "FileScan parquet" in x}
    assert all("ReadSchema: struct<post_id:bigint>" in x for x in scans)
    assert "Join" not in plan
