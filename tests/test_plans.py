"""Plans the scale paths must not have."""

import importlib
import re

import pytest

from faultline import session
from faultline.plans import QUERIES

MODULES = [f"faultline.operators.{m}" for m in ("ordered", "knn", "impute", "tree", "features")]

# Ordered, joined and profiled queries: pure JVM plans.
NATIVE = [
    "daily_activity", "flt_row_numbers", "split_sequential", "split_stratified", "win_time_since_last", "win_gap_by_type",
    "win_rolling_rows", "win_rolling_days", "win_events_last", "win_sequences", "fill_forward", "join_asof_general",
    "join_combine_first", "join_incremental_anti", "join_patched_semi", "pipe_filter_and_fill", "pipe_patch_job",
    "agg_describe", "agg_percentile_grid", "agg_boxplot", "agg_histogram", "agg_daily", "prof_missing", "prof_sparsity",
    "pipe_event_features", "pipe_model_table", "feat_label_encode", "feat_hybrid_onehot", "ml_tree_root_split", "src_periods",
]
PYTHON_STEPS = ["imp_knn_gap", "agg_corr_matrix", "ml_ols", "pipe_training_table", "ml_test_report", "fc_recursive"]


@pytest.fixture
def plans(spark, sf, monkeypatch):
    """Plans of a query and of every table it writes on the way."""
    seen = []

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    original = session.written

    def spying(df, label="table"):
        seen.append(text(df))
        return original(df, label)

    for name in MODULES:
        module = importlib.import_module(name)
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", spying)

    def of(name):
        df = QUERIES[name](spark, sf)
        return seen + [text(df)]

    return of


@pytest.mark.parametrize("name", NATIVE + PYTHON_STEPS)
def test_no_global_windows_cross_joins_or_stray_python(plans, name):
    for plan in plans(name):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # A window without partition keys starts its specification with the order.
        assert not re.search(r"windowspecdefinition\([^,()]+ (ASC|DESC)", plan), plan
        assert name in PYTHON_STEPS or not re.search(r"Python|MapInArrow|MapInPandas", plan)


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = QUERIES["flt_time_range"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "user_id" not in plan and "props" not in plan


def test_hot_links_do_not_meet_rows_that_need_nothing(spark, sf):
    plan = QUERIES["pipe_filter_and_fill"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_worker_functions_carry_their_code():
    from pyspark import cloudpickle

    assert "faultline" in cloudpickle.list_registry_pickle_by_value()
