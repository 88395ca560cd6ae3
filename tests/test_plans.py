"""Physical-plan properties: no cartesian / nested-loop joins, filters and
projections reach the parquet scan, fact table scanned once in the flagship."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NO_CROSS = ["strat_portfolio_return", "strat_lag_family", "reg_capm", "reg_did_2x2", "reg_nested_f", "text_tfidf",
            "agg_top_categories", "eval_leaf_multilabel", "cov_shrinkage", "dq_dispersion", "entry_exit_events",
            "survivors", "win_zscore_outliers", "corpus_stratified_sample", "eval_roc_auc"]


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_CROSS)
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_filters_pushed_to_scan(spark):
    p = _plan(spark, "src_regional_filter")
    assert "PushedFilters: [IsNotNull(c_nationkey), IsNotNull(c_mktsegment), EqualTo(c_nationkey,3)" in p \
        or ("EqualTo(c_nationkey,3)" in p and "EqualTo(c_mktsegment,BUILDING)" in p)
    assert "EqualTo(o_orderstatus,F)" in p


def test_projection_pruned(spark):
    p = _plan(spark, "dq_duplicate_lineitem_keys")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p


def test_flagship_reads_materialised_panel(spark):
    # the strategy plan reads the checkpointed panel, not the lineitem fact table
    p = _plan(spark, "strat_portfolio_return")
    assert "lineitem.parquet" not in p
