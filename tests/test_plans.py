"""The physical plans keep the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q(spark, sf_small):
    return lambda name: E.queries()[name](spark, sf_small)


def test_master_never_shuffles_the_fact_table_for_joins(spark, q):
    """With a threshold between the catalogue's and the transactions' size; without one the join does shuffle."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(100 << 10))
        plan = executed(q("transaction_master"))
        assert "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
        assert "Exchange hashpartitioning" not in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert "Exchange hashpartitioning" in executed(q("transaction_master"))
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_daily_totals_aggregate_before_the_shuffle(q):
    plan = executed(q("daily_quantity"))
    partial = plan.index("partial_sum")
    exchange = plan.index("Exchange hashpartitioning")
    assert exchange < partial  # printed top-down: the exchange sits above the partial aggregate


def test_top_items_limits_before_the_shuffle(q):
    plan = executed(q("top_items"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_arima_streams_series_from_one_sized_shuffle(q):
    plan = executed(q("arima_forecast"))
    assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan
    assert re.search(r"Exchange hashpartitioning\(branch#\d+, ite_desc_std#\d+, \d+\), REPARTITION_BY_NUM", plan)


def test_evaluation_reads_the_written_forecasts(q):
    assert "InPandas" not in executed(q("forecast_evaluation"))


def test_no_python_udf_in_cleaning(q):
    plan = executed(q("transaction_master"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
