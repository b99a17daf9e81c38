"""L1/L2 semantics: null-safe joins, null groups, ties, semi join."""

import datetime as dt

from pyspark.sql import functions as F

from tillcast.operators import daily
from tillcast.operators.joins import equi_join


def test_null_key_join_matches_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(None, "x"), (1, "y")], "k int, r string")
    out = equi_join(left, right, ["k"], how="left").collect()
    assert sorted((r.l, r.r) for r in out) == [("a", "y"), ("b", "x")]
    plain = equi_join(left, right, ["k"], how="left", null_safe=False).collect()
    assert sorted((r.l, r.r) for r in plain) == [("a", "y"), ("b", None)]


def test_null_group_dropped_and_all_null_sum_is_zero(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [("B", "I", d, None), ("B", "I", d, None), ("B", None, d, 5.0), (None, "I", d, 1.0)],
        "branch string, ite_desc_std string, date date, quantity double",
    )
    out = daily.daily_totals(df).collect()
    assert [(r.branch, r.ite_desc_std, r.quantity) for r in out] == [("B", "I", 0.0)]


def test_top_n_ties_go_to_smaller_name(spark):
    df = spark.createDataFrame(
        [("A", "c", 2.0), ("A", "b", 3.0), ("A", "a", 2.0), ("Z", "q", 1.0)],
        "branch string, ite_desc_std string, quantity double",
    )
    out = daily.top_n_per_group(df, 2).orderBy("branch", "rank").collect()
    assert [(r.branch, r.ite_desc_std, r.rank) for r in out] == [("A", "b", 1), ("A", "a", 2), ("Z", "q", 1)]


def test_top_n_plan_limits_before_shuffle(spark):
    df = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("branch"),
        F.col("id").cast("string").alias("ite_desc_std"),
        F.col("id").cast("double").alias("quantity"),
    )
    plan = daily.top_n_per_group(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_daily_top_items_keeps_all_dates(spark):
    rows = []
    for item, q in [("x", 10.0), ("y", 1.0)]:
        rows.append(("B", item, dt.date(2023, 6, 1), q))
        rows.append(("B", item, dt.date(2020, 6, 1), 100.0))
    df = spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity double")
    out = daily.daily_top_items(df, 2023, 2024, 1).collect()
    assert sorted((r.ite_desc_std, r.date.year) for r in out) == [("x", 2020), ("x", 2023)]


def test_year_range_pushed_to_parquet(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.date(2023, 1, 1), 1.0), (dt.date(2020, 1, 1), 2.0)], "date date, quantity double"
    )
    path = str(tmp_path / "d")
    df.write.parquet(path)
    plan = daily.year_range(spark.read.parquet(path), 2023, 2024)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2023-01-01)" in plan
