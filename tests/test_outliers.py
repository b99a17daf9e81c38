"""L3: IQR / z-score flags, seasonal median, cap."""

import datetime as dt

import pytest

from tillcast.operators import outliers


def series(spark, values, item="I"):
    rows = [("B", item, dt.date(2024, 1, 1) + dt.timedelta(days=i), None if v is None else float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity double")


def test_iqr_flags(spark):
    out = outliers.flag_anomalies(series(spark, [1, 2, 3, 4, 100, None]), "iqr", keep_stats=True)
    rows = out.orderBy("date").collect()
    assert [r.anomaly for r in rows] == [False, False, False, False, True, False]
    assert (rows[0].q1, rows[0].q3) == (2.0, 4.0)


def test_quartiles_interpolate_linearly(spark):
    out = outliers.iqr_flags(series(spark, [1, 2, 4, 9])).first()
    assert (out.q1, out.q3) == (1.75, 5.25)


def test_zscore_constant_and_single(spark):
    df = series(spark, [5, 5, 5], "c").unionByName(series(spark, [5], "s"))
    assert [r.anomaly for r in outliers.flag_anomalies(df, "z").collect()] == [False] * 4


def test_zscore_flags_far_value(spark):
    out = outliers.flag_anomalies(series(spark, [1, 1, 1, 1, 1, 1, 50]), "z", k=1.5)
    assert [r.anomaly for r in out.orderBy("date").collect()] == [False] * 6 + [True]


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        outliers.flag_anomalies(series(spark, [1.0]), "mad")


def test_cap_replaces_only_anomalies(spark):
    vals = [1, 2, 3, 4, 100, 2, 3]
    out = outliers.cap_outliers(series(spark, vals)).orderBy("date").collect()
    for r in out:
        if r.anomaly:
            assert r.quantity_cap == r.typical
        else:
            assert r.quantity_cap == r.quantity
    assert out[4].anomaly and out[4].quantity_cap == 3.0  # January median of all 7 values
    assert {r.dayofweek for r in out} == set(range(7))


def test_seasonal_median_pools_years(spark):
    rows = [("B", "I", dt.date(y, 3, d), float(v)) for y, d, v in [(2023, 1, 1), (2024, 1, 2), (2024, 2, 10), (2023, 2, 3)]]
    df = spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity double")
    out = outliers.seasonal_median(df).collect()
    assert [(r.month, r.typical) for r in out] == [(3, 2.5)]


def test_cap_is_one_shuffle(spark):
    df = series(spark, [1, 2, 3, 4, 100, 2, 3])
    plan = outliers.cap_outliers(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
