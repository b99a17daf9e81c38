"""L4: train/test cut, calendar, metrics and the per-series ARIMA."""

import datetime as dt

import numpy as np
import pytest

from tillcast.operators import arima, forecast


def gapless(spark, start, n, values=None, item="I"):
    values = values if values is not None else [float(i % 7) for i in range(n)]
    rows = [("B", item, start + dt.timedelta(days=i), float(values[i])) for i in range(n)]
    return spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity_cap double")


def test_reference_test_cut(spark):
    df = gapless(spark, dt.date(2024, 3, 30), 40)
    out = forecast.train_test_cut(df, dt.date(2024, 3, 31), 30).collect()
    test = sorted(r.date for r in out if r.part == "test")
    train = sorted(r.date for r in out if r.part == "train")
    assert test[0] == dt.date(2024, 3, 31) and test[-1] == dt.date(2024, 4, 29) and len(test) == 30
    assert train[-1] == dt.date(2024, 3, 31)


def test_days_test_cut(spark):
    df = gapless(spark, dt.date(2024, 3, 30), 40)
    out = forecast.train_test_cut(df, dt.date(2024, 3, 31), 30, eval_mode="days").collect()
    test = sorted(r.date for r in out if r.part == "test")
    assert test[0] == dt.date(2024, 4, 1) and test[-1] == dt.date(2024, 4, 30)


def test_calendar_modes(spark):
    df = gapless(spark, dt.date(2024, 3, 1), 20)  # last training date 2024-03-20
    a = forecast.forecast_calendar(df, dt.date(2024, 3, 31), 30, "train_end").collect()
    b = forecast.forecast_calendar(df, dt.date(2024, 3, 31), 30, "last_date").collect()
    assert min(r.date for r in a) == dt.date(2024, 4, 1) and len(a) == 30
    assert min(r.date for r in b) == dt.date(2024, 3, 21) and max(r.step for r in b) == 30


def test_lags_per_series(spark):
    df = gapless(spark, dt.date(2024, 1, 1), 5, [1.0, 2, 3, 4, 5], "a").unionByName(
        gapless(spark, dt.date(2024, 1, 1), 3, [9.0, 8, 7], "b")
    )
    out = forecast.lag_features(df, "quantity_cap", [1, 2]).orderBy("ite_desc_std", "date").collect()
    assert [r.quantity_cap_lag1 for r in out] == [None, 1, 2, 3, 4, None, 9, 8]
    assert [r.quantity_cap_lag2 for r in out][5:] == [None, None, 9]


def test_metrics(spark):
    d = dt.date(2024, 1, 1)
    act = spark.createDataFrame([("B", "I", d, 2.0), ("B", "I", d + dt.timedelta(1), 0.0)],
                                "branch string, ite_desc_std string, date date, y double")
    pred = spark.createDataFrame([("B", "I", d, 1.0), ("B", "I", d + dt.timedelta(1), 1.0)],
                                 "branch string, ite_desc_std string, date date, forecast double")
    m = forecast.forecast_metrics(act, pred, "y").first()
    assert m.mae == 1.0 and m.n == 2
    mm = forecast.masked_metrics(act, pred, "y", threshold=0.5).first()
    assert (mm.mae, mm.mape, mm.rmse, mm.n) == (1.0, 0.5, 1.0, 1)
    none = forecast.masked_metrics(act, pred, "y", threshold=10).first()
    assert none.mae is None and none.n == 0


# ---------------------------------------------------------------- the estimator
def dense_neg_loglik(w, phi, theta):
    """n ln(S/n) + ln det(G) via the exact ARMA(1,1) autocovariance matrix."""
    n = len(w)
    g0 = (1 + 2 * theta * phi + theta**2) / (1 - phi**2)
    g1 = (1 + theta * phi) * (phi + theta) / (1 - phi**2)
    gam = np.zeros(n)
    gam[0] = g0
    if n > 1:
        gam[1] = g1
    for k in range(2, n):
        gam[k] = phi * gam[k - 1]
    G = np.array([[gam[abs(i - j)] for j in range(n)] for i in range(n)])
    s = w @ np.linalg.solve(G, w)
    return n * np.log(s / n) + np.linalg.slogdet(G)[1]


def simulate(phi, theta, n, seed=0):
    rng = np.random.default_rng(seed)
    z = rng.normal(size=n + 200)
    w = np.zeros(n + 200)
    for t in range(1, n + 200):
        w[t] = phi * w[t - 1] + z[t] + theta * z[t - 1]
    return w[200:]


def test_recursion_equals_dense_likelihood():
    w = simulate(0.5, 0.3, 30, seed=1)
    for phi, theta in [(0.5, 0.3), (-0.4, 0.7), (0.9, -0.2)]:
        rec = arima.neg_profile_loglik(w, np.array([phi]), np.array([theta]))[0]
        assert abs(rec - dense_neg_loglik(w, phi, theta)) < 1e-9


def test_recovers_parameters():
    w = simulate(0.6, 0.3, 800, seed=3)
    phi, theta = arima.fit_arma11(w, True, True)
    assert abs(phi - 0.6) < 0.12 and abs(theta - 0.3) < 0.12


def test_hand_worked_forecast():
    y = np.array([10.0, 12.0, 11.0, 13.0, 12.0])
    w = np.diff(y)
    phi, theta = 0.5, 0.2
    x1 = arima.one_step_state(w, phi, theta)
    steps = x1 * phi ** np.arange(3)
    assert np.allclose(y[-1] + np.cumsum(steps), [12 + x1, 12 + x1 * 1.5, 12 + x1 * 1.75])


def test_flat_for_short_or_constant():
    vals, status, *_ = arima.forecast_values(np.array([3.0, 4.0]), 5)
    assert status == "flat" and list(vals) == [4.0] * 5
    vals, status, *_ = arima.forecast_values(np.array([2.0] * 10), 3)
    assert status == "flat" and list(vals) == [2.0] * 3


def test_unsupported_order():
    assert arima.check_order((2, 1, 1)) == (2, 1, 1)
    for bad in [(4, 1, 1), (1, 3, 1), (1, 1, 4), (-1, 0, 0)]:
        with pytest.raises(ValueError):
            arima.check_order(bad)


def test_arima_job_rows_and_partition_independence(spark):
    rng = np.random.default_rng(7)
    a = list(np.cumsum(rng.normal(size=60)) + 50)
    b = list(np.cumsum(rng.normal(size=45)) + 20)
    df = gapless(spark, dt.date(2024, 1, 1), 60, a, "a").unionByName(
        gapless(spark, dt.date(2024, 1, 20), 45, b, "b")
    ).unionByName(gapless(spark, dt.date(2024, 5, 1), 5, [1.0] * 5, "late"))
    end = dt.date(2024, 2, 29)
    f1 = forecast.arima_forecast(df, end, 31, "quantity_cap")
    f2 = forecast.arima_forecast(df.repartition(7), end, 31, "quantity_cap")
    r1 = sorted((r.ite_desc_std, r.date, r.forecast) for r in f1.collect())
    r2 = sorted((r.ite_desc_std, r.date, r.forecast) for r in f2.collect())
    assert r1 == r2
    per = {}
    for item, d, _ in r1:
        per.setdefault(item, []).append(d)
    assert set(per) == {"a", "b"}  # 'late' has no training rows
    assert all(len(v) == 31 and min(v) == dt.date(2024, 3, 1) for v in per.values())


def test_l4_composition(spark):
    from tillcast.config import ForecastConfig
    from tillcast.plans.compositions import forecast_and_evaluate

    rng = np.random.default_rng(11)
    vals = list(np.cumsum(rng.normal(size=90)) + 40)
    df = gapless(spark, dt.date(2024, 1, 1), 90, vals)
    fc, ev = forecast_and_evaluate(df, ForecastConfig(train_end=dt.date(2024, 2, 29)))
    assert fc.count() == 31
    row = ev.first()
    # horizon 31 (02-29 is a month end): test rows 02-29 .. 03-30, forecasts from 03-01 -> 30 pairs
    assert row.n == 30 and row.mae >= 0


def test_kalman_equals_innovations_for_arma11():
    w = simulate(0.5, 0.3, 60, seed=5)
    n = np.array([len(w)])
    for phi, theta in [(0.5, 0.3), (-0.6, 0.2), (0.2, -0.7)]:
        inn = arima.neg_profile_loglik(w, np.array([phi]), np.array([theta]))[0]
        kal, _, _ = arima.kalman_negloglik_many(
            w[None, :], n, np.array([[[phi]]]), np.array([[[theta]]])
        )
        assert abs(kal[0, 0] - inn) < 1e-8


def test_recovers_ar2():
    rng = np.random.default_rng(9)
    z = rng.normal(size=900)
    w = np.zeros(900)
    for t in range(2, 900):
        w[t] = 0.5 * w[t - 1] + 0.3 * w[t - 2] + z[t]
    w = w[200:]
    phi, theta = arima.fit_arma_many(w[None, :], np.array([len(w)]), 2, 0)
    assert abs(phi[0, 0] - 0.5) < 0.1 and abs(phi[0, 1] - 0.3) < 0.1 and theta.shape == (1, 0)


def test_second_difference_integrates_twice():
    # (0, 2, 0) has no constant: the last first difference (29^2 - 28^2 = 57) carries on
    y = np.array([float(t * t) for t in range(30)])
    vals, status, *_ = arima.forecast_values(y + np.sin(np.arange(30)) * 1e-3, 3, (0, 2, 0))
    assert status == "ok"
    assert np.allclose(vals, [841 + 57, 841 + 2 * 57, 841 + 3 * 57], atol=0.05)


def test_general_order_runs_in_the_job(spark):
    rng = np.random.default_rng(4)
    vals = list(np.cumsum(rng.normal(size=80)) + 30)
    df = gapless(spark, dt.date(2024, 1, 1), 80, vals)
    out = forecast.arima_forecast(df, dt.date(2024, 2, 29), 31, "quantity_cap", order=(2, 1, 2)).collect()
    assert len(out) == 31 and all(r.status == "ok" and np.isfinite(r.forecast) for r in out)
    with pytest.raises(ValueError):
        forecast.arima_forecast(df, dt.date(2024, 2, 29), 31, "quantity_cap", order=(4, 1, 0))


def test_arima_query_matches_brute_force_on_small_fixture(spark, sf_small):
    """The Spark job equals fitting each series one by one on the driver."""
    import __spark_entry__ as E
    from tillcast.config import FIXTURE
    from tillcast.plans import compositions as L
    from tillcast.sources.fixtures import retail_inputs

    got = {
        (r.branch, r.ite_desc_std, r.date): r.forecast
        for r in E.queries()["arima_forecast"](spark, sf_small).collect()
    }
    series = L.forecast_series(retail_inputs(spark, sf_small), FIXTURE).toPandas()
    train = series[series["date"] <= FIXTURE.train_end].sort_values("date")
    h = forecast.horizon_for(FIXTURE.train_end)
    want = {}
    for (b, item), g in train.groupby(["branch", "ite_desc_std"]):
        vals, *_ = arima.forecast_values(g["quantity_cap"].to_numpy(float), h, FIXTURE.arima_order)
        for i, v in enumerate(vals):
            want[(b, item, FIXTURE.train_end + dt.timedelta(days=i + 1))] = v
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_forecast_evaluation_matches_brute_force_on_small_fixture(spark, sf_small):
    import __spark_entry__ as E
    from tillcast.config import FIXTURE
    from tillcast.plans import compositions as L
    from tillcast.sources.fixtures import retail_inputs

    got = {(r.branch, r.ite_desc_std): (r.mae, r.mape, r.n)
           for r in E.queries()["forecast_evaluation"](spark, sf_small).collect()}
    series = L.forecast_series(retail_inputs(spark, sf_small), FIXTURE).toPandas().sort_values("date")
    end, h = FIXTURE.train_end, forecast.horizon_for(FIXTURE.train_end)
    want = {}
    for (b, item), g in series.groupby(["branch", "ite_desc_std"]):
        train = g[g["date"] <= end]
        if train.empty:
            continue
        vals, status, *_ = arima.forecast_values(train["quantity_cap"].to_numpy(float), h, FIXTURE.arima_order)
        if status != "ok":
            continue
        fc = {end + dt.timedelta(days=i + 1): v for i, v in enumerate(vals)}
        test = g[g["date"] >= end].head(h)  # D6: first h rows from train_end on
        pairs = [(y, fc[d]) for d, y in zip(test["date"], test["quantity_cap"]) if d in fc]
        if not pairs:
            continue
        y = np.array([p[0] for p in pairs])
        f = np.array([p[1] for p in pairs])
        err = np.abs(y - f)
        want[(b, item)] = (err.mean(), (err / np.maximum(np.abs(y), 2.220446049250313e-16)).mean() * 100, len(pairs))
    assert set(got) == set(want)
    for k, (mae, mape, n) in want.items():
        assert got[k][2] == n and abs(got[k][0] - mae) < 1e-6
        assert abs(got[k][1] - mape) <= 1e-6 * max(1.0, abs(mape))


def many_series(spark, n, days=20):
    from pyspark.sql import functions as F

    rows = spark.range(n).withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    return rows.select(
        F.concat(F.lit("B"), (F.col("id") % 5).cast("string")).alias("branch"),
        F.concat(F.lit("item"), F.col("id").cast("string")).alias("ite_desc_std"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("date"),
        (F.sin(F.col("id") + F.col("d") * F.col("d")) + F.col("d")).alias("quantity_cap"),
    )


def test_every_task_gets_its_share_of_series(spark):
    from pyspark.sql import functions as F

    fc = forecast.arima_forecast(many_series(spark, 200), dt.date(2024, 1, 31), 2, "quantity_cap", num_partitions=8)
    per = [r["n"] for r in fc.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("ite_desc_std").alias("n")).collect()]
    assert sum(per) == 200 and len(per) == 8 and max(per) <= 2 * 200 / 8


def test_a_poisoned_series_leaves_the_others_unchanged(spark, monkeypatch):
    from pyspark.sql import functions as F

    clean = many_series(spark, 12)
    bad = clean.withColumn("quantity_cap", F.when(F.col("ite_desc_std") == "item3", F.lit(float("inf"))).otherwise(F.col("quantity_cap")))
    run = lambda df: {
        (r.ite_desc_std, r.date): (r.forecast, r.status)
        for r in forecast.arima_forecast(df, dt.date(2024, 1, 31), 3, "quantity_cap", num_partitions=2).collect()
    }
    a, b = run(clean), run(bad)
    assert all(a[k] == b[k] for k in a if k[0] != "item3")
    assert {b[k][1] for k in b if k[0] == "item3"} == {"failed"}


def test_null_keys_and_key_types_are_kept(spark):
    rows = [(None, dt.date(2024, 1, d), float(d % 3)) for d in range(1, 15)]
    rows += [(7, dt.date(2024, 1, d), float(d % 4)) for d in range(1, 15)]
    df = spark.createDataFrame(rows, "k int, date date, v double")
    fc = forecast.arima_forecast(df, dt.date(2024, 1, 31), 2, "v", keys=["k"], num_partitions=3)
    assert dict(fc.dtypes)["k"] == "int"
    assert sorted(((r.k or 0), r.status) for r in fc.collect()) == [(0, "ok")] * 2 + [(7, "ok")] * 2
    assert forecast.arima_forecast(df.where("k = 99"), dt.date(2024, 1, 31), 2, "v", keys=["k"]).count() == 0


def test_score_recursion_equals_differences():
    rng = np.random.default_rng(2)
    w = np.zeros((3, 60))
    n = np.array([60, 41, 7])
    for i, k in enumerate(n):
        w[i, :k] = rng.normal(size=k)
    phi, theta = rng.uniform(-0.9, 0.9, (3, 4)), rng.uniform(-0.9, 0.9, (3, 4))
    by_phi, by_theta = arima.score_many(w, n, phi, theta)
    h = 1e-6
    for got, dp, dt_ in ((by_phi, h, 0.0), (by_theta, 0.0, h)):
        f = [arima.neg_profile_loglik_many(w, n, phi + s * dp, theta + s * dt_) for s in (1, -1)]
        assert np.allclose(got, (f[0] - f[1]) / (2 * h), rtol=1e-5, atol=1e-4)


def test_newton_steps_reach_a_stationary_point():
    rng = np.random.default_rng(7)
    n = np.array([400, 300, 200, 90, 40])
    w = np.zeros((5, 400))
    for i, (k, p, t) in enumerate(zip(n, (0.6, -0.4, 0.2, 0.8, 0.0), (0.3, 0.5, -0.6, 0.1, 0.7))):
        z = rng.normal(size=k + 1)
        for j in range(k):
            w[i, j] = p * (w[i, j - 1] if j else 0.0) + z[j + 1] + t * z[j]
    start = np.zeros(5), np.zeros(5)
    phi, theta = arima.newton_steps(w, n, *start, True, True)
    best = arima.neg_profile_loglik_many(w, n, phi[:, None], theta[:, None])[:, 0]
    grid_phi, grid_theta = arima.fit_arma11_many(w, n, True, True)
    on_grid = arima.neg_profile_loglik_many(w, n, grid_phi[:, None], grid_theta[:, None])[:, 0]
    assert (best <= arima.neg_profile_loglik_many(w, n, *(s[:, None] for s in start))[:, 0] + 1e-12).all()
    inside = (np.abs(grid_phi) < 0.98) & (np.abs(grid_theta) < 0.98)
    scores = np.stack(arima.score_many(w, n, grid_phi[:, None], grid_theta[:, None]))[:, :, 0]
    assert inside.sum() >= 3 and (np.abs(scores[:, inside]) < 1e-4).all() and (on_grid <= best + 1e-6).all()
    only = arima.newton_steps(w, n, *start, True, False)
    assert not only[1].any() and np.abs(only[0]).max() > 0.1


def test_certificate_tells_a_fit_from_a_miss(spark):
    rng = np.random.default_rng(9)
    z = rng.normal(size=301)
    w = np.zeros(300)
    for j in range(300):
        w[j] = 0.5 * (w[j - 1] if j else 0.0) + z[j + 1] + 0.3 * z[j]
    y = np.concatenate([[10.0], 10.0 + np.cumsum(w)])
    start = dt.date(2023, 1, 1)
    rows = [("B1", k, start + dt.timedelta(days=i), float(v)) for k in (None, "X") for i, v in enumerate(y)]
    series = spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity_cap double")
    end = dt.date(2024, 6, 30)
    fits = forecast.arima_forecast(series, end, 3, "quantity_cap")
    told = forecast.certify_arma11(series, fits, end, "quantity_cap", [-0.5, 0.0, 0.5]).collect()
    assert len(told) == 2 and all(r.beats_grid and r.better_neighbours == 0 and r.n_diffs == 300 for r in told)
    grid = np.array([[p, t] for p in (-0.5, 0.0, 0.5) for t in (-0.5, 0.0, 0.5)])
    want = arima.neg_profile_loglik(w, grid[:, 0], grid[:, 1]).min()
    assert told[0].grid_best == pytest.approx(want, abs=1e-6)
    off = fits.selectExpr("branch", "ite_desc_std", "date", "forecast", "status", "-0.2D as phi", "0.1D as theta")
    missed = forecast.certify_arma11(series, off, end, "quantity_cap", [-0.5, 0.0, 0.5]).collect()
    assert not any(r.beats_grid for r in missed) and all(r.better_neighbours > 0 for r in missed)
