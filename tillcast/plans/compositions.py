"""Compositions L1-L5 over the retail inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillcast.config import RunParams
from tillcast.operators import clean, daily
from tillcast.session import materialize
from tillcast.sources.fixtures import RetailInputs


def product_master(inp: RetailInputs, p: RunParams) -> DataFrame:
    return clean.product_master(
        inp.products,
        inp.departments,
        inp.item_map,
        inp.dept_map,
        p.override_rules,
        p.null_safe,
    )


def transaction_master(inp: RetailInputs, p: RunParams) -> DataFrame:
    """L1."""
    return clean.transaction_master(
        inp.transactions,
        inp.products,
        inp.departments,
        inp.item_map,
        inp.dept_map,
        p.override_rules,
        p.null_safe,
    )


def daily_quantity(inp: RetailInputs, p: RunParams) -> DataFrame:
    return daily.daily_totals(transaction_master(inp, p))


def daily_top_items(inp: RetailInputs, p: RunParams) -> DataFrame:
    """L2. ``daily`` feeds both the item choice and the semi join, so it is
    written once to the checkpoint folder: otherwise the year filter is
    pushed below one copy of the aggregate and the fact table is scanned
    twice. Daily totals are far smaller than the transactions."""
    d = materialize(daily_quantity(inp, p), "daily")
    return daily.daily_top_items(d, p.start_year, p.end_year, p.top_n)


def capped_daily(inp: RetailInputs, p: RunParams, years: bool = True) -> DataFrame:
    """L3 on the daily top items; ``years`` applies the run's year range
    (the notebook default), otherwise all dates are kept."""
    from tillcast.operators.outliers import cap_outliers

    base = daily_top_items(inp, p)
    if years:
        return cap_outliers(base, k=p.iqr_k, start_year=p.start_year, end_year=p.end_year)
    return cap_outliers(base, k=p.iqr_k)


def forecast_series(inp: RetailInputs, p: RunParams, write: bool = False) -> DataFrame:
    """The capped series the forecaster works on: (branch, item, date, quantity_cap).

    ``write=True`` stores it in the checkpoint folder first, for callers
    that read it more than once (fit and score)."""
    s = capped_daily(inp, p, years=False).select("branch", "ite_desc_std", "date", "quantity_cap")
    return materialize(s, "series") if write else s


ML_KEYS = ("l_orderkey", "l_linenumber")
ML_STRINGS = ("p_type", "p_brand", "l_returnflag")
ML_NUMBERS = ("p_size", "l_quantity")


def ml_frame(tables: dict[str, DataFrame]) -> DataFrame:
    """Tabular regression input: item attributes -> extended price."""
    from pyspark.sql import functions as F

    li, part = tables["lineitem"], tables["part"]
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey",
        "l_linenumber",
        "p_type",
        "p_brand",
        "l_returnflag",
        F.col("p_size").cast("double").alias("p_size"),
        "l_quantity",
        F.col("l_extendedprice").alias("target"),
    )


def forecasts(series: DataFrame, cfg, horizon: int, coefficients: tuple[float, float] | None = None) -> DataFrame:
    """T3 for one run configuration."""
    from tillcast.operators import forecast

    return forecast.arima_forecast(
        series,
        cfg.train_end,
        horizon,
        cfg.quant_col,
        cfg.order,
        cfg.start_mode,
        cfg.keys,
        cfg.date_col,
        coefficients=coefficients,
    )


def evaluation(series: DataFrame, fc: DataFrame, cfg, horizon: int) -> DataFrame:
    """Written forecasts against the test part. Series that were
    not fitted (flat, failed) are left out, as a failed series is."""
    from pyspark.sql import functions as F

    from tillcast.operators import forecast

    cut = forecast.train_test_cut(series, cfg.train_end, horizon, cfg.keys, cfg.date_col, cfg.eval_mode)
    test = cut.where(F.col("part") == "test")
    return forecast.forecast_metrics(
        test, forecast.scored_only(fc), cfg.quant_col, keys=cfg.keys, date_col=cfg.date_col
    )


def forecast_and_evaluate(
    series: DataFrame, cfg, coefficients: tuple[float, float] | None = None
) -> tuple[DataFrame, DataFrame]:
    """L4: T1 -> T3 -> T4. Returns (forecasts, evaluation); the forecasts are
    written, so a series is fitted once. ``series`` is read twice (fit and
    score); pass a written table."""
    from tillcast.operators import forecast

    h = forecast.horizon_for(cfg.train_end)
    fc = materialize(forecasts(series, cfg, h, coefficients), "forecasts")
    return fc, evaluation(series, fc, cfg, h)


def train_predict_report(
    frame: DataFrame,
    keys,
    strings,
    numbers,
    p: RunParams,
    target: str = "target",
    algorithm: str = "gbt",
    inputs: tuple[DataFrame, ...] = (),
) -> dict:
    """M2 -> M1 (fit on train only) -> M3 -> M4 -> M5, M6, A12.

    Returns a dict of the fitted model and the result frames (lazy; the
    A12 report is built on request from ``scored``). The encoded frame is
    written once, dealt evenly by its keys: training reads it many times, as
    many tasks at a time as the session sets, whatever files it came from.

    ``inputs``: the tables that ``frame`` reads. With them the fitted model is
    published under the checkpoint folder and the next caller with the same
    files and parameters loads it.
    """
    from pyspark.sql import functions as F

    from tillcast.operators import ml

    ml.require_target(frame, target)
    data, features = encoded_frame(frame, keys, strings, numbers, p)
    fit = lambda: ml.train_gbt(data.where(~F.col("is_test")), features, target, algorithm, p.n_trees, p.seed)
    if inputs:
        told = (algorithm, p.n_trees, p.seed, p.test_fraction, target, features, list(keys))
        model = ml.fitted_once(f"l5-{ml.fingerprint(inputs, *told)}", fit)
    else:
        model = fit()
    scored = model.transform(data).withColumn(
        "dataset", F.when(F.col("is_test"), "test").otherwise("train")
    )
    return {
        "model": model,
        "data": data,
        "features": features,
        "predictions": scored.where(F.col("is_test")).select(*keys, target, "prediction"),
        "scores": ml.regression_scores(scored, target, "dataset").withColumns(
            {"n_estimators": F.lit(p.n_trees), "random_state": F.lit(p.seed)}
        ),
        # the quality report (A12) writes ranked errors for its quantiles, so it
        # is built on request: ml.regression_report(out["scored"], target, "prediction", "dataset")
        "scored": scored,
    }


def encoded_frame(frame: DataFrame, keys, strings, numbers, p: RunParams) -> tuple[DataFrame, list[str]]:
    """M2, M1: the written frame with ``is_test`` and codes fitted on the training part, and
    the names of its features."""
    from pyspark.sql import functions as F

    from tillcast.operators import ml

    split = ml.hash_split(frame, keys, p.test_fraction, p.seed)
    enc = ml.fit_label_encoder(split.where(~F.col("is_test")), strings)
    encoded = ml.apply_label_encoder(split, enc, strings)
    spread = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = materialize(encoded.repartition(spread, *keys), "ml-encoded")
    return data, [f"{c}_idx" for c in strings] + list(numbers)
