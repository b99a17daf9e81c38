"""L4: forecast horizon, train/test cut, per-series ARIMA and its scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import DATE_COL, SERIES_KEYS
from tillcast.functions import metrics as M
from tillcast.functions import scalar as S
from tillcast.operators import arima
from tillcast.session import ship_package
from tillcast.sources.files import within

START_MODES = ("train_end", "last_date")
EVAL_MODES = ("reference", "days")


def horizon_for(train_end: dt.date) -> int:
    """T1 on the driver for one parameter date (same rule as ``horizon_days``)."""
    nxt = train_end + dt.timedelta(days=1)
    first_next = dt.date(nxt.year + (nxt.month == 12), nxt.month % 12 + 1, 1)
    return (first_next - dt.timedelta(days=1) - train_end).days


def horizons(dates: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """T1 for every distinct date of a table: (train_end, horizon)."""
    return (
        dates.where(F.col(date_col).isNotNull())
        .select(F.col(date_col).alias("train_end"))
        .distinct()
        .withColumn("horizon", S.horizon_days("train_end").cast("int"))
    )


def forecast_calendar(
    series: DataFrame,
    train_end: dt.date,
    horizon: int,
    start_mode: str = "train_end",
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
) -> DataFrame:
    """``horizon`` daily dates per series that has training rows.

    ``start_mode='train_end'`` starts the day after ``train_end``;
    ``'last_date'`` the day after the series' last training date.
    """
    if start_mode not in START_MODES:
        raise ValueError(f"start_mode must be one of {START_MODES}")
    last = (
        series.where(F.col(date_col) <= F.lit(train_end))
        .groupBy(*keys)
        .agg(F.max(date_col).alias("last_date"))
    )
    base = F.col("last_date") if start_mode == "last_date" else F.lit(train_end)
    start = F.date_add(base, 1)
    return last.select(
        *keys,
        "last_date",
        F.explode(F.sequence(start, F.date_add(start, horizon - 1))).alias(date_col),
    ).withColumn("step", (F.datediff(F.col(date_col), F.date_add(base, 1)) + 1).cast("int"))


def train_test_cut(
    series: DataFrame,
    train_end: dt.date,
    horizon: int,
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
    eval_mode: str = "reference",
) -> DataFrame:
    """Label rows 'train' / 'test' in a ``part`` column.

    ``reference``: train = date <= end, test = the first ``horizon`` rows
    with date >= end (so ``train_end`` is in both parts).
    ``days``: test = end < date <= end + horizon.
    One window per series; rows are duplicated only where they belong to
    both parts.
    """
    if eval_mode not in EVAL_MODES:
        raise ValueError(f"eval_mode must be one of {EVAL_MODES}")
    d, end = F.col(date_col), F.lit(train_end)
    if eval_mode == "reference":
        w = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
        n_test = F.sum(F.when(d >= end, 1).otherwise(0)).over(w)
        is_test = (d >= end) & (n_test <= horizon)
    else:
        is_test = (d > end) & (d <= F.date_add(end, horizon))
    parts = F.array(F.when(d <= end, F.lit("train")), F.when(is_test, F.lit("test")))
    return (
        series.withColumn("_parts", F.filter(parts, lambda x: x.isNotNull()))
        .withColumn("part", F.explode("_parts"))
        .drop("_parts")
    )


def lag_features(
    series: DataFrame,
    value: str,
    lags: Sequence[int],
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
) -> DataFrame:
    """``{value}_lag{n}`` per series in date order."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    return series.withColumns({f"{value}_lag{n}": F.lag(value, n).over(w) for n in lags})


def series_difference(
    series: DataFrame,
    value: str,
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
) -> DataFrame:
    """First difference ``y_t - y_{t-1}`` per series."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    return series.withColumn(f"{value}_diff", F.col(value) - F.lag(value, 1).over(w))


def forecast_metrics(
    actual: DataFrame,
    predicted: DataFrame,
    value: str,
    forecast: str = "forecast",
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
    digits: int | None = 6,
) -> DataFrame:
    """Pair actuals and forecasts by date, then MAE and MAPE (%) per
    series. Series with no pair are left out."""
    keys = list(keys)
    pairs = actual.select(*keys, date_col, value).join(
        predicted.select(*keys, date_col, forecast), on=[*keys, date_col], how="inner"
    ).dropna(subset=[value, forecast])
    y, p = F.col(value), F.col(forecast)
    out = pairs.groupBy(*keys).agg(
        M.mae(y, p).alias("mae"), M.mape(y, p).alias("mape"), F.count(F.lit(1)).alias("n")
    )
    return _sig(_round(out, ["mae"], digits), ["mape"], digits)


def masked_metrics(
    actual: DataFrame,
    predicted: DataFrame,
    value: str,
    threshold: float,
    forecast: str = "forecast",
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
    digits: int | None = 6,
) -> DataFrame:
    """MAE, MAPE (a fraction) and RMSE over pairs with
    ``|actual| > threshold``; a series with no such pair gets nulls."""
    keys = list(keys)
    pairs = actual.select(*keys, date_col, value).join(
        predicted.select(*keys, date_col, forecast), on=[*keys, date_col], how="inner"
    ).dropna(subset=[value, forecast])
    y, p = F.col(value), F.col(forecast)
    keep = F.abs(y) > F.lit(threshold)
    err = F.when(keep, F.abs(y - p))
    out = pairs.groupBy(*keys).agg(
        F.avg(err).alias("mae"),
        F.avg(F.when(keep, F.abs(y - p) / F.greatest(F.abs(y), F.lit(M.MAPE_EPS)))).alias("mape"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.when(keep, 1)).alias("n"),
    )
    return _sig(_round(out, ["mae", "rmse"], digits), ["mape"], digits)


def _round(df: DataFrame, cols: list[str], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _sig(df: DataFrame, cols: list[str], digits: int | None) -> DataFrame:
    """Keep ~7 significant digits (float32) of ratio metrics: MAPE reaches
    1e17 where an actual is 0, so fixed decimals cannot absorb the order in
    which partial sums were added."""
    if digits is None:
        return df
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in cols})


def arima_forecast(
    series: DataFrame,
    train_end: dt.date,
    horizon: int,
    value: str,
    order: tuple[int, int, int] = (1, 1, 1),
    start_mode: str = "train_end",
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
    num_partitions: int | None = None,
    chunk: int = 64,
    coefficients: tuple[float, float] | None = None,
) -> DataFrame:
    """One ARIMA fit per series, in tasks that stream whole series.

    Only training rows (date <= train_end) are shuffled, once, by series.
    Each task sorts its rows by series and date and reads them as a stream;
    ``chunk`` whole series at a time are fitted in one vectorised NumPy pass,
    so memory holds one chunk however many series there are. The shuffle has
    an explicit partition count, which AQE does not coalesce: the work is CPU
    per series, not bytes.

    ``coefficients`` (phi, theta) are used instead of a fit when given.
    Series without training rows produce nothing; every other series gets
    ``horizon`` rows. ``status`` is 'ok', 'flat' (too short to fit: the last
    value) or 'failed' (null forecasts; the other series are unaffected).
    A null key is a key of its own.
    """
    arima.check_order(order)
    if start_mode not in START_MODES:
        raise ValueError(f"start_mode must be one of {START_MODES}")
    keys = list(keys)
    spark = series.sparkSession
    ship_package(spark)  # the function runs in the executors' Python workers
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    types = {f.name: f.dataType.simpleString() for f in series.schema.fields}
    columns = [*keys, date_col, "forecast", "status", "phi", "theta"]
    schema = (
        ", ".join(f"`{k}` {types[k]}" for k in keys)
        + f", `{date_col}` date, forecast double, status string, phi double, theta double"
    )
    one_day = dt.timedelta(days=1)

    def fitted(waiting: list[tuple[tuple, list, object]]) -> pd.DataFrame:
        results = arima.forecast_guarded([np.array(v, dtype=float) for _, v, _ in waiting], horizon, order, coefficients)
        rows = []
        for (key, _, last), (vals, status, phi, theta) in zip(waiting, results):
            base = train_end if start_mode == "train_end" else last
            rows += [(*key, base + one_day * (h + 1), vals[h], status, phi, theta) for h in range(horizon)]
        out = pd.DataFrame(rows, columns=columns)
        return out.astype({"forecast": float, "phi": float, "theta": float})

    def fit_stream(frames):
        waiting: list[tuple[tuple, list, object]] = []
        for frame in frames:
            clean = frame[keys].astype(object).where(frame[keys].notna(), None)
            for key, day, v in zip(zip(*[clean[k] for k in keys]), frame[date_col], frame[value]):
                if not waiting or waiting[-1][0] != key:
                    if len(waiting) >= chunk:
                        yield fitted(waiting)
                        waiting = []
                    waiting.append((key, [], None))
                waiting[-1][1].append(v)
                waiting[-1] = (key, waiting[-1][1], day)
        if waiting:
            yield fitted(waiting)

    train = (
        within(series, None, train_end, date_col)
        .where(F.col(value).isNotNull())
        .select(*keys, date_col, value)
        .repartition(parts, *keys)
        .sortWithinPartitions(*keys, date_col)
    )
    return train.mapInPandas(fit_stream, schema=schema)


def scored_only(forecasts: DataFrame) -> DataFrame:
    """Forecasts of series that were really fitted: flat and failed ones do not count."""
    return forecasts.where(F.col("status") == arima.STATUS_OK)


def arma_objective(w: Column, phi: Column, theta: Column) -> Column:
    """``n*ln(S/n) + L`` of an array of differences in order: the exact Gaussian likelihood of
    an ARMA(1,1), by the same recursion as ``arima`` but as an expression."""
    start = F.struct(
        F.lit(0.0).alias("s"), F.lit(0.0).alias("l"), F.lit(0.0).alias("x"),
        ((1 + 2 * theta * phi + theta * theta) / (1 - phi * phi)).alias("r"),
    )

    def step(a, v):
        e = v - a["x"]
        return F.struct(
            (a["s"] + e * e / a["r"]).alias("s"), (a["l"] + F.log(a["r"])).alias("l"),
            (phi * v + theta / a["r"] * e).alias("x"), (1 + theta * theta - theta * theta / a["r"]).alias("r"),
        )

    n = F.size(w).cast("double")
    return F.aggregate(w, start, step, lambda a: n * F.log(a["s"] / n) + a["l"])


def certify_arma11(
    series: DataFrame,
    forecasts: DataFrame,
    train_end: dt.date,
    value: str,
    grid: Sequence[float],
    step: float = 0.01,
    keys: Sequence[str] = SERIES_KEYS,
    date_col: str = DATE_COL,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Whether each fitted ARIMA(1,1,1) is a maximum of its likelihood.

    One row a fitted series: ``n_diffs``; ``grid_best``, the least objective over
    all pairs of ``grid`` values; ``beats_grid``, whether the fit is as good as
    that; ``better_neighbours``, how many of the four points ``step`` beside the
    fit are better. The likelihood is evaluated by an expression of its own
    (``arma_objective``), not by the fit's code.
    """
    keys = list(keys)
    train = series.where((F.col(date_col) <= F.lit(train_end)) & F.col(value).isNotNull())
    # A series is one value a day; its list is what a window over it would hold.
    gathered = train.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(date_col, value))).alias("_rows"))
    values = F.transform("_rows", lambda r: r[value].cast("double"))
    diffs = F.zip_with(F.slice("_v", 2, F.greatest(F.size("_v") - 1, F.lit(0))), F.slice("_v", 1, F.greatest(F.size("_v") - 1, F.lit(0))), lambda a, b: a - b)
    arrays = gathered.select(*[F.col(k).alias(f"_{k}") for k in keys], values.alias("_v")).withColumn("_w", diffs)
    fits = scored_only(forecasts).groupBy(*keys).agg(F.first("phi").alias("phi"), F.first("theta").alias("theta"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    held = fits.join(arrays, same).select(*keys, "phi", "theta", "_w")
    inside = lambda c, d: F.greatest(F.least(F.col(c) + F.lit(d), F.lit(arima.LIMIT)), F.lit(-arima.LIMIT))
    point = lambda kind, p, t: F.struct(F.lit(kind).alias("kind"), p.alias("p"), t.alias("t"))
    points = [point("fit", F.col("phi"), F.col("theta"))]
    points += [point("beside", inside("phi", d), F.col("theta")) for d in (-step, step)]
    points += [point("beside", F.col("phi"), inside("theta", d)) for d in (-step, step)]
    points += [point("grid", F.lit(float(p)), F.lit(float(t))) for p in grid for t in grid]
    each = held.select(*keys, "_w", F.explode(F.array(*points)).alias("at"))
    told = each.select(*keys, F.size("_w").alias("n"), F.col("at.kind").alias("kind"), arma_objective(F.col("_w"), F.col("at.p"), F.col("at.t")).alias("f"))
    told = told.groupBy(*keys).agg(
        F.max("n").cast("long").alias("n_diffs"),
        F.min(F.when(F.col("kind") == "grid", F.col("f"))).alias("grid_best"),
        F.max(F.when(F.col("kind") == "fit", F.col("f"))).alias("_fit"),
        F.collect_list(F.when(F.col("kind") == "beside", F.col("f"))).alias("_beside"),
    )
    better = F.size(F.filter("_beside", lambda f: f < F.col("_fit") - F.lit(tolerance)))
    return told.select(
        *keys, "n_diffs", "grid_best", (F.col("_fit") <= F.col("grid_best") + F.lit(tolerance)).alias("beats_grid"), better.alias("better_neighbours")
    )
