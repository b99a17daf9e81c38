"""L3: calendar features, outlier flags and the seasonal cap.

All per-series statistics are window aggregates over ``partitionBy(series)``.
A series is one branch x item after daily aggregation, so a group holds at
most one row per calendar day whatever the transaction volume; exact
percentiles are safe there. The month median runs over
``(series, month)``, which the series partitioning already satisfies, so
the whole step costs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import SERIES_KEYS
from tillcast.functions import scalar as S
from tillcast.operators.daily import year_range

METHODS = ("iqr", "z")


def calendar_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Dayofweek (Monday = 0), month, ISO week."""
    return df.withColumns(
        {
            "dayofweek": S.weekday_monday0(date_col),
            "month": F.month(date_col).cast("int"),
            "week": S.iso_week(date_col),
        }
    )


def _series_window(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def iqr_flags(
    df: DataFrame,
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    k: float = 1.5,
) -> DataFrame:
    """``q < Q1 - k*IQR or q > Q3 + k*IQR`` within each series.

    Quartiles are exact with linear interpolation; a null value is never
    an outlier.
    """
    w = _series_window(keys)
    qs = F.percentile(F.col(value), [0.25, 0.75]).over(w)
    out = df.withColumn("_q", qs).withColumns(
        {"q1": F.col("_q")[0], "q3": F.col("_q")[1]}
    ).drop("_q")
    iqr = F.col("q3") - F.col("q1")
    flag = (F.col(value) < F.col("q1") - k * iqr) | (F.col(value) > F.col("q3") + k * iqr)
    return out.withColumn("anomaly", F.coalesce(flag, F.lit(False)))


def zscore_flags(
    df: DataFrame,
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    k: float = 1.5,
) -> DataFrame:
    """``|q - mean| / std > k`` (sample std). A constant or
    single-row series has no outliers."""
    w = _series_window(keys)
    out = df.withColumns(
        {"mean": F.avg(value).over(w), "std": F.stddev_samp(value).over(w)}
    )
    z = F.try_divide(F.abs(F.col(value) - F.col("mean")), F.col("std"))
    return out.withColumn("anomaly", F.coalesce(z > k, F.lit(False)))


def flag_anomalies(
    df: DataFrame,
    method: str = "iqr",
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    k: float = 1.5,
    keep_stats: bool = False,
) -> DataFrame:
    """Dispatch on ``method``; anything but 'iqr' or 'z' is an error."""
    if method == "iqr":
        out = iqr_flags(df, value, keys, k)
        return out if keep_stats else out.drop("q1", "q3")
    if method == "z":
        out = zscore_flags(df, value, keys, k)
        return out if keep_stats else out.drop("mean", "std")
    raise ValueError(f"method must be one of {METHODS}, got {method!r}")


def seasonal_median(
    df: DataFrame, value: str = "quantity", keys: Sequence[str] = SERIES_KEYS
) -> DataFrame:
    """A3: exact median per series and calendar month (years pooled)."""
    return (
        df.withColumn("month", F.month("date").cast("int"))
        .groupBy(*keys, "month")
        .agg(F.median(value).alias("typical"))
    )


def cap_outliers(
    daily: DataFrame,
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    k: float = 1.5,
    method: str = "iqr",
    start_year: int | None = None,
    end_year: int | None = None,
) -> DataFrame:
    """L3: (F3) -> P13 -> W2 -> A3 as a window (J6) -> P14.

    ``typical`` is attached with a window median over (series, month)
    instead of aggregate + join back: same rows, one shuffle fewer.
    """
    df = daily if start_year is None else year_range(daily, start_year, end_year)
    df = flag_anomalies(calendar_features(df), method, value, keys, k)
    df = df.withColumn(
        "typical", F.median(value).over(Window.partitionBy(*keys, "month"))
    )
    return df.withColumn(
        "quantity_cap",
        F.when(F.col("anomaly"), F.col("typical")).otherwise(F.col(value)).cast("double"),
    )
