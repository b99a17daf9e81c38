"""L2: daily totals and each branch's top items."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.sources.files import within


def daily_totals(
    master: DataFrame,
    keys: Sequence[str] = ("branch", "ite_desc_std", "date"),
    value: str = "quantity",
) -> DataFrame:
    """A1: sum of ``value`` per key. Rows with a null key are dropped (as a
    pandas groupby does) and a group of only nulls sums to 0.

    The aggregate is partial before the shuffle, so a hot key costs one
    row per map task, not one per transaction.
    """
    keys = list(keys)
    return (
        master.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).cast("double").alias(value))
    )


def year_range(df: DataFrame, start_year: int, end_year: int, date_col: str = "date") -> DataFrame:
    """inclusive year range written on the raw date, so Parquet can prune (and, of a
    table stored by month, folders)."""
    return within(df, dt.date(start_year, 1, 1), dt.date(end_year, 12, 31), date_col)


def branch_item_totals(
    daily: DataFrame,
    start_year: int,
    end_year: int,
    keys: Sequence[str] = ("branch", "ite_desc_std"),
    value: str = "quantity",
) -> DataFrame:
    """A2: total per branch x item inside the year range."""
    return (
        year_range(daily, start_year, end_year)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).cast("double").alias(value))
    )


def top_n_per_group(
    totals: DataFrame,
    n: int,
    group: str = "branch",
    item: str = "ite_desc_std",
    value: str = "quantity",
) -> DataFrame:
    """Exactly ``n`` rows per group by ``value`` desc; ties -> smaller item.

    Spark plans a WindowGroupLimit before the shuffle, so each map task
    sends at most ``n`` rows per group.
    """
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(item).asc())
    return (
        totals.withColumn("rank", F.row_number().over(w).cast("int"))
        .where(F.col("rank") <= n)
    )


def restrict_to(daily: DataFrame, chosen: DataFrame, keys: Sequence[str] = ("branch", "ite_desc_std")) -> DataFrame:
    """Keep the daily rows of the chosen series (semi join, keys unique).

    No broadcast hint: ``chosen`` derives from the fact table, so its size is
    only known at run time; AQE turns the join into a broadcast when the
    measured side is small and keeps the shuffle join otherwise.
    """
    keys = list(keys)
    return daily.join(chosen.select(*keys), on=keys, how="left_semi")


def daily_top_items(
    daily: DataFrame, start_year: int, end_year: int, top_n: int
) -> DataFrame:
    """L2: all dates of each branch's top items, chosen on the year range."""
    top = top_n_per_group(branch_item_totals(daily, start_year, end_year), top_n)
    return restrict_to(daily, top)
