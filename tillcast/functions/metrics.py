"""Aggregate expressions for forecast and regression quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Guard used by the usual MAPE definition so a zero actual does not divide by zero.
MAPE_EPS = 2.220446049250313e-16


def abs_error(y: Column, p: Column) -> Column:
    return F.abs(y - p)


def mae(y: Column, p: Column) -> Column:
    return F.avg(abs_error(y, p))


def mape(y: Column, p: Column, percent: bool = True) -> Column:
    ratio = F.avg(abs_error(y, p) / F.greatest(F.abs(y), F.lit(MAPE_EPS)))
    return ratio * 100.0 if percent else ratio


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def r2(y: Column, p: Column) -> Column:
    """1 - SS_res / SS_tot in one pass (null when the target is constant)."""
    ss_res = F.sum((y - p) * (y - p))
    # var_pop keeps centred sums, so large targets do not cancel
    ss_tot = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - F.try_divide(ss_res, ss_tot)
