"""Join helpers: null-safe equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def equi_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str] | None = None,
    how: str = "left",
    null_safe: bool = True,
) -> DataFrame:
    """Equi-join that keeps the left key columns and drops the right ones.

    ``null_safe=True`` matches null with null, as pandas ``merge`` does
    (Spark still plans it as a hash/sort-merge join on rewritten keys).
    """
    right_keys = list(right_keys or left_keys)
    tmp = [f"__rk{i}" for i in range(len(right_keys))]
    r = right
    for src, dst in zip(right_keys, tmp):
        r = r.withColumnRenamed(src, dst)
    conds = [
        (left[lk].eqNullSafe(r[rk]) if null_safe else left[lk] == r[rk])
        for lk, rk in zip(left_keys, tmp)
    ]
    return left.join(r, on=conds, how=how).drop(*tmp)
