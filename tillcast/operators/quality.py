"""Data-quality checks that surface the join behaviours the pipeline keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(
    products: DataFrame,
    keys: Sequence[str] = ("branch", "incode", "dep_code"),
    detail: str = "ite_desc",
) -> DataFrame:
    """Keys of the product master that occur more than once; each such key
    fans a transaction out into several master rows (null keys count as
    equal, matching the null-safe join)."""
    return (
        products.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(detail).alias(f"n_{detail}"))
        .where(F.col("n_rows") > 1)
    )


def unmatched_departments(
    products: DataFrame, dept_map: DataFrame, name: str = "dept_name_std", key: str = "dep_desc"
) -> DataFrame:
    """Standard department names with no entry in the department map, with
    the number of products carrying each (null names included)."""
    known = dept_map.select(F.col(key).alias(name))
    return (
        products.select(name)
        .join(known, on=name, how="left_anti")
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n_products"))
    )
