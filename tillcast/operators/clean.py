"""L1: clean, enrich, standardise and filter into the transaction master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import ACTIVE_STATUS, IGNORE_FLAG, PREFIX_TO_DEPARTMENT, OverrideRule
from tillcast.functions import scalar as S
from tillcast.operators.joins import equi_join
from tillcast.session import materialize

MASTER_COLUMNS = (
    "data_id",
    "branch",
    "quantity",
    "date",
    "time",
    "type",
    "dept_name_std",
    "ite_desc_std",
    "food_type",
    "cat_flag",
)


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip spaces around column names (values are left alone)."""
    return df.toDF(*[c.strip() for c in df.columns])


def clean_transactions(tx: DataFrame, default_type: str = "D") -> DataFrame:
    """Drop unused columns, default ``type``, parse date and time."""
    out = (
        tx.drop("delivery", "transdate", "pos")
        .fillna({"type": default_type})
        .withColumn("date", S.parse_date("date"))
    )
    return S.with_time_of_day(out, "time")


def enrich_products(
    products: DataFrame,
    departments: DataFrame,
    null_safe: bool = True,
) -> DataFrame:
    """Attach the department name, drop ids, de-duplicate.

    Departments repeat per ``pos``, so the join fans out; the distinct after
    dropping ``pos`` and friends collapses it again. This join (like J2, J3)
    only touches the catalogue, which is written once before it meets the
    fact table, so no hint: Spark's size threshold and AQE's measured sizes
    pick broadcast or shuffle without an extra counting job.
    """
    depts = departments.select("branch", "dept_code", "dept_name")
    joined = equi_join(
        products,
        depts,
        ["branch", "dep_code"],
        ["branch", "dept_code"],
        how="left",
        null_safe=null_safe,
    )
    return joined.drop("data_id", "unit_prc", "pos", "dept_code").dropDuplicates()


def standardize_department(
    products: DataFrame,
    rules: Sequence[OverrideRule],
    prefix_map: Mapping[str, str] = PREFIX_TO_DEPARTMENT,
) -> DataFrame:
    """Prefix lookup, ordered overrides, fall back to the raw name."""
    by_prefix = S.lookup(S.alpha_prefix("incode"), prefix_map)
    std = S.apply_overrides(by_prefix, rules)
    return products.withColumn("dept_name_std", F.coalesce(std, F.col("dept_name"))).drop(
        "dept_name"
    )


def department_prefixes(products: DataFrame, prefix_map=PREFIX_TO_DEPARTMENT) -> DataFrame:
    """P8, P9 on their own: the prefix and the department it maps to."""
    prefix = S.alpha_prefix("incode")
    return products.select(
        "branch",
        "incode",
        prefix.alias("prefix"),
        S.lookup(prefix, prefix_map).alias("prefix_dept"),
    )


def apply_mappings(
    products: DataFrame,
    item_map: DataFrame,
    dept_map: DataFrame,
    ignore: str = IGNORE_FLAG,
) -> DataFrame:
    """Item and department mapping, then the flag precedence.

    Catalogue-side joins: no hint (see ``enrich_products``)."""
    items = trim_column_names(item_map).select(
        "ite_desc",
        "ite_desc_std",
        F.col("cat_flag").alias("cat_flag_item"),
        "status",
        "food_type",
    )
    depts = trim_column_names(dept_map).select(
        F.col("dep_desc").alias("dept_name_std"), F.col("cat_flag").alias("cat_flag_dept")
    )
    out = products.join(items, on="ite_desc", how="left").join(
        depts, on="dept_name_std", how="left"
    )
    return out.withColumn(
        "cat_flag", S.flag_precedence("cat_flag_item", "cat_flag_dept", ignore)
    ).drop("cat_flag_item", "cat_flag_dept")


def product_master(
    products: DataFrame,
    departments: DataFrame,
    item_map: DataFrame,
    dept_map: DataFrame,
    rules: Sequence[OverrideRule],
    null_safe: bool = True,
) -> DataFrame:
    """Products enriched with standard department, item map and flags."""
    pm = enrich_products(products, departments, null_safe)
    pm = standardize_department(pm, rules)
    return apply_mappings(pm, item_map, dept_map)


def join_transactions(
    tx: DataFrame,
    products: DataFrame,
    null_safe: bool = True,
) -> DataFrame:
    """Transactions left-joined to the product master on (branch, code, dep).

    The product side is a catalogue (items x branches). It is written once to
    the checkpoint folder, so Spark plans the join from its real size in
    bytes: below the session's broadcast threshold the fact table is not
    shuffled; beyond it the join shuffles and AQE splits skewed partitions.
    """
    pm = materialize(products.withColumnRenamed("incode", "ite_code"), "product-master")
    return equi_join(
        tx, pm, ["branch", "ite_code", "dep_code"], how="left", null_safe=null_safe
    )


def filter_master(
    df: DataFrame, ignore: str = IGNORE_FLAG, active: str = ACTIVE_STATUS
) -> DataFrame:
    """Keep active items whose flag is not ``ignore`` (null kept)."""
    kept = df.where(S.not_equal_keep_null("cat_flag", ignore) & (F.col("status") == active))
    return kept.select(*MASTER_COLUMNS)


def transaction_master(
    tx: DataFrame,
    products: DataFrame,
    departments: DataFrame,
    item_map: DataFrame,
    dept_map: DataFrame,
    rules: Sequence[OverrideRule],
    null_safe: bool = True,
) -> DataFrame:
    """L1 end to end."""
    pm = product_master(products, departments, item_map, dept_map, rules, null_safe)
    joined = join_transactions(clean_transactions(tx), pm, null_safe)
    return filter_master(joined)
