"""How the columns of a current frame differ from those of a reference frame.

Values are counted per column and dataset first, so a value that most rows share
is one row from then on. The distinct values are range-partitioned; a running
count within each partition plus the totals of the partitions before it gives the
share of either dataset at or below a value, without one task that sorts a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import scalar as S
from tillcast.session import materialize

LEAST_SHARE = 1e-4  # of an empty bin, so that its logarithm exists


def _counted(df: DataFrame, dataset: str, reference: str, current: str, pairs) -> DataFrame:
    """``column, value, r, c``: rows of either dataset with each value."""
    each = df.where(F.col(dataset).isin(reference, current)).select((F.col(dataset) == reference).alias("_ref"), F.inline(F.array(*pairs)))
    count = lambda of: F.count(F.when(of, 1))
    return each.groupBy("column", "value").agg(count(F.col("_ref")).alias("r"), count(~F.col("_ref")).alias("c"))


def _running(counted: DataFrame) -> DataFrame:
    """Adds ``rb, cb`` (rows of smaller values) and ``rn, cn`` (all rows of the column)."""
    placed = counted.repartitionByRange("column", "value").withColumn("_pid", F.spark_partition_id())
    placed = materialize(placed, "drift-counts")
    parts = placed.groupBy("column", "_pid").agg(F.sum("r").alias("pr"), F.sum("c").alias("pc"))
    before = Window.partitionBy("column").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column")
    offsets = parts.select(
        "column", "_pid", F.coalesce(F.sum("pr").over(before), F.lit(0)).alias("ro"), F.coalesce(F.sum("pc").over(before), F.lit(0)).alias("co"),
        F.sum("pr").over(whole).alias("rn"), F.sum("pc").over(whole).alias("cn"),
    )
    inside = Window.partitionBy("column", "_pid").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    upto = placed.withColumns({"ri": F.coalesce(F.sum("r").over(inside), F.lit(0)), "ci": F.coalesce(F.sum("c").over(inside), F.lit(0))})
    held = upto.join(offsets, ["column", "_pid"])
    return held.select("column", "value", "r", "c", (F.col("ro") + F.col("ri")).alias("rb"), (F.col("co") + F.col("ci")).alias("cb"), "rn", "cn")


def _stability(binned: DataFrame) -> DataFrame:
    """Population stability index over the bins ``column, bin, r, c, rn, cn`` of each column."""
    p, q = (F.greatest(F.try_divide(F.col(a), F.col(b)), F.lit(LEAST_SHARE)) for a, b in (("r", "rn"), ("c", "cn")))
    return binned.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def column_drift(
    df: DataFrame,
    numbers: Sequence[str],
    texts: Sequence[str] = (),
    dataset: str = "dataset",
    reference: str = "reference",
    current: str = "current",
    bins: int = 10,
) -> DataFrame:
    """One row a column: ``column, n_reference, n_current, nulls_reference,
    nulls_current, ks, ks_at, psi``.

    ``ks`` is the two-sample Kolmogorov-Smirnov distance of a number column and
    ``ks_at`` the smallest value where it is reached. ``psi`` is the population
    stability index, for numbers over bins of equal shares of the reference (a
    value is in the bin of the share below it, so equal values stay together),
    for texts over the values themselves, null being one of them. A bin that
    one side lacks counts as ``LEAST_SHARE``. Null and NaN numbers are counted
    and left out. A column without values on one side has no distances.
    """
    number = lambda c: F.col(c).cast("double")
    pairs = [F.struct(F.lit(c).alias("column"), F.nanvl(number(c), F.lit(None).cast("double")).alias("value")) for c in numbers]
    held = materialize(_counted(df, dataset, reference, current, pairs), "drift-values") if pairs else None
    out = []
    if held is not None:
        missing = held.where("value is null").select("column", F.col("r").alias("nulls_reference"), F.col("c").alias("nulls_current"))
        ranked = materialize(_running(held.where("value is not null")), "drift-ranked")
        share = lambda a, b: F.try_divide(F.col(a), F.col(b))
        gap = F.abs(F.try_divide(F.col("rb") + F.col("r"), F.col("rn")) - F.try_divide(F.col("cb") + F.col("c"), F.col("cn")))
        furthest = ranked.withColumn("gap", F.round(gap, 12)).groupBy("column").agg(
            F.max("rn").alias("n_reference"), F.max("cn").alias("n_current"), F.max("gap").alias("ks"),
            (-F.max(F.when(F.col("gap").isNotNull(), F.struct("gap", (-F.col("value")).alias("v"))))["v"]).alias("ks_at"),
        )
        bin_of = F.least(F.try_divide(F.col("rb") * bins, F.col("rn")).cast("long"), F.lit(bins - 1))
        binned = ranked.withColumn("bin", bin_of).groupBy("column", "bin").agg(
            F.sum("r").alias("r"), F.sum("c").alias("c"), F.max("rn").alias("rn"), F.max("cn").alias("cn")
        )
        told = furthest.join(_stability(binned), "column").join(missing, "column", "left")
        out.append(told)
    if texts:
        pairs = [F.struct(F.lit(c).alias("column"), S.category_text(c).alias("value")) for c in texts]
        values = materialize(_counted(df, dataset, reference, current, pairs), "drift-texts")
        sums = values.groupBy("column").agg(F.sum("r").alias("rn"), F.sum("c").alias("cn"))
        psi = _stability(values.join(sums, "column"))
        nulls = df.where(F.col(dataset).isin(reference, current)).select(
            (F.col(dataset) == reference).alias("_ref"),
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().alias("none")) for c in texts])),
        ).groupBy("column").agg(
            F.count(F.when(F.col("none") & F.col("_ref"), 1)).alias("nulls_reference"),
            F.count(F.when(F.col("none") & ~F.col("_ref"), 1)).alias("nulls_current"),
        )
        none = F.lit(None).cast("double")
        told = sums.join(psi, "column").join(nulls, "column")
        out.append(told.select("*", F.col("rn").alias("n_reference"), F.col("cn").alias("n_current"), none.alias("ks"), none.alias("ks_at")))
    both = F.col("n_reference") * F.col("n_current") > 0
    shaped = [
        f.select(
            "column", "n_reference", "n_current", F.coalesce("nulls_reference", F.lit(0)).alias("nulls_reference"),
            F.coalesce("nulls_current", F.lit(0)).alias("nulls_current"), "ks", "ks_at", F.when(both, F.col("psi")).alias("psi"),
        )
        for f in out
    ]
    return shaped[0] if len(shaped) == 1 else shaped[0].unionByName(shaped[1])
