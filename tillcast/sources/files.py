"""File sources and sinks, row counts, previews, summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tillcast.sources.schemas import DEPT_MAP_COLUMNS, ITEM_MAP_COLUMNS


def _csv(spark: SparkSession, path: str, **options) -> DataFrame:
    try:
        return spark.read.options(header=True, **options).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"CSV not found at: {path}") from e
        raise


def read_mapping_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """S3: a mapping file, every column as text, picked by (trimmed) name.

    Values are kept exactly as written (leading spaces, trailing tabs), so
    lookups match the raw keys; only empty fields become null.
    """
    df = _csv(spark, path, inferSchema=False)
    df = df.toDF(*[c.strip() for c in df.columns])
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*columns)


def read_mappings(spark: SparkSession, department_path: str, item_path: str) -> dict[str, DataFrame]:
    """S3: ``{"department": ..., "item": ...}``."""
    return {
        "department": read_mapping_csv(spark, department_path, DEPT_MAP_COLUMNS),
        "item": read_mapping_csv(spark, item_path, ITEM_MAP_COLUMNS),
    }


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S4 with an explicit schema (date columns typed); S5 infers when none is given."""
    if schema is None:
        return _csv(spark, path, inferSchema=True)
    # All text first, then typed by name with try_cast: a reordered file
    # still binds correctly and a bad value becomes null instead of failing.
    raw = _csv(spark, path, inferSchema=False)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index column, one folder of part files."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


MONTH = "month_no"


def month_number(date_col: str = "date") -> Column:
    """2024-03-15 -> 202403: the partition of a date."""
    return (F.year(date_col) * 100 + F.month(date_col)).cast("int")


def write_by_month(df: DataFrame, path: str, date_col: str = "date", months: Sequence[int] | None = None) -> None:
    """S6 for tables by date: one folder a month, and only the months of ``df`` are replaced.

    With ``months`` (a rerun of these alone) a month that no longer has rows
    goes too. A month's rows are dealt over as many tasks as their size asks
    for (AQE splits a large one). Rows without a date are a month of their own.
    """
    spark = df.sparkSession
    folders = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MONTH}={m}") for m in months or ()]
    before = [_names(spark, f) for f in folders]
    placed = df.withColumn(MONTH, month_number(date_col)).hint("rebalance", MONTH)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    for folder, names in zip(folders, before):
        if names and _names(spark, folder) == names:  # not replaced: the month has no rows any more
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _names(spark: SparkSession, folder) -> set[str]:
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()


def within(df: DataFrame, start: dt.date | None, end: dt.date | None, date_col: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end`` (inclusive, either may be open); of a table by month only
    the folders that can hold them are read."""
    d = F.col(date_col)
    for bound, holds in ((start, lambda c, v: c >= v), (end, lambda c, v: c <= v)):
        if bound is not None:
            df = df.where(holds(d, F.lit(bound)))
            if MONTH in df.columns:
                df = df.where(holds(F.col(MONTH), F.lit(bound.year * 100 + bound.month)))
    return df


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while the next action runs (no extra pass).

    ``obs.get["rows"]`` is available after that action.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> str:
    """First ``n`` rows in an explicit order, as text (at most ``n`` rows
    reach the driver)."""
    rows = df.orderBy(*order_by).limit(n).collect()
    cols = df.columns
    lines = [" | ".join(cols)] + [" | ".join("" if r[c] is None else str(r[c]) for c in cols) for r in rows]
    return "\n".join(lines)


def preview_bundle(bundle: dict[str, DataFrame], order_by: dict[str, Sequence[str]] | None = None, n: int = 5) -> str:
    """S8 for a named bundle of tables."""
    parts = []
    for key, df in bundle.items():
        keys = (order_by or {}).get(key) or df.columns[:1]
        parts.append(f"[data: {key}]\n{preview(df, keys, n)}")
    return "\n\n".join(parts)


def evaluation_summary(evaluation: DataFrame, item: str = "ite_desc_std") -> DataFrame:
    """One text line per series, MAE and MAPE to 2 decimals, ordered.

    Rounded as decimals, half away from zero, so that a tie does not depend
    on how a double is printed; from 10^15 on, where a double has no cents
    (a MAPE over an actual of 0), in powers of ten."""
    large = lambda c: F.when(F.col(c) >= 1e15, F.format_string("%.5e", F.col(c)))
    two = lambda c: F.coalesce(large(c), F.round(F.col(c).try_cast("decimal(38,10)"), 2).cast("string"), F.lit("null"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    line = F.concat(text("branch"), F.lit(" | "), text(item), F.lit(": MAE="), two("mae"), F.lit(", MAPE="), two("mape"), F.lit("%"))
    return evaluation.orderBy("branch", item).select(line.alias("line"))
