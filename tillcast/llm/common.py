"""What the operators share: reading a table, bounded Arrow batches, written intermediates."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import drop_written, materialize, ship_package

# Java and Python forms of the contract's word: a run without space, \t, \n, \v, \f, \r.
WORD_JAVA = r"[^\x20\x09-\x0D]+"

# A batch handed to Python ends at whichever comes first, so a batch of very
# long texts stays as small as one of short texts.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and make this package importable in tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder_is(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def word_count(text: Column) -> Column:
    """Words of a text (0 for null). Each becomes one character; a count of matches would list them."""
    marks = F.translate(F.regexp_replace(text, WORD_JAVA, "w"), " \t\n\v\f\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def keep_row(df: DataFrame, name: str = "row") -> DataFrame:
    """The whole row as one struct column, so that working columns cannot clash with it."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialize(df, f"llm_{name}")


def released(*tables: DataFrame | None) -> None:
    """Delete tables that ``stored`` returned once nothing reads them any more."""
    for table in tables:
        if table is not None:
            drop_written(table.sparkSession, table.written_at)


def give_back_memory() -> None:
    """At the end of a task: Python workers are kept for later tasks, and what they once held
    stays with them unless the allocators are asked to return it."""
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
