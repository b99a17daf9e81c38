"""J4 on a stored layout: transactions and catalogue bucketed alike, so neither is shuffled.

Transactions are written once, bucketed and sorted by one key column that is equal
exactly where all join keys are equal or both null. A catalogue laid out by the same
number of buckets then joins bucket by bucket, however large it is: no exchange of
the fact table for each run, which is what a catalogue beyond the broadcast limit
would otherwise cost.

A key that holds more than a bucket's share of the rows is found by counting
when the transactions are laid out. Its rows are dealt over several buckets by a
hash of the row, and the catalogue repeats the key's rows for each of them. There
are fewer such keys than buckets, so their list is small whatever the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import checkpoint_dir, materialize, remember_written

KEY = "layout_key"
_SALTS = "layout_salts"


@dataclass(frozen=True)
class Layout:
    """A bucketed fact table: where it is, its join keys, and its heavy keys."""

    table: str
    keys: tuple[str, ...]
    buckets: int
    heavy: DataFrame


def key_text(keys: Sequence[str]) -> Column:
    """One text that is equal exactly where all keys are equal or both null."""
    text = lambda k: F.col(k).cast("string")
    return F.concat(*[F.when(F.col(k).isNull(), "n").otherwise(F.concat(F.lit("v"), F.length(text(k)), F.lit(":"), text(k))) for k in keys])


def _salted(key: Column, salt: Column) -> Column:
    return F.concat(key, F.lit("#"), salt.cast("string"))


def _write(df: DataFrame, name: str, buckets: int) -> str:
    spark = df.sparkSession
    table = f"tillcast_{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/layout/{table}"
    remember_written(spark, path)
    # Dealt as the buckets are, so that a bucket is one sorted file.
    dealt = df.repartition(buckets, KEY)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)
    return table


def lay_out_fact(fact: DataFrame, keys: Sequence[str], buckets: int, name: str = "fact") -> Layout:
    """Write ``fact`` bucketed by ``keys``; its rows are read twice (counting and writing)."""
    keyed = fact.withColumn(KEY, key_text(keys))
    counts = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    rows = fact.count()
    share = max(1, -(-rows // buckets))
    salts = F.ceil(F.col("n") * 2 / F.lit(share)).cast("int")
    heavy = materialize(counts.where(F.col("n") > share).select(F.col(KEY).alias("heavy_key"), salts.alias(_SALTS)), f"{name}-heavy")
    dealt = keyed.join(F.broadcast(heavy), F.col(KEY) == F.col("heavy_key"), "left")  # fewer rows than buckets
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.coalesce(_SALTS, F.lit(1)))
    placed = dealt.withColumn(KEY, _salted(F.col(KEY), salt)).drop("heavy_key", _SALTS)
    return Layout(_write(placed, name, buckets), tuple(keys), buckets, heavy)


def lay_out_lookup(lookup: DataFrame, keys: Sequence[str], layout: Layout, name: str = "lookup") -> str:
    """Write ``lookup`` in the buckets of ``layout``, its keys dropped (the fact has them)."""
    keyed = lookup.withColumn(KEY, key_text(keys)).drop(*keys)
    dealt = keyed.join(F.broadcast(layout.heavy), F.col(KEY) == F.col("heavy_key"), "left")
    each = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)))
    return _write(each.withColumn(KEY, _salted(F.col(KEY), F.col("salt"))).drop("salt", "heavy_key", _SALTS), name, layout.buckets)


def join_laid_out(spark: SparkSession, layout: Layout, lookup_table: str, how: str = "left") -> DataFrame:
    """The fact with what the lookup holds for its keys, bucket by bucket."""
    return spark.table(layout.table).join(spark.table(lookup_table), KEY, how).drop(KEY)
