"""Mixing sources to target weights with a time-varying curriculum.

Every source has a share of the training run and a weight that changes over
training time ``t`` in [0, 1]. A source's demand up to time t is the integral
of its weight; dealing its documents out in a fixed pseudo-random order, the
document that covers words c..c+size of the demand gets the training position
at which the integral reaches the middle of that range (the integral is a
quadratic, so its inverse is a closed form). Sorting by position gives the
training order.

The running word count of a source is a two-level prefix sum: totals per
(source, bucket of the order key), summed over buckets, plus a sum inside each
bucket. Buckets have about ``rows_per_bucket`` documents whatever the size of
the source, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import stored, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
ROWS_PER_BUCKET = 1_000
# Weight of a source at the start of training over that at its end, by the
# source's place in the repeating list: fading in, level, fading out.
CURRICULUM = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))


def source_targets(
    per_source: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """Target words of each source: ``place, target`` added to ``source, source_size``.

    Targets share ``share`` times all words by weight, none above
    ``max_repeats`` times its source's size. Giving the excess to the others
    by weight until none is above ends where one level L holds for all:
    target = min(cap, L * weight). Sources are sorted by cap / weight and the
    level is read off at the first source that its level does not fill (taking
    caps off for later ones too only lowers it, so it is the largest).
    One row per source; the sort over sources is the only unpartitioned one.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    here_on = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    n = len(weights)
    placed = per_source.withColumn("place", ((F.row_number().over(by_name) - 1) % n).cast("int"))
    weighed = placed.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") + 1))
    caps = weighed.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats))).withColumn(
        "ratio", F.col("cap") / F.col("weight")
    )
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = total - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    level = caps.withColumn("level", left / F.sum("weight").over(here_on))
    level = level.withColumn("final", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("final") * F.col("weight"))
    )
    added = [F.col("place"), target.cast("double").alias("target")]
    return level.select(*per_source.columns, *added)


def position_of(demand_share: Column, start: Column, end: Column) -> Column:
    """Training time at which a weight running linearly from ``start`` to ``end``
    has met ``demand_share`` (0 to 1) of its integral."""
    slope = end - start
    goal = demand_share * (start + end) / 2
    root = (F.sqrt(start * start + 2 * slope * goal) - start) / F.when(slope == 0, F.lit(1.0)).otherwise(slope)
    return F.when(slope == 0, demand_share).otherwise(root)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    curriculum: tuple[tuple[float, float], ...] = CURRICULUM,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    carry: bool = False,
) -> DataFrame:
    """What the mix takes of each document.

    ``docs`` has ``doc_id, source, text`` (other columns are not read).
    Returns ``doc_id, size, source_size, target, taken, positions``: ``taken``
    words, in as many passes over the document as ``positions`` (training
    times) has entries; the last pass may be part of it. With ``carry`` the
    whole input row comes along as the struct ``row``. A source gives whole
    passes over all its documents while its target allows, then the rest from
    the front of its order, so the words taken of a source are its target
    rounded down.

    Defined results: a null text has size 0 and is never taken; a null source
    is a source of its own, last in order; an empty table gives no rows;
    repeated rows are documents of their own that stand next to each other in
    the order, and which of them comes first makes no difference to the rows
    returned. The order key is md5 of the id and size, so runs agree.
    """
    own = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []
    digest = F.coalesce(F.md5("text"), F.lit("")).alias("digest")
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest, *own)
    order_text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), "digest")
    base = base.withColumn("key", F.md5(order_text)).drop("digest").withColumn(
        "source_key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    )
    sizes = stored(base.drop("row"), "mix_sizes")
    targets = source_targets(
        sizes.groupBy("source", "source_key").agg(F.sum("size").alias("source_size")), weights, share, max_repeats
    )
    buckets = max(1, -(-sizes.count() // rows_per_bucket))
    number = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    bucket = F.floor(number * F.lit(buckets) / F.lit(1 << 32)).cast("long")

    per_bucket = sizes.groupBy("source_key", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    up_to = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(up_to), F.lit(0)))
    known = starts.drop("bucket_size").join(targets.drop("source"), "source_key")

    inside = (
        Window.partitionBy("source_key", "bucket")
        .orderBy("key", F.col("doc_id").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = (base if carry else sizes).withColumn("bucket", bucket)
    summed = summed.withColumn("in_bucket", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(known, ["source_key", "bucket"])

    before = F.col("bucket_start") + F.col("in_bucket")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    taken = (whole * F.col("size") + part).cast("long")
    passes = F.when(F.col("size") == 0, 0).otherwise(F.ceil(taken / F.col("size"))).cast("int")

    def turn(end: int) -> Column:
        values = F.array(*[F.lit(float(pair[end])) for pair in curriculum])
        return F.element_at(values, F.col("place") % len(curriculum) + 1)

    def at(number_of_pass: Column) -> Column:
        middle = number_of_pass * F.col("source_size") + before + F.col("size") / 2
        return position_of(F.least(F.lit(1.0), middle / F.col("target")), turn(0), turn(1))

    positions = F.when(passes > 0, F.transform(F.sequence(F.lit(0), passes - 1), at)).otherwise(
        F.array().cast("array<double>")
    )
    columns = ["doc_id", "size", "source_size", "target", taken.alias("taken"), positions.alias("positions")]
    return joined.select(*columns, *(["row"] if carry else []))


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """``mix`` with the training time of each document's first and last pass (null if none) in
    place of all, range-sorted by the first: partitions follow one another in training."""
    mixed = mix(docs, **settings)
    some = F.size("positions") > 0
    times = {
        "first_position": F.when(some, F.round(F.try_element_at("positions", F.lit(1)), 9)),
        "last_position": F.when(some, F.round(F.try_element_at("positions", F.lit(-1)), 9)),
    }
    told = mixed.withColumns(times).drop("positions")
    return told.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def training_order(docs: DataFrame, **settings) -> DataFrame:
    """The documents in training order: one row for each pass, whole texts.

    Keeps the columns of ``docs``; documents of which nothing is taken go. The
    result is range-sorted by position, so its partitions follow one another
    in time. A pass that needs only part of a document carries all of it: at
    most one document of each source.
    """
    mixed = mix(docs, carry=True, **settings)
    turns = mixed.select("row", F.explode("positions").alias("position"))
    ordered = turns.repartitionByRange("position", "row.doc_id").sortWithinPartitions("position", "row.doc_id")
    return ordered.select("row.*")
