"""M3: gradient boosting by second-order, leaf-wise trees.

Rows are binned once, and rows that agree in all bins become one cell with their
number and the sum of their targets: every tree sends them to the same leaf, so
nothing is lost, and the cells are at most the product of the bins however many
rows there are. For each level of a tree one aggregation gathers the sums of
gradients and Hessians per (open leaf, feature, bin) of all leaves that are still
open, and a window over the bins finds every leaf's best split in Spark;
one row a leaf reaches the driver.

Growth is best first: the split with the largest gain is next, until the tree has
``max_leaves`` leaves. A level opens all children of the splits that are among
the first ``max_leaves - 1`` in that order so far. Splits found later can only
push others back, so a split that is not among the first now never will be:
nothing is lost against opening one leaf at a time, and a tree costs as many
aggregations as it has levels.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.trees import Ensemble, Node
from tillcast.session import materialize

WRITE_EVERY = 8  # trees between two written margins: bounds the plan, and what a lost executor repeats


@dataclass(frozen=True)
class LeafwiseParams:
    """Defaults as published for the leaf-wise library, with a depth limit."""

    n_trees: int = 100
    learning_rate: float = 0.1
    max_leaves: int = 31
    max_depth: int = 6
    max_bins: int = 255
    min_rows: int = 20
    l2: float = 0.0
    min_gain: float = 0.0


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> dict[str, list[float]]:
    """Up to ``max_bins - 1`` edges a feature near equal counts, from one aggregation."""
    probs = [k / max_bins for k in range(1, max_bins)]
    found = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, 100 * max_bins).alias(f) for f in features]).first()
    return {f: sorted({v for v in found[f] or [] if not math.isnan(v)}) for f in features}


def binned(df: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]], target: str) -> DataFrame:
    """``y`` and ``b0, b1, ...``: the number of edges at or below each feature's value; a
    missing value is in a last bin of its own."""
    inputs = df.select(
        F.col(target).cast("double").alias("y"), *[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, f in enumerate(features)]
    )
    splits = [[-math.inf, *edges[f], math.inf] for f in features]
    wide = [i for i, s in enumerate(splits) if len(s) > 2]  # a bucketizer wants two buckets at least
    if wide:
        bucketizer = Bucketizer(
            inputCols=[f"x{i}" for i in wide], outputCols=[f"b{i}" for i in wide], splitsArray=[splits[i] for i in wide], handleInvalid="keep"
        )
        inputs = bucketizer.transform(inputs)
    for i in set(range(len(features))) - set(wide):
        inputs = inputs.withColumn(f"b{i}", F.isnan(f"x{i}").cast("int"))
    return inputs.where(F.col("y").isNotNull()).select("y", *[F.col(f"b{i}").cast("int").alias(f"b{i}") for i in range(len(features))])


def cells(df: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]], target: str) -> DataFrame:
    """``b0, b1, ...``, ``n`` and ``y``: the rows that share their bins as one, with their number
    and the sum of their targets (rows with a null target are left out)."""
    rows = binned(df, features, edges, target)
    return rows.groupBy(*[f"b{i}" for i in range(len(features))]).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))


@dataclass
class _Split:
    feature: int
    bin: int  # bins up to this one go left
    gain: float


def _reached(splits: Mapping[int, _Split], leaf_value) -> Column:
    """Nested conditions over the bins; ``leaf_value(node)`` where no split goes on."""

    def at(node: int) -> Column:
        s = splits.get(node)
        if s is None:
            return leaf_value(node)
        return F.when(F.col(f"b{s.feature}") <= s.bin, at(2 * node)).otherwise(at(2 * node + 1))

    return at(1)


def _best_splits(rows: DataFrame, splits: Mapping[int, _Split], open_leaves: Sequence[int], n_features: int, p: LeafwiseParams):
    """One row an open leaf: its sums and its best split (null if it has none). Without a number
    of rows ``n``, each is one."""
    n = F.col("n") if "n" in rows.columns else F.lit(1).alias("n")
    node = _reached(splits, lambda n: F.lit(n if n in open_leaves else 0))
    placed = rows.select(node.alias("node"), F.col("g"), n, *[f"b{i}" for i in range(n_features)]).where("node > 0")
    each = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in range(n_features)])
    sums = placed.select("node", "g", "n", F.inline(each)).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("h"))
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node", "feature")
    cum = sums.select(
        "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"),
    )
    score = lambda g, h: g * g / (h + F.lit(p.l2))
    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = score(F.col("gl"), F.col("hl")) + F.try_divide(gr * gr, hr + F.lit(p.l2)) - score(F.col("g"), F.col("h"))
    allowed = (F.col("hl") >= p.min_rows) & (hr >= p.min_rows) & (hr > 0) & (gain > p.min_gain)
    # Of equal gains the first feature, then the first bin.
    best = F.max(F.when(allowed, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))).alias("best")
    # Sums over one feature are those of the leaf.
    total = lambda c: F.max(F.when(F.col("feature") == 0, F.col(c))).alias(c)
    return cum.groupBy("node").agg(best, total("g"), total("h")).collect()


def grow_tree(rows: DataFrame, n_features: int, p: LeafwiseParams) -> tuple[dict[int, _Split], dict[int, tuple[float, int]]]:
    """The splits of one tree, by node (root 1, children 2n and 2n + 1), and every visited
    node's sums of gradients and Hessians. ``rows`` has the bins of each cell, its number of rows
    ``n`` and the sum of their gradients ``g``."""
    splits: dict[int, _Split] = {}
    sums: dict[int, tuple[float, int]] = {}
    open_leaves = [1]
    for level in range(p.max_depth + 1):
        if not open_leaves:
            break
        found = _best_splits(rows, splits, open_leaves, n_features, p)
        for r in found:
            sums[r.node] = (r.g, r.h)
            if r.best is not None and level < p.max_depth:
                splits[r.node] = _Split(-r.best.f, -r.best.b, r.best.gain)
        kept = _best_first(splits, p.max_leaves - 1)
        splits = {n: splits[n] for n in kept}
        open_leaves = [c for n in kept for c in (2 * n, 2 * n + 1) if c not in sums]
    return splits, sums


def _best_first(splits: Mapping[int, _Split], count: int) -> list[int]:
    """The first ``count`` splits when the largest gain among those that can be made is next
    (of equal gains the smaller node)."""
    kept: list[int] = []
    queue = [(-splits[1].gain, 1)] if 1 in splits else []
    while queue and len(kept) < count:
        _, n = heapq.heappop(queue)
        kept.append(n)
        for c in (2 * n, 2 * n + 1):
            if c in splits:
                heapq.heappush(queue, (-splits[c].gain, c))
    return kept


def _values(splits: Mapping[int, _Split], sums: Mapping[int, tuple[float, int]], p: LeafwiseParams) -> dict[int, float]:
    leaves = {c for n in splits for c in (2 * n, 2 * n + 1)} - set(splits) or {1}
    return {n: -p.learning_rate * sums[n][0] / (sums[n][1] + p.l2) for n in leaves}


def train_leafwise(
    train: DataFrame, features: Sequence[str], target: str = "target", params: LeafwiseParams = LeafwiseParams(),
    edges: Mapping[str, Sequence[float]] | None = None,
) -> Ensemble:
    """M3: squared loss, starting from the mean of the target.

    Rows with a null target are left out; ``edges`` may give the bins' edges,
    else they follow the counts. An empty frame is an error.
    """
    p = params
    edges = edges or bin_edges(train, features, p.max_bins)
    # Training reads the cells many times, in as many tasks as the session sets.
    spread = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(cells(train, features, edges, target).repartition(spread), "leafwise")
    start = rows.agg(F.sum("y") / F.sum("n")).first()[0]
    if start is None:
        raise ValueError("no training rows")
    rows = rows.withColumn("margin", F.lit(float(start)))
    nodes: list[Node] = []
    for t in range(p.n_trees):
        splits, sums = grow_tree(rows.withColumn("g", F.col("n") * F.col("margin") - F.col("y")), len(features), p)
        values = _values(splits, sums, p)
        for n in [*splits, *values]:
            s = splits.get(n)
            cover = float(sums[n][1])
            if s is None:
                nodes.append(Node(t, n, -1, 0.0, -1, -1, values[n], cover))
            else:
                nodes.append(Node(t, n, s.feature, _below(edges[features[s.feature]], s.bin), 2 * n, 2 * n + 1, 0.0, cover, s.gain))
        rows = rows.withColumn("margin", F.col("margin") + _reached(splits, lambda n: F.lit(values[n])))
        if (t + 1) % WRITE_EVERY == 0 and t + 1 < p.n_trees:
            rows = materialize(rows, "leafwise")
    return Ensemble(features, nodes, float(start))


def _below(edges: Sequence[float], bin: int) -> float:
    """The threshold ``x <= t`` that sends bins up to ``bin`` left: just below the bin's upper
    edge; beyond the last edge only missing values go right."""
    return math.nextafter(edges[bin], -math.inf) if bin < len(edges) else math.inf
