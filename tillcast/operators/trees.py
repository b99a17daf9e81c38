"""Tree ensembles as node tables: scoring and additive attribution of rows (M4, M6).

An ensemble is a table of nodes: split feature and threshold (``x <= threshold``
goes left, a missing value right), children, value, and cover, the number of
training rows that reached the node. Both learners of ``ml`` hand theirs over
in this form, and it is what a saved leaf-wise model consists of.

A row's attribution splits its prediction, less the mean prediction over the
training rows, among the features: the Shapley value of the game in which a
feature outside the coalition sends the row down both branches in proportion to
their cover. In one leaf that game is a product of one factor a feature of its
path, so a leaf's shares depend only on which of its few features the row
satisfies; they are tabled for each such pattern, and a row looks them up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import ship_package

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left_child int, right_child int, "
    "value double, cover double, gain double"
)
MAX_PATH_FEATURES = 16  # a leaf's table has 2^features rows
CHUNK = 1 << 22  # numbers held at once by the look-up


@dataclass(frozen=True)
class Node:
    """``feature`` is -1 in a leaf; ``value`` counts in leaves only."""

    tree: int
    node: int
    feature: int
    threshold: float
    left: int
    right: int
    value: float
    cover: float
    gain: float = 0.0


class Ensemble:
    """``constant`` plus the value of one leaf of each tree (weights are in the values)."""

    def __init__(self, features: Sequence[str], nodes: Sequence[Node], constant: float = 0.0):
        self.features, self.nodes, self.constant = list(features), list(nodes), float(constant)
        self.by_tree: dict[int, dict[int, Node]] = {}
        for n in self.nodes:
            self.by_tree.setdefault(n.tree, {})[n.node] = n
        # A tree's root is the node that is nobody's child.
        self.roots = [
            next(iter(set(t) - {c for n in t.values() if n.feature >= 0 for c in (n.left, n.right)})) for t in self.by_tree.values()
        ]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The node table; the constant is the value of a tree -1 of one node."""
        rows = [(-1, 0, -1, 0.0, -1, -1, self.constant, 0.0, 0.0)]
        rows += [(n.tree, n.node, n.feature, n.threshold, n.left, n.right, n.value, n.cover, n.gain) for n in self.nodes]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @classmethod
    def of_frame(cls, frame: DataFrame, features: Sequence[str]) -> Ensemble:
        nodes = [Node(*r) for r in frame.orderBy("tree", "node").collect()]
        return cls(features, [n for n in nodes if n.tree >= 0], sum(n.value for n in nodes if n.tree < 0))

    @cached_property
    def leaves(self) -> list[_Leaves]:
        """All leaves, those with the same number of path features together."""
        held: dict[int, list] = {}
        for tree, root in zip(self.by_tree.values(), self.roots):
            stack = [(tree[root], {})]
            while stack:
                n, path = stack.pop()
                if n.feature < 0:
                    if len(path) > MAX_PATH_FEATURES:
                        raise ValueError(f"a path with {len(path)} features; at most {MAX_PATH_FEATURES}")
                    held.setdefault(len(path), []).append((n.value, path))
                    continue
                low, high, share = path.get(n.feature, (-math.inf, math.inf, 1.0))
                for child, box in ((n.left, (low, min(high, n.threshold))), (n.right, (max(low, n.threshold), high))):
                    part = tree[child].cover / n.cover if n.cover else 0.5
                    stack.append((tree[child], {**path, n.feature: (*box, share * part)}))
        return [_Leaves(m, found) for m, found in sorted(held.items())]

    @cached_property
    def base(self) -> float:
        """The mean prediction: every leaf weighed by its share of the cover."""
        return self.constant + sum(float((g.value * g.share.prod(axis=1)).sum()) for g in self.leaves)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of feature values (NaN: missing)."""
        out = np.full(len(x), self.constant)
        for feature, threshold, left, right, value, root, depth in self._arrays:
            at = np.full(len(x), root)
            for _ in range(depth):
                goes_left = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(feature[at] < 0, at, np.where(goes_left, left[at], right[at]))
            out += value[at]
        return out

    @cached_property
    def _arrays(self) -> list[tuple]:
        out = []
        for tree, root in zip(self.by_tree.values(), self.roots):
            place = {n: i for i, n in enumerate(tree)}
            of = lambda f: np.array([f(n) for n in tree.values()])
            depths, stack = 0, [(root, 0)]
            while stack:
                n, d = stack.pop()
                depths = max(depths, d)
                if tree[n].feature >= 0:
                    stack += [(tree[n].left, d + 1), (tree[n].right, d + 1)]
            out.append(
                (of(lambda n: n.feature), of(lambda n: n.threshold), of(lambda n: place.get(n.left, 0)),
                 of(lambda n: place.get(n.right, 0)), of(lambda n: n.value), place[root], depths)
            )
        return out

    def attribute(self, x: np.ndarray) -> np.ndarray:
        """Each feature's part of each row's prediction; a row's parts sum to prediction - base."""
        out = np.zeros((len(x), len(self.features)))
        for leaves in self.leaves:
            leaves.add_shares(x, out)
        return out


class _Leaves:
    """Leaves whose paths use ``m`` different features each."""

    def __init__(self, m: int, found: list):
        self.m = m
        self.value = np.array([v for v, _ in found])
        self.feature = np.array([list(p) for _, p in found], dtype=np.int64).reshape(len(found), m)
        box = np.array([list(p.values()) for _, p in found], dtype=np.float64).reshape(len(found), m, 3)
        self.low, self.high, self.share = box[:, :, 0], box[:, :, 1], box[:, :, 2]

    @cached_property
    def table(self) -> np.ndarray:
        """leaves x patterns x features: the Shapley value of each of a leaf's features when
        the row satisfies just the features whose bits are set."""
        m, patterns = self.m, 1 << self.m
        size = np.array([bin(p).count("1") for p in range(patterns)])
        out = np.zeros((len(self.value), patterns, m))
        for row in range(patterns):
            # The leaf's worth for each coalition: 1 or 0 for its members, the cover's share for the others.
            factor = [
                np.where((np.arange(patterns) >> k & 1)[None] == 1, float(row >> k & 1), self.share[:, k : k + 1]) for k in range(m)
            ]
            worth = self.value[:, None] * np.prod(factor, axis=0) if m else self.value[:, None]
            for k in range(m):
                without = np.flatnonzero((np.arange(patterns) >> k & 1) == 0)
                weight = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in size[without]]
                out[:, row, k] = (worth[:, without | 1 << k] - worth[:, without]) @ np.array(weight)
        return out

    def add_shares(self, x: np.ndarray, out: np.ndarray) -> None:
        m, n = self.m, len(self.value)
        if not m:
            return
        step = max(1, CHUNK // max(1, n * m))
        of_feature = [[(k, np.flatnonzero(self.feature[:, k] == f)) for k in range(m)] for f in range(out.shape[1])]
        for start in range(0, len(x), step):
            seen = x[start : start + step][:, self.feature]
            inside = (seen <= self.high) | np.isinf(self.high)
            inside &= ~(seen <= self.low)
            pattern = (inside << np.arange(m)).sum(axis=2)
            shares = self.table[np.arange(n)[None], pattern]
            for f, places in enumerate(of_feature):
                for k, at in places:
                    if len(at):
                        out[start : start + step, f] += shares[:, at, k].sum(axis=1)


def ensemble_of_gbt(model: PipelineModel, features: Sequence[str], path: str) -> Ensemble:
    """The node table of a fitted boosted pipeline, from its saved form; ``path`` is a folder
    on shared storage that the model is written to."""
    spark = SparkSession.getActiveSession()
    binner = model.stages[0] if isinstance(model.stages[0], Bucketizer) else None

    def threshold(feature: int, told: float) -> float:
        """In the feature's values where the trees split bins: just below the next bin's lower edge."""
        if binner is None:
            return told
        splits = binner.getSplitsArray()[feature]
        return math.nextafter(splits[math.floor(told) + 1], -math.inf) if math.floor(told) + 2 < len(splits) else math.inf

    model.stages[-1].write().overwrite().save(path)
    weights = model.stages[-1].treeWeights
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # trees x nodes
    nodes = []
    for r in saved:
        split = r.leftChild >= 0
        if split and r.split.numCategories >= 0:
            raise ValueError("categorical splits have no threshold")
        nodes.append(
            Node(
                r.treeID, r.id, r.split.featureIndex if split else -1,
                threshold(r.split.featureIndex, r.split.leftCategoriesOrThreshold[0]) if split else 0.0, r.leftChild, r.rightChild,
                # The first statistic is the weight of the node's rows.
                0.0 if split else r.prediction * weights[r.treeID], float(r.impurityStats[0]), float(r.gain) if split else 0.0,
            )
        )
    return Ensemble(features, nodes)


def _matrix(features: Sequence[str]):
    """Feature columns as one array column, missing values as NaN."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


def predict(ensemble: Ensemble, df: DataFrame, name: str = "prediction") -> DataFrame:
    """M4: ``df`` with one prediction a row."""
    ship_package(df.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(ensemble.predict(np.stack(rows.to_list())) if len(rows) else np.empty(0))

    return df.withColumn(name, scored(_matrix(ensemble.features)))


def attribute(ensemble: Ensemble, df: DataFrame, prefix: str = "part_") -> DataFrame:
    """M6: ``df`` with ``prediction``, ``base`` and one ``part_<feature>`` a feature.

    ``base`` plus a row's parts is its prediction. Rows are independent: no
    shuffle, and a batch's working arrays are bounded.
    """
    ship_package(df.sparkSession)
    kinds = ", ".join(["prediction double", *[f"p{i} double" for i in range(len(ensemble.features))]])

    @F.pandas_udf(kinds)
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = np.stack(rows.to_list()) if len(rows) else np.empty((0, len(ensemble.features)))
            both = np.column_stack([ensemble.predict(x), ensemble.attribute(x)])
            yield pd.DataFrame(both, columns=["prediction", *[f"p{i}" for i in range(len(ensemble.features))]])

    told = df.withColumn("_told", parts(_matrix(ensemble.features)))
    return told.select(
        *df.columns, F.col("_told.prediction").alias("prediction"), F.lit(ensemble.base).alias("base"),
        *[F.col(f"_told.p{i}").alias(prefix + f) for i, f in enumerate(ensemble.features)],
    )


def same_paths(ensemble: Ensemble, df: DataFrame, count: str = "n_rows") -> DataFrame:
    """The rows that every tree sends the same way as one: ``ensemble.features`` (the largest
    value of each) and their number.

    Rows between the same two thresholds in every feature have the same
    prediction and parts, whatever else they hold; there are at most as many
    groups as the thresholds have cells.
    """
    numbers = range(len(ensemble.features))
    splits = [
        sorted({math.nextafter(n.threshold, math.inf) for n in ensemble.nodes if n.feature == i and math.isfinite(n.threshold)}) for i in numbers
    ]
    told = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, f in enumerate(ensemble.features)])
    split = [i for i in numbers if splits[i]]
    if split:
        told = Bucketizer(
            inputCols=[f"x{i}" for i in split], outputCols=[f"b{i}" for i in split],
            splitsArray=[[-math.inf, *splits[i], math.inf] for i in split], handleInvalid="keep",
        ).transform(told)
    told = told.withColumns({f"b{i}": F.isnan(f"x{i}").cast("double") for i in numbers if i not in split})
    held = told.groupBy(*[f"b{i}" for i in numbers]).agg(
        F.count(F.lit(1)).alias(count), *[F.max(f"x{i}").alias(f) for i, f in enumerate(ensemble.features)]
    )
    # Few bytes and much work: not to be coalesced into one task.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.select(*ensemble.features, count).repartition(spread)


def attribution_summary(attributed: DataFrame, features: Sequence[str], prefix: str = "part_", count: str | None = None) -> DataFrame:
    """M6: ``feature, mean_abs, mean_part, n`` over all rows, in one aggregation; a row stands for
    as many as the column ``count`` says."""
    n = F.sum(count) if count else F.count(F.lit(1))
    mean = lambda c: F.sum(c * F.col(count)) / n if count else F.avg(c)
    aggs = [a for f in features for a in (mean(F.abs(prefix + f)).alias(f"a_{f}"), mean(F.col(prefix + f)).alias(f"m_{f}"))]
    wide = attributed.agg(n.alias("n"), *aggs)
    each = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"a_{f}").alias("mean_abs"), F.col(f"m_{f}").alias("mean_part"), "n") for f in features]
    )
    return wide.select(F.inline(each))
