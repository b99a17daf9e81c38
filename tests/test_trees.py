"""Node tables, attribution against all coalitions, leaf-wise boosting."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import leafwise, ml, trees
from tillcast.operators.leafwise import LeafwiseParams
from tillcast.operators.trees import Ensemble, Node
from tillcast.session import checkpoint_dir


def worth(tree, root, x, coalition):
    """Follow x for members of the coalition, both branches by cover for the others."""
    n = tree[root]
    if n.feature < 0:
        return n.value
    if n.feature in coalition:
        return worth(tree, n.left if x[n.feature] <= n.threshold else n.right, x, coalition)
    return sum(tree[c].cover / n.cover * worth(tree, c, x, coalition) for c in (n.left, n.right))


def shapley(e, x):
    m, out = len(e.features), np.zeros(len(e.features))
    for tree, root in zip(e.by_tree.values(), e.roots):
        for f in range(m):
            others = [g for g in range(m) if g != f]
            for size in range(m):
                for s in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                    out[f] += w * (worth(tree, root, x, {*s, f}) - worth(tree, root, x, set(s)))
    return out


def random_ensemble(seed, n_features=5, n_trees=4, depth=5):
    rng = np.random.default_rng(seed)
    nodes = []

    def grow(t, n, level, cover):
        if level == depth or cover < 2 or rng.random() < 0.15:
            nodes.append(Node(t, n, -1, 0.0, -1, -1, float(rng.normal()), cover))
            return
        left = float(rng.integers(1, int(cover)))
        nodes.append(Node(t, n, int(rng.integers(n_features)), float(rng.normal()), 2 * n, 2 * n + 1, 0.0, cover))
        grow(t, 2 * n, level + 1, left)
        grow(t, 2 * n + 1, level + 1, cover - left)

    for t in range(n_trees):
        grow(t, 1, 0, 1000.0)
    return Ensemble([f"f{i}" for i in range(n_features)], nodes, 2.5)


@pytest.mark.parametrize("seed", range(4))
def test_attribution_equals_all_coalitions(seed):
    e = random_ensemble(seed)
    x = np.random.default_rng(seed + 100).normal(size=(40, 5))
    x[3, 2] = x[5, 0] = np.nan
    parts = e.attribute(x)
    for row, got in zip(x, parts):
        assert np.allclose(got, shapley(e, row), atol=1e-12)
    assert np.allclose(parts.sum(axis=1) + e.base, e.predict(x))


def test_gbt_as_a_node_table(spark):
    df = spark.range(3000).select(
        (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        ((F.col("id") * 7919) % 101).cast("double").alias("c"),
    ).withColumn("target", F.col("a") * 3 + F.col("b") * F.col("c") / 10)
    model = ml.train_gbt(df, ["a", "b", "c"], n_trees=5)
    e = trees.ensemble_of_gbt(model, ["a", "b", "c"], f"{checkpoint_dir(spark)}/trees-test")
    both = trees.attribute(e, model.transform(df).select("a", "b", "c", F.col("prediction").alias("spark_prediction"))).toPandas()
    assert np.allclose(both.prediction, both.spark_prediction)
    assert np.allclose(both.base + both.part_a + both.part_b + both.part_c, both.prediction)
    # every training row is in the cover, so the base is the mean prediction over them
    assert abs(both.base[0] - both.prediction.mean()) < 1e-9
    summary = {r.feature: r for r in trees.attribution_summary(trees.attribute(e, df), e.features).collect()}
    assert summary["a"].n == 3000 and abs(summary["a"].mean_abs - both.part_a.abs().mean()) < 1e-9
    assert abs(sum(r.mean_part for r in summary.values())) < 1e-9
    back = Ensemble.of_frame(e.frame(spark), e.features)
    x = df.select("a", "b", "c").limit(50).toPandas().to_numpy()
    assert np.allclose(back.predict(x), e.predict(x)) and back.base == pytest.approx(e.base)


def one_at_a_time(x, y, p):
    """Plain best-first growth of one tree: the leaf with the largest gain is split next."""

    def best(rows):
        g, found = (y.mean() - y)[rows], None
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f]):
                left = x[rows, f] <= t
                hl, hr = left.sum(), (~left).sum()
                if min(hl, hr) < max(1, p.min_rows):
                    continue
                gl, gr = g[left].sum(), g[~left].sum()
                gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - g.sum() ** 2 / (len(g) + p.l2)
                if gain > p.min_gain and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, t)
        return found

    leaves, splits = {1: np.arange(len(x))}, {}
    while len(leaves) < p.max_leaves:
        options = {n: best(r) for n, r in leaves.items() if n < 1 << p.max_depth}
        options = {n: o for n, o in options.items() if o}
        if not options:
            break
        n = max(options, key=lambda k: options[k][0])
        _, f, t = splits[n] = options[n]
        rows = leaves.pop(n)
        left = x[rows, f] <= t
        leaves[2 * n], leaves[2 * n + 1] = rows[left], rows[~left]
    return splits, {n: -p.learning_rate * (y.mean() - y)[r].sum() / (len(r) + p.l2) for n, r in leaves.items()}


@pytest.mark.parametrize("leaves,depth,l2,crossed", [(4, 6, 0.0, False), (9, 3, 1.0, False), (2, 6, 0.5, False), (3, 4, 0.0, True), (7, 4, 1.0, True)])
def test_levels_grow_the_same_tree_as_one_leaf_at_a_time(spark, leaves, depth, l2, crossed):
    """``crossed``: the root's gain is smaller than those below it."""
    rng = np.random.default_rng(leaves)
    x = rng.integers(0, 9, size=(700, 3)).astype(float)
    y = np.where(x[:, 0] > 5, x[:, 1] ** 2, x[:, 2]) + rng.normal(size=700)
    if crossed:
        y = np.where((x[:, 0] > 4) ^ (x[:, 1] > 3), 30.0, 0.0) + 9 * (x[:, 0] > 4) * (x[:, 1] > 3) + rng.normal(size=700)
    p = LeafwiseParams(n_trees=1, max_leaves=leaves, max_depth=depth, min_rows=15, l2=l2)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, target double")
    e = leafwise.train_leafwise(df, ["a", "b", "c"], params=p, edges={c: [float(v) for v in range(9)] for c in "abc"})
    splits, values = one_at_a_time(x, y, p)
    got = e.by_tree[0]
    assert {n: (s.feature, math.floor(s.threshold)) for n, s in got.items() if s.feature >= 0} == {n: (f, int(t)) for n, (_, f, t) in splits.items()}
    for n, v in values.items():
        assert got[n].value == pytest.approx(v) and got[n].feature < 0


def test_boosting_fits_and_differs_from_the_other_learner(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(2000, 3))
    y = np.sin(6 * x[:, 0]) * 4 + 3 * (x[:, 1] > 0.7) + rng.normal(scale=0.1, size=2000)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 0.5, None, 1.0), (0.5, 0.5, 0.5, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, target double")
    p = LeafwiseParams(n_trees=9, learning_rate=0.5, max_leaves=12, max_depth=4, max_bins=64)
    e = leafwise.train_leafwise(df, ["a", "b", "c"], params=p)
    pred = e.predict(x)
    assert 1 - ((pred - y) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.95
    scored = trees.predict(e, df).select("prediction").toPandas()
    assert len(scored) == len(rows) and np.allclose(scored.prediction[:2000], pred)
    assert max(len(t) for t in e.by_tree.values()) <= 2 * 12 - 1
    gbt = trees.ensemble_of_gbt(ml.train_gbt(df.dropna(), ["a", "b", "c"], n_trees=2), e.features, f"{checkpoint_dir(spark)}/trees-other")
    shape = lambda t: sorted((n.feature, round(n.threshold, 9)) for n in t.values())
    assert shape(gbt.by_tree[0]) != shape(e.by_tree[0])


def test_one_aggregation_a_level(spark):
    rows = spark.range(100).select((F.col("id") % 5).cast("int").alias("b0"), F.col("id").cast("double").alias("g"))
    found = leafwise._best_splits(rows, {}, [1], 1, LeafwiseParams(min_rows=1))
    assert len(found) == 1 and found[0].h == 100


def test_constant_target_and_empty_frame(spark):
    flat = spark.createDataFrame([(float(i), 3.0) for i in range(50)], "a double, target double")
    e = leafwise.train_leafwise(flat, ["a"], params=LeafwiseParams(n_trees=2))
    assert np.allclose(e.predict(np.array([[1.0], [np.nan]])), 3.0) and len(e.by_tree[0]) == 1
    with pytest.raises(ValueError):
        leafwise.train_leafwise(flat.limit(0), ["a"])


def test_leafwise_trains_on_cells(spark, monkeypatch):
    """Rows that share all bins are one cell; the nodes count rows."""
    df = spark.range(5000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b")).withColumn(
        "target", F.col("a") + F.col("b") * 3
    )
    sizes = []
    grow = leafwise.grow_tree
    monkeypatch.setattr(leafwise, "grow_tree", lambda rows, n, p: sizes.append(rows.count()) or grow(rows, n, p))
    e = leafwise.train_leafwise(df, ["a", "b"], "target", LeafwiseParams(n_trees=2))
    assert sizes == [14, 14]
    assert {t[r].cover for t, r in zip(e.by_tree.values(), e.roots)} == {5000.0}


def test_rows_on_the_same_paths_are_attributed_once(spark):
    e = random_ensemble(5, n_features=3, n_trees=3, depth=3)
    df = spark.range(4000).select(
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(9)) / 2.0 - 2).alias(f) for i, f in enumerate(e.features)]
    ).withColumn("f1", F.when(F.rand(1) > 0.1, F.col("f1")))
    held = trees.same_paths(e, df)
    assert held.count() < 700 and held.agg(F.sum("n_rows")).first()[0] == 4000
    one = {r.feature: r for r in trees.attribution_summary(trees.attribute(e, held), e.features, count="n_rows").collect()}
    for r in trees.attribution_summary(trees.attribute(e, df), e.features).collect():
        assert one[r.feature].n == r.n == 4000
        assert abs(one[r.feature].mean_abs - r.mean_abs) < 1e-9 and abs(one[r.feature].mean_part - r.mean_part) < 1e-9
