import numpy as np
import pytest

from tillcast.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, v string, uid string"


def brute(rows, every=100, positives=5, top=10):
    held = []
    for i, e, label, *_ in rows:
        if i is None or e is None or label is None or any(c is None or not np.isfinite(c) for c in e):
            continue
        held.append((i, label, [int(np.floor(256 * float(np.float32(c)))) for c in e]))
    out = []
    for a, (anchor, label, q) in enumerate(held):
        if anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(q, c)), j, lab) for b, (j, lab, c) in enumerate(held) if a != b]
        scored.sort(key=lambda t: (-t[0], t[1]))
        for ps, p, _ in [t for t in scored if t[2] == label][:positives]:
            near = [t for t in scored if t[2] != label and 30 * ps <= 100 * t[0] <= 90 * ps][:top]
            out += [(anchor, p, r + 1, j, ps, s) for r, (s, j, _) in enumerate(near)]
    return sorted(out)


def rows_of(seed, n=700, width=6, copies=60):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)).astype("float32")
    v[10 : 10 + copies] = v[3]  # ties
    v[n // 2 : n // 2 + copies] = v[4] + rng.normal(scale=0.01, size=(copies, width)).astype("float32")
    return [(i, [float(c) for c in e], int(rng.integers(4)), "clash", "clash") for i, e in enumerate(v)]


@pytest.mark.parametrize("block,points,leaf", [(64, 4, 8), (4096, 16, 32)])
def test_equals_brute_force(spark, block, points, leaf):
    rows = rows_of(block)
    rows += [(100, [0.5] * 6, 1, "", ""), (800, None, 1, "", ""), (900, [1.0, None], 1, "", ""), (1000, [0.5] * 6, None, "", "")]
    rows += [(1100, [float("inf")] * 6, 0, "", ""), (None, [9.0] * 6, 0, "", ""), (1200, [0.25, 0.5], 2, "", "")]
    rows += [(1300, [], 2, "", ""), (1400, [0.0] * 6, 3, "", ""), (1500, [0.3] * 9, 1, "", ""), (-100, [0.9] * 6, 1, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives.mine(df, block=block, points=points, leaf=leaf, root_points=5, query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_single_and_one_label(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.mine(spark.createDataFrame([(0, [1.0], 1, "", "")], SCHEMA)).count() == 0
    same = spark.createDataFrame([(i, [1.0, i / 9], 1, "", "") for i in range(9)], SCHEMA)
    assert negatives.mine(same).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [1e7 * (i % 5), 2e8 + i], i % 2, "", "") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in negatives.mine(df, block=16, leaf=4, points=3).collect()) == brute(rows)


def test_ranges_eliminate_clustered_vectors():
    # 40 groups far apart: a group's window meets few of the others.
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32)) * 256
    v = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 32)) * 4)
    rows = np.arange(len(v))
    block = {"v": v, "vec_id": rows, "uid": rows, "label": rows % 3}
    tree = negatives.build(v, rows, points=16, leaf=25)
    asked = v[::100]
    whole = np.full(len(asked), negatives.LEAST), np.full(len(asked), negatives.MOST)
    searches = negatives.Searches(asked, rows[::100] % 3, rows[::100], np.arange(len(asked)), *whole, True, 5)
    negatives.visit(tree, block, searches, np.arange(len(asked)))
    assert searches.evaluated < 0.25 * len(asked) * len(v)
    scores = negatives.products(asked, v)
    for k, own in enumerate(rows[::100]):
        fits = [(-s, i) for i, s in enumerate(scores[k].tolist()) if i != own and i % 3 == own % 3]
        assert [(-s, i) for s, i in zip(searches.score[k], searches.vec_id[k])] == sorted(fits)[:5]


def test_window_of_scores_leaves_out_near_and_far(spark):
    # negatives that are too near (score above 90 %) and too far (below 30 %) never come back
    rows = [(0, [1.0, 0.0], 1, "", ""), (1, [1.0, 0.1], 1, "", ""), (2, [0.95, 0.0], 2, "", ""), (3, [0.5, 0.5], 2, "", "")]
    rows += [(4, [0.2, 0.9], 2, "", ""), (5, [0.5, 0.1], 2, "", "")]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA), anchor_every=100).collect()
    assert [(r.positive_id, r.rank, r.negative_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 3), (1, 2, 5)]


def test_parts_and_groups_of_any_number_agree(spark):
    rows = rows_of(11, n=900, copies=150)
    rows += [(100 * i, rows[100 * i][1], 3, "", "") for i in range(9)]  # anchors with a copy of another label
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    for held in (20_000, 1 << 30):
        got = negatives.mine(df, block=40, points=3, leaf=5, root_points=7, query_block=2, held=held)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_nothing_that_grows_goes_through_the_driver(spark):
    # A sort by range samples rows on the driver for each block; queries sent to each part of the
    # blocks must not become a broadcast, however small their own table is.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    plans = []
    try:
        with pytest.MonkeyPatch.context() as patch:
            kept = negatives.stored
            patch.setattr(negatives, "stored", lambda df, name: (plans.append(df), kept(df, name))[1])
            plans.append(negatives.mine(spark.createDataFrame(rows_of(7), SCHEMA), block=64, root_points=5, query_block=3))
            plans[-1].collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 7
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "rangepartitioning" not in plan


def test_parts_cost_no_more_than_the_blocks():
    # 15 million vectors in 3 GB of blocks, 300 blocks of queries: each part costs their copy and what is handed on.
    size, asked = 3 << 30, 40 << 20
    parts, groups = negatives.deal(size, 4200, asked, 300, 770_000, 10, 12, 128 << 20)
    assert (parts, groups) == (24, 1)
    assert parts * asked < size
    parts, groups = negatives.deal(size, 4200, asked, 300, 770_000, 10, 400, 128 << 20)
    assert (parts, groups) == (24, 17)  # more cores: more groups, not more rows handed on
    assert negatives.deal(10 << 20, 13, 140_000, 2, 513, 5, 12, 128 << 20) == (12, 1)
    assert negatives.deal(0, 0, 0, 0, 0, 5, 12, 128 << 20) == (1, 1)
    assert negatives.deal(size, 9, asked, 300, 770_000, 10, 12, 1)[0] == 9  # no part without a block


def test_handed_on_rows_are_bounded_by_the_wanted_ones_of_a_part():
    rng = np.random.default_rng(3)
    v = rng.integers(-60, 60, size=(600, 8)).astype(float)
    root = negatives.farthest_points(v, 4)
    blocks = []
    for start in range(0, 600, 100):
        at = np.arange(start, start + 100)
        block = {"v": v[at], "vec_id": at, "uid": at, "label": at % 3, "tree": negatives.build(v[at], np.arange(100), 3, 10)}
        far, norm2 = negatives.distances(v[at], root), np.square(v[at]).sum(axis=1)
        block |= {"near": far.min(axis=0), "far": far.max(axis=0), "least2": np.array([norm2.min()]), "most2": np.array([norm2.max()])}
        blocks.append(block)
    asks = np.arange(0, 600, 50)
    asked = {"v": v[asks], "vec_id": asks, "uid": asks, "label": asks % 3, "of": np.arange(12), "number": np.zeros(12, dtype=np.int64)}
    asked |= {"low": np.full(12, negatives.LEAST), "high": np.full(12, negatives.MOST)}
    found = negatives._meet(asked, blocks, root, True, 5)
    assert len(found) == 12 * 5  # not 5 for each of the six blocks
    scores = negatives.products(v[asks], v).astype(int)
    for k, own in enumerate(asks):
        fits = sorted((-s, i) for i, s in enumerate(scores[k].tolist()) if i != own and i % 3 == own % 3)[:5]
        mine = found[found["anchor_uid"] == own]
        assert sorted(zip(-mine["score"], mine["vec_id"])) == fits
