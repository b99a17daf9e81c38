"""Hard negatives by a multiway hyperplane tree (GNAT) over the vectors.

Every vector belongs to the nearest of a node's split points, and each split
point keeps the range of its distances to the vectors of every sibling subtree.
A search is a window of scores ``[low, high]`` for one vector. With
``<q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2`` and the range of ``|x|^2`` in a
subtree the window becomes an annulus of distances around the query; a subtree
is left out when for some split point the triangle inequality keeps its whole
range of distances outside that annulus. Leaves are evaluated exactly, in
integers. The lower end of a window rises to the worst of the best found.

The root's split points come from a bounded sample. The driver counts each of the
root's subtrees, at most 64, and so knows how many blocks each one fills: a row's
block follows from its subtree and its hash, without a sort of all rows by range,
whose sample on the driver grows with the number of blocks. Every block carries
the root's ranges and holds the rest of its tree. A task holds a part of the
blocks, of bounded size, and is sent the queries in blocks: each search goes
through all blocks of the part, and a task hands on at most the wanted rows of it.

Mining is two searches over the same blocks: an anchor's nearest rows of its own
label, then for each of these positives a window of scores among other labels.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import give_back_memory, prepare, released, stored

LEVELS = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
ROOT_POINTS = 64
ROOT_SAMPLE = 4096
POINTS = 16
LEAF = 64
BLOCK = 4096
QUERY_BLOCK = 512
HELD_BYTES = 128 << 20  # packed blocks that a task of a search holds
PACKED_TOGETHER = 16  # blocks that a task packs one after the other
TOGETHER = 512  # rows compared at once
TRIED, PAYING, AGAIN = 1 << 16, 0.05, 8  # see Searches.worth_testing
LEAST, MOST = -(1 << 63), (1 << 63) - 1
_EXACT = float(1 << 53)
_EXACT_SINGLE = float(1 << 24)


def usable(vectors: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``vec_id, label, v, uid``: components as floor(levels * x). Rows with a null id, label
    or vector, or with a null or non-finite component, take no part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(levels))).cast("double"))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole.alias("v"),
        F.monotonically_increasing_id().alias("uid"),
    )


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, queries x rows: exact in floating point while all sums
    stay below its limit, else by integers and held within 64 bits. The shorter end in zeros."""
    width = min(queries.shape[1], rows.shape[1])
    queries, rows = queries[:, :width], rows[:, :width]
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, width)
    if most < _EXACT_SINGLE:
        return queries.astype(np.float32, copy=False) @ rows.astype(np.float32, copy=False).T
    if most < _EXACT:
        return queries.astype(np.float64, copy=False) @ rows.astype(np.float64, copy=False).T
    wide = [[int(c) for c in r] for r in rows]
    exact = [[max(LEAST, min(MOST, sum(a * b for a, b in zip(map(int, q), r)))) for r in wide] for q in queries]
    return np.array(exact, dtype=np.int64).reshape(len(queries), len(rows))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows of ``a`` x rows of ``b``; the shorter end in zeros."""
    a, b = a.astype(np.float64, copy=False), b.astype(np.float64, copy=False)
    width = min(a.shape[1], b.shape[1])
    squares = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None] - 2 * (a[:, :width] @ b[:, :width].T)
    return np.sqrt(np.maximum(squares, 0))


def farthest_points(v: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest from those before."""
    taken = [0]
    gap = distances(v, v[:1])[:, 0]
    while len(taken) < min(count, len(v)):
        far = int(gap.argmax())
        if gap[far] <= 1e-3:
            break
        taken.append(far)
        gap = np.minimum(gap, distances(v, v[far : far + 1])[:, 0])
    return v[taken]


class Searches:
    """Searches over a few vectors and the best rows found for each.

    ``of`` names each search's vector; ``low`` and ``high`` its window of scores;
    ``same`` whether the label must equal the vector's or differ from it. A vector's
    searches go through a tree together, within the widest window of them.
    """

    def __init__(self, v, label, uid, of, low, high, same: bool, top: int):
        self.v, self.label, self.uid = _small(v), label, uid
        self.norm2 = np.square(v, dtype=np.float64).sum(axis=1)
        self.of, self.low, self.high = of, low.copy(), high
        self.same, self.top = same, top
        self.score = np.full((len(of), top), LEAST, dtype=np.int64)
        self.found = np.full((len(of), top), -1, dtype=np.int64)  # the row's uid; -1: none
        self.vec_id = np.full((len(of), top), MOST, dtype=np.int64)
        self.evaluated = 0  # vectors compared with, split points included
        self.tested = self.gone = self.passed = 0
        self.order = np.argsort(of, kind="stable")  # a vector's searches stand together
        self.start = np.searchsorted(of[self.order], np.arange(len(v) + 1))
        self.most = np.full(len(v), LEAST, dtype=np.int64)
        np.maximum.at(self.most, of, high)
        self._narrow()

    def _narrow(self) -> None:
        """The lower end of each vector's widest window; whether all its searches have enough."""
        self.least = np.full(len(self.v), MOST, dtype=np.int64)
        np.minimum.at(self.least, self.of, self.low)
        self.full = np.ones(len(self.v), dtype=bool)
        np.logical_and.at(self.full, self.of, self.found[:, -1] >= 0)

    def evaluate(self, active: np.ndarray, block: dict, rows: np.ndarray, met: np.ndarray | None = None) -> None:
        """Compare the vectors ``active`` with some rows of the block, exactly; ``met``, vectors x
        rows, tells which of the pairs count."""
        self.evaluated += len(active) * len(rows) if met is None else int(met.sum())
        scores = products(self.v[active], block["v"][rows])
        # A limit that single precision cannot hold lies beyond every score held in it.
        low = self.least[active].astype(scores.dtype)
        some = np.flatnonzero(scores.max(axis=1) >= low)
        if not len(some):
            return
        hit = scores[some] >= low[some, None]
        if met is not None:
            hit &= met[some]
        label_fits = self.label[active[some]][:, None] == block["label"][rows][None]
        hit &= label_fits if self.same else ~label_fits
        i, r = np.nonzero(hit)
        if not len(i):
            return
        asked, score, uid, vec_id = active[some[i]], scores[some[i], r].astype(np.int64), block["uid"][rows[r]], block["vec_id"][rows[r]]
        # Each of the vector's searches looks at the row.
        count = self.start[asked + 1] - self.start[asked]
        row = np.repeat(np.arange(len(asked)), count)
        first = np.cumsum(count) - count
        at = self.order[self.start[asked[row]] + np.arange(len(row)) - first[row]]
        fits = (score[row] <= self.high[at]) & (self.uid[asked[row]] != uid[row])
        fits &= (score[row] > self.low[at]) | ((score[row] == self.low[at]) & (vec_id[row] <= self.vec_id[at, -1]))
        if fits.any():
            at, row = at[fits], row[fits]
            self._keep(at, score[row], vec_id[row], uid[row])

    def _keep(self, at: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        """The best of what the searches ``at`` have and of these rows."""
        touched, back = np.unique(at, return_inverse=True)
        owner = np.concatenate((np.repeat(np.arange(len(touched)), self.top), back))
        score = np.concatenate((self.score[touched].ravel(), score))
        vec_id = np.concatenate((self.vec_id[touched].ravel(), vec_id))
        uid = np.concatenate((self.found[touched].ravel(), uid))
        # ~score orders downwards without the overflow of -score
        order = np.lexsort((uid, vec_id, ~score, uid < 0, owner))
        owner = owner[order]
        rank = np.arange(len(order)) - np.searchsorted(owner, owner)
        order, to, rank = order[rank < self.top], touched[owner[rank < self.top]], rank[rank < self.top]
        self.score[to, rank], self.vec_id[to, rank], self.found[to, rank] = score[order], vec_id[order], uid[order]
        full = touched[self.found[touched, -1] >= 0]
        self.low[full] = np.maximum(self.low[full], self.score[full, -1])
        self._narrow()

    def worth_testing(self) -> bool:
        """Whether to look for subtrees to leave out: once the tests have left out next to none,
        only at every ``AGAIN``-th node; the others are compared as a whole."""
        if self.tested < TRIED or self.gone >= PAYING * self.tested:
            return True
        self.passed += 1
        return self.passed % AGAIN == 0

    def reach(self, active: np.ndarray, far: np.ndarray, near_r, far_r) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most distance of the vectors to each subtree. ``far``: distances of the
        vectors to the split points; ``near_r, far_r``: split points x subtrees."""
        lower = np.maximum(far[:, :, None] - far_r[None], near_r[None] - far[:, :, None]).max(axis=1)
        upper = (far[:, :, None] + far_r[None]).min(axis=1)
        slack = 1e-6 * (1 + upper + np.sqrt(self.norm2[active])[:, None])  # room for rounding of the roots
        return np.maximum(lower - slack, 0), upper + slack

    def outside(self, active: np.ndarray, lower: np.ndarray, upper: np.ndarray, least2, most2) -> np.ndarray:
        """Which vectors x subtrees cannot meet. ``least2, most2``: squared norms in the subtrees."""
        q2 = self.norm2[active][:, None]
        # Squared annulus of the window [least, most] for vectors of those norms.
        inner2 = q2 + least2[None] - 2 * self.most[active].astype(np.float64)[:, None]
        outer2 = q2 + most2[None] - 2 * self.least[active].astype(np.float64)[:, None]
        inner2, outer2 = inner2 - 1 - 1e-9 * np.abs(inner2), outer2 + 1 + 1e-9 * np.abs(outer2)
        return (np.square(lower) > outer2) | (np.square(upper) < inner2)


def build(v: np.ndarray, rows: np.ndarray, points: int = POINTS, leaf: int = LEAF):
    """The tree over some rows: an array of rows for a leaf, else a node as a dict."""
    if len(rows) <= leaf:
        return rows
    held = v[rows]
    split = farthest_points(held[:: max(1, len(rows) // (3 * points))], points)
    far = distances(held, split)
    nearest = far.argmin(axis=1)
    used = np.unique(nearest)
    if len(used) < 2:
        return rows
    parts = [np.flatnonzero(nearest == j) for j in used]
    norm2 = np.square(held).sum(axis=1)
    return {
        "rows": rows,
        "split": _small(split),
        "home": used,
        "near": np.stack([far[p].min(axis=0) for p in parts], axis=1),
        "far": np.stack([far[p].max(axis=0) for p in parts], axis=1),
        "least2": np.array([norm2[p].min() for p in parts]),
        "most2": np.array([norm2[p].max() for p in parts]),
        "children": [build(v, rows[p], points, leaf) for p in parts],
    }


def visit(node, block: dict, searches: Searches, active: np.ndarray) -> None:
    """Search a subtree with some vectors: while one of them has not found enough, first each
    one's own subtree, then the others that its window meets."""
    if not len(active):
        return
    leaf = not isinstance(node, dict)
    if leaf or not searches.worth_testing():
        rows = node if leaf else node["rows"]
        for start in range(0, len(rows), TOGETHER):
            searches.evaluate(active, block, rows[start : start + TOGETHER])
        return
    far = distances(searches.v[active], node["split"])
    searches.evaluated += far.size
    lower, upper = searches.reach(active, far, node["near"], node["far"])
    left = np.ones_like(lower, dtype=bool)
    if not searches.full[active].all():
        own = far[:, node["home"]].argmin(axis=1)[:, None] == np.arange(len(node["children"]))[None]
        _descend(node, block, searches, active, own & ~searches.outside(active, lower, upper, node["least2"], node["most2"]))
        left &= ~own
    gone = searches.outside(active, lower, upper, node["least2"], node["most2"])
    searches.tested += gone.size
    searches.gone += int(gone.sum())
    _descend(node, block, searches, active, left & ~gone)


def _descend(node: dict, block: dict, searches: Searches, active: np.ndarray, chosen: np.ndarray) -> None:
    """Search the ``chosen`` subtrees, vectors x subtrees. Leaves that most of the vectors meet
    are compared together, and what does not count is left out of the result."""
    leaves = [(j, child) for j, child in enumerate(node["children"]) if not isinstance(child, dict)]
    some = chosen.any(axis=1)
    near = [j for j, child in leaves if len(child) <= TOGETHER and 2 * chosen[:, j].sum() > some.sum()]
    kept: list[int] = []
    for j in near:
        kept.append(j)
        if j == near[-1] or sum(len(node["children"][k]) for k in kept) >= TOGETHER:
            asks = np.flatnonzero(chosen[:, kept].any(axis=1))
            met = chosen[np.ix_(asks, kept)]
            rows = [node["children"][k] for k in kept]
            met = None if met.all() else np.repeat(met, [len(r) for r in rows], axis=1)
            searches.evaluate(active[asks], block, np.concatenate(rows), met)
            kept = []
    together = set(near)
    for j, child in enumerate(node["children"]):
        if j not in together:
            visit(child, block, searches, active[chosen[:, j]])


def search_block(block: dict, searches: Searches, root_far: np.ndarray) -> None:
    """Search one block, unless the root's ranges leave it out. ``root_far``: distances of the
    searches' vectors to the root's split points."""
    active = np.arange(len(searches.v))
    if len(active):
        lower, upper = searches.reach(active, root_far, block["near"][:, None], block["far"][:, None])
        gone = searches.outside(active, lower, upper, block["least2"], block["most2"])[:, 0]
        visit(block["tree"], block, searches, active[~gone])


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows, filled with zeros, which adds nothing to a product."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _small(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int16) if np.abs(v).max(initial=0) < 1 << 15 else v


def choose_root(rows: DataFrame, points: int = ROOT_POINTS, sample: int = ROOT_SAMPLE) -> np.ndarray:
    """The root's split points, far from one another, of a sample drawn by a hash of the vectors."""
    hashed = rows.select("v", F.xxhash64("v").alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return np.zeros((0, 0))
    drawn = hashed.where(F.col("h") <= last).dropDuplicates(["h"]).orderBy("h").toPandas()["v"]
    return farthest_points(_matrix(drawn, max(map(len, drawn))), points)


def _nearest(rows: DataFrame, root: np.ndarray) -> DataFrame:
    """Rows with the number of their subtree of the root."""

    @F.pandas_udf("int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            wide = max([root.shape[1], *map(len, vectors)])
            far = distances(_matrix(vectors, wide), _matrix(root, wide))
            yield pd.Series(far.argmin(axis=1).astype(np.int32))

    return rows.withColumn("cell", cell("v"))


def pack_blocks(rows: DataFrame, root: np.ndarray, size: int = BLOCK, points: int = POINTS, leaf: int = LEAF) -> DataFrame:
    """``block, bytes``: rows of like subtrees in blocks of up to ``size``, each with its tree."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        number, held = -1, 0
        for frame in frames:
            cuts = np.flatnonzero(np.diff(frame["block"].to_numpy())) + 1
            for start, end in zip([0, *cuts], [*cuts, len(frame)]):
                rest = frame.iloc[start:end]
                if kept and int(rest["block"].iloc[0]) != number:
                    yield _packed(number, pd.concat(kept), root, points, leaf)
                    kept, held = [], 0
                number = int(rest["block"].iloc[0])
                while len(rest):
                    take = rest.iloc[: size - held]
                    kept.append(take)
                    held += len(take)
                    rest = rest.iloc[len(take) :]
                    if held == size:
                        yield _packed(number, pd.concat(kept), root, points, leaf)
                        kept, held = [], 0
        if held:
            yield _packed(number, pd.concat(kept), root, points, leaf)
        give_back_memory()

    # A subtree's blocks are about 9/10 full, so that few overflow; one with a third of all rows is cut like any other.
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    filled = [-(-counts.get(cell, 0) * 10 // (9 * size)) for cell in range(max(1, len(root)))]
    before = [0, *accumulate(filled)]
    total = max(1, before[-1])

    def of_cell(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast("long") for x in values]), F.col("cell") + 1)

    block = of_cell(before[:-1]) + F.pmod(F.xxhash64("uid"), of_cell([max(1, n) for n in filled]))
    tasks = max(-(-total // PACKED_TOGETHER), min(total, 2 * rows.sparkSession.sparkContext.defaultParallelism))
    dealt = rows.select(block.alias("block"), "vec_id", "label", "v", "uid")
    dealt = dealt.repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int")).sortWithinPartitions("block")
    return dealt.mapInPandas(pack, "block long, bytes binary")


def _packed(number: int, rows: pd.DataFrame, root: np.ndarray, points: int, leaf: int) -> pd.DataFrame:
    v = _matrix(rows["v"], max([root.shape[1], *map(len, rows["v"])]))
    far = distances(v, _matrix(root, v.shape[1]))
    norm2 = np.square(v).sum(axis=1)
    block = {
        "v": _small(v),
        "vec_id": rows["vec_id"].to_numpy(dtype=np.int64),
        "label": rows["label"].to_numpy(dtype=np.int64),
        "uid": rows["uid"].to_numpy(dtype=np.int64),
        "near": far.min(axis=0),
        "far": far.max(axis=0),
        "least2": np.array([norm2.min()]),
        "most2": np.array([norm2.max()]),
        "tree": build(v, np.arange(len(v), dtype=np.int32), points, leaf),
    }
    return pd.DataFrame([(number, pickle.dumps(block, pickle.HIGHEST_PROTOCOL))], columns=["block", "bytes"])


def _pack_queries(queries: DataFrame, size: int) -> DataFrame:
    """``ask, searches, asked``: vectors with their searches, ``vec_id, label, v, uid, windows``, in blocks."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), size):
                part = frame.iloc[start : start + size]
                of = np.repeat(np.arange(len(part)), [len(w) for w in part["windows"]])
                flat = [w if isinstance(w, dict) else w.asDict() for windows in part["windows"] for w in windows]
                asked = {
                    "v": _small(_matrix(part["v"], max(map(len, part["v"])))),
                    "vec_id": part["vec_id"].to_numpy(dtype=np.int64),
                    "label": part["label"].to_numpy(dtype=np.int64),
                    "uid": part["uid"].to_numpy(dtype=np.int64),
                    "of": of,
                    "number": np.array([w["number"] for w in flat], dtype=np.int64),
                    "low": np.array([w["low"] for w in flat], dtype=np.int64),
                    "high": np.array([w["high"] for w in flat], dtype=np.int64),
                }
                packed = (int(part["uid"].iloc[0]), len(of), pickle.dumps(asked, pickle.HIGHEST_PROTOCOL))
                yield pd.DataFrame([packed], columns=["ask", "searches", "asked"])

    dealt = queries.select("vec_id", "label", "v", "uid", "windows")
    dealt = dealt.repartition(max(1, -(-dealt.count() // size)))
    return dealt.mapInPandas(pack, "ask long, searches long, asked binary")


_FOUND = "anchor_id long, anchor_uid long, number long, vec_id long, uid long, score long"
_FOUND_BYTES = 48


def deal(size: int, count: int, asked_size: int, asks: int, searches: int, top: int, wanted: int, held: int) -> tuple[int, int]:
    """Into how many parts the blocks and into how many groups the queries are dealt; each part
    meets each group in a task. Every part costs a copy of the queries and the wanted rows of
    each search, every group a copy of the blocks: up to ``wanted`` tasks, more parts than ``held``
    bytes of blocks need are made only while their cost stays below the blocks' size."""
    cost = max(1, asked_size + _FOUND_BYTES * top * searches)
    parts = max(1, min(count, max(-(-size // held), min(wanted, size // cost))))
    return parts, max(1, min(asks, -(-wanted // parts)))


def search(
    blocks: DataFrame, queries: DataFrame, root: np.ndarray, same: bool, top: int, query_block: int = QUERY_BLOCK, held: int = HELD_BYTES
) -> DataFrame:
    """``anchor_id, anchor_uid, number, vec_id, uid, score, rank``: the ``top`` best rows of
    each window (``number``) of each query. ``blocks`` must be a written table."""
    asked = stored(_pack_queries(queries, query_block), "negatives_asked")
    size, count = blocks.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)), F.count("*")).first()
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in (F.octet_length("asked"), F.col("searches"))]
    asked_size, searches, asks = asked.agg(*sums, F.count("*")).first()
    wanted = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    parts, groups = deal(size, count, asked_size, asks, searches, top, wanted, held)

    # Nothing is joined: a join could send one side, once for each task, to the driver for a broadcast.
    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    part = F.pmod("block", F.lit(parts)).cast("int")
    group = F.pmod(F.xxhash64("ask"), F.lit(groups)).cast("int")
    held_rows = blocks.select("bytes", part.alias("part"), every(groups).alias("group")).withColumn("asks", F.lit(False))
    ask_rows = asked.select(F.col("asked").alias("bytes"), every(parts).alias("part"), group.alias("group"), F.lit(True).alias("asks"))
    dealt = held_rows.unionByName(ask_rows).select((F.col("part") * groups + F.col("group")).alias("task"), "asks", "bytes")
    dealt = dealt.repartitionById(parts * groups, "task").sortWithinPartitions("asks").select("asks", "bytes")

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part: list[dict] = []
        for frame in frames:
            for is_ask, packed in zip(frame["asks"], frame["bytes"]):
                if is_ask:
                    yield _meet(pickle.loads(packed), part, root, same, top)
                else:
                    part.append(pickle.loads(packed))
        part.clear()
        give_back_memory()

    found = dealt.mapInPandas(meet, _FOUND)
    first = Window.partitionBy("anchor_uid", "number").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)


def _meet(asked: dict, part: list[dict], root: np.ndarray, same: bool, top: int) -> pd.DataFrame:
    """The best of a part's blocks for one block of queries."""
    searches = Searches(asked["v"], asked["label"], asked["uid"], asked["of"], asked["low"], asked["high"], same, top)
    root_far = distances(asked["v"], root)
    for block in part:
        search_block(block, searches, root_far)
    at, k = np.nonzero(searches.found >= 0)
    of = searches.of[at]
    return pd.DataFrame(
        {
            "anchor_id": asked["vec_id"][of],
            "anchor_uid": asked["uid"][of],
            "number": asked["number"][at],
            "vec_id": searches.vec_id[at, k],
            "uid": searches.found[at, k],
            "score": searches.score[at, k],
        }
    )


def mine(
    vectors: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    root_points: int = ROOT_POINTS,
    block: int = BLOCK,
    points: int = POINTS,
    leaf: int = LEAF,
    query_block: int = QUERY_BLOCK,
    held: int = HELD_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, embedding, label``; other columns are not read, so
    they may have any name. Anchors are the rows whose id is divisible by
    ``anchor_every``; an anchor's positives are its ``positives`` best other
    rows of the same label; the negatives of a positive are the ``negatives``
    best rows of another label whose score lies between ``low_percent`` and
    ``high_percent`` of the positive's (0 <= low < high; a positive with a negative
    score has none). Ties go to the smaller id. Vectors of
    different lengths are compared as if the shorter ended in zeros. A repeated
    row is a row like any other. Rows with a null in id, label, vector or any
    component take no part; an empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    plain = stored(usable(vectors), "negatives_usable")
    root = choose_root(plain, root_points)
    if not len(root):
        return vectors.sparkSession.createDataFrame([], _MINED)
    rows = stored(_nearest(plain, root), "negatives_rows")
    released(plain)
    blocks = stored(pack_blocks(rows, root, block, points, leaf), "negatives_blocks")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)

    # LEAST and the others are literals of one struct: a window without ends.
    whole = F.array(F.struct(F.lit(0).cast("long").alias("number"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")))
    best = stored(search(blocks, anchors.withColumn("windows", whole), root, True, positives, query_block, held), "negatives_positives")

    # low_percent * p <= 100 * s <= high_percent * p for whole s, without leaving 64 bits.
    hundreds, rest = F.expr("score div 100"), F.expr("score % 100")
    low = hundreds * low_percent + F.ceil(rest * low_percent / 100)
    high = hundreds * high_percent + F.floor(rest * high_percent / 100)
    best_of = best.where("score >= 0")  # for a negative score the two ends cross
    windows = best_of.select("anchor_uid", F.col("rank").cast("long").alias("number"), low.alias("low"), high.alias("high"))
    windows = windows.where("low <= high").groupBy("anchor_uid").agg(F.collect_list(F.struct("number", "low", "high")).alias("windows"))
    # Both joins merge: written tables are far smaller than their rows, and a side that grows with
    # the input would pass for small and go through the driver.
    asked = anchors.join(windows.hint("merge"), anchors["uid"] == windows["anchor_uid"]).drop("anchor_uid")
    found = search(blocks, asked, root, False, negatives, query_block, held)

    positive = best.select(
        F.col("anchor_uid").alias("of"), F.col("rank").cast("long").alias("nth"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    met = found.join(positive.hint("merge"), (found["anchor_uid"] == positive["of"]) & (found["number"] == positive["nth"]))
    return met.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
