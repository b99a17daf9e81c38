"""Distances between two frames against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import drift

SCHEMA = "dataset string, a double, t string, value string"


def plain(ref, cur, bins=10):
    ref, cur = np.sort(ref), np.sort(cur)
    at = np.unique(np.concatenate([ref, cur]))
    upto = lambda x: np.searchsorted(x, at, side="right") / len(x)
    gaps = np.round(np.abs(upto(ref) - upto(cur)), 12)
    bin_of = lambda x: np.minimum(np.searchsorted(ref, x, side="left") * bins // len(ref), bins - 1)
    psi = 0.0
    for b in set(bin_of(ref)) | set(bin_of(cur)):
        p, q = (max((bin_of(x) == b).mean(), drift.LEAST_SHARE) for x in (ref, cur))
        psi += (q - p) * math.log(q / p)
    return gaps.max(), at[gaps.argmax()], psi


@pytest.mark.parametrize("seed", [1, 2])
def test_distances_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    ref = np.concatenate([rng.normal(size=400), np.full(300, 0.25)])  # a value with many rows
    cur = np.concatenate([rng.normal(0.3, 1.5, size=250), np.full(30, 0.25), [99.0]])
    rows = [("reference", float(v), "x", "") for v in ref] + [("current", float(v), "y" if i % 3 else None, "") for i, v in enumerate(cur)]
    rows += [("current", None, "x", ""), ("current", math.nan, "x", ""), ("other", 1e9, "z", "")]
    got = {r["column"]: r for r in drift.column_drift(spark.createDataFrame(rows, SCHEMA).repartition(5), ["a"], ["t"]).collect()}
    ks, at, psi = plain(ref, cur)
    a = got["a"]
    assert (a.n_reference, a.n_current, a.nulls_reference, a.nulls_current) == (len(ref), len(cur), 0, 2)
    assert a.ks == pytest.approx(ks) and a.ks_at == pytest.approx(at) and a.psi == pytest.approx(psi)
    t, n = got["t"], len(cur) + 2
    none = sum(1 for i in range(len(cur)) if i % 3 == 0)
    shares = {"x": (1.0, 2 / n), "y": (0.0, (len(cur) - none) / n), "None": (0.0, none / n)}
    floor = [(max(p, drift.LEAST_SHARE), max(q, drift.LEAST_SHARE)) for p, q in shares.values()]
    assert t.ks is None and t.nulls_current == none and t.psi == pytest.approx(sum((q - p) * math.log(q / p) for p, q in floor))


def test_same_frame_has_no_drift_and_one_side_has_no_distance(spark):
    rows = [(d, float(i % 7), "k", "") for d in ("reference", "current") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    same = drift.column_drift(df, ["a"], ["t"]).collect()
    assert [(r.ks, r.psi) for r in sorted(same, key=lambda r: r["column"])] == [(0.0, 0.0), (None, 0.0)]
    alone = drift.column_drift(df.where("dataset = 'reference'"), ["a"], ["t"]).collect()
    assert all(r.ks is None and r.psi is None and r.n_current == 0 for r in alone)
    assert drift.column_drift(df.limit(0), ["a"], ["t"]).count() == 0


def test_no_task_sorts_a_whole_column(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "reference").otherwise("current").alias("dataset"), F.col("id").cast("double").alias("a"))
    counted = drift._counted(df, "dataset", "reference", "current", [F.struct(F.lit("a").alias("column"), F.col("a").alias("value"))])
    placed = counted.repartitionByRange(8, "column", "value").groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) >= 6 and max(r["count"] for r in placed) < 20_000 / 3
