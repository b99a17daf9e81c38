"""Shuffled joins give the same rows as broadcast ones."""

import collections

from tillcast.config import FIXTURE
from tillcast.plans import compositions as L
from tillcast.sources import fixtures


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_master_without_broadcast_equals_broadcast(spark, sf_small):
    inp = fixtures.retail_inputs(spark, sf_small)
    a = rows(L.transaction_master(inp, FIXTURE))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        b_df = L.transaction_master(inp, FIXTURE)
        b = rows(b_df)
        plan = b_df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert a == b
