"""Stored layouts: bucketed joins without an exchange, months that prune and are replaced alone."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tillcast.config import FIXTURE
from tillcast.operators import daily, joins, layout
from tillcast.plans import job
from tillcast.sources import files
from tillcast.sources.fixtures import retail_inputs

KEYS = ["branch", "code"]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def tables(spark):
    rows = [(i, "B1" if i % 3 else None, None if i % 7 == 0 else f"C{i % 11}") for i in range(400)]
    rows += [(1000 + i, "B9", "HOT") for i in range(600)]  # one key with more than half of the rows
    fact = spark.createDataFrame(rows, "id long, branch string, code string")
    lookup = [("B1", f"C{i}", f"item {i}") for i in range(9)] + [(None, "C1", "no branch"), ("B1", None, "no code"), (None, None, "nothing")]
    lookup += [("B9", "HOT", "hot"), ("B9", "HOT", "hot again"), ("B7", "C1", "unused")]
    return fact, spark.createDataFrame(lookup, "branch string, code string, item string")


def test_no_exchange_on_either_side_and_the_same_rows(spark, no_broadcast):
    fact, lookup = tables(spark)
    laid = layout.lay_out_fact(fact, KEYS, 8)
    joined = layout.join_laid_out(spark, laid, layout.lay_out_lookup(lookup, KEYS, laid))
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = joins.equi_join(fact, lookup, KEYS)
    assert joined.columns == want.columns
    assert sorted(rows, key=str) == sorted(want.collect(), key=str) and len(rows) == 400 + 2 * 600


def test_a_heavy_key_is_dealt_over_several_buckets(spark):
    fact, _ = tables(spark)
    laid = layout.lay_out_fact(fact, KEYS, 8)
    held = spark.table(laid.table)
    per_file = [r["count"] for r in held.groupBy(F.input_file_name()).count().collect()]
    assert laid.heavy.count() <= 8 and max(per_file) < 400
    assert held.where("code = 'HOT'").select(layout.KEY).distinct().count() > 4


def test_month_folders_prune(spark, tmp_path):
    start = dt.date(2022, 11, 20)
    rows = [("B1", "X", start + dt.timedelta(days=i), float(i)) for i in range(500)] + [("B1", "X", None, 1.0)]
    df = spark.createDataFrame(rows, "branch string, ite_desc_std string, date date, quantity double")
    files.write_by_month(df, str(tmp_path / "d"))
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.count() == 501
    year = daily.year_range(back, 2023, 2023)
    plan = year._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "202301" in pruned and "202312" in pruned
    read = {os.path.basename(os.path.dirname(f)) for f in _read_files(year)}
    assert read == {f"month_no={202300 + m}" for m in range(1, 13)} and year.count() == 365
    cut = files.within(back, None, dt.date(2022, 12, 15))
    assert cut.count() == sum(r[2] is not None and r[2] <= dt.date(2022, 12, 15) for r in rows)


def _read_files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def _state(root, month=None):
    found = glob.glob(f"{root}/month_no=*/*.parquet")
    return {f: os.path.getmtime(f) for f in found if month is None or f"month_no={month}" in f}


def test_a_rerun_of_one_month_leaves_the_others_alone(spark, sf_small, tmp_path):
    inp = retail_inputs(spark, sf_small)
    out = str(tmp_path / "run")
    master, day = job.fact_stages(spark, inp, FIXTURE, out)
    want = {r for r in map(tuple, day.collect())}
    before = {n: _state(f"{out}/{n}") for n in ("transaction_master", "daily")}
    plan = job.only_months(inp.transactions, [199803])._jdf.queryExecution().executedPlan().toString()
    assert "1998-03-01" in plan and "1998-04-01" in plan
    _, again = job.fact_stages(spark, inp, FIXTURE, out, months=[199803])
    assert set(map(tuple, again.collect())) == want
    for n, old in before.items():
        new = _state(f"{out}/{n}")
        assert {f for f in old if new.get(f) != old[f]} == set(_only(old, 199803)) and _only(new, 199803)
    # a month whose transactions are gone goes too
    less = job.dataclasses.replace(inp, transactions=inp.transactions.where(~F.col("date").startswith("1998-05")))
    _, rest = job.fact_stages(spark, less, FIXTURE, out, months=[199805])
    assert not _state(f"{out}/daily", 199805) and set(map(tuple, rest.collect())) == {r for r in want if r[-1] != 199805}


def _only(state, month):
    return {f for f in state if f"month_no={month}" in f}
