"""The end-to-end job writes every stage and its outputs agree with the queries."""

import datetime as dt
import os

from tillcast.config import FIXTURE
from tillcast.operators import forecast
from tillcast.plans import compositions as L
from tillcast.plans import job
from tillcast.plans.registry import q_daily_top_items
from tillcast.sources import files, jdbc
from tillcast.sources.fixtures import retail_inputs
from pyspark.sql import functions as F


def test_job_writes_every_stage(spark, sf_small, tmp_path):
    out = str(tmp_path / "run")
    tables = job.run_pipeline(spark, retail_inputs(spark, sf_small), FIXTURE, out)
    for name in ["transaction_master", "daily", "daily_top_items", "flagged", "capped", "forecasts", "evaluation"]:
        assert os.path.isdir(os.path.join(out, name)), name
    for name in ["daily_top_items", "flagged", "capped", "forecasts"]:
        assert os.path.isdir(os.path.join(out, f"{name}_csv")), name
    assert sorted(tables["daily_top_items"].collect()) == sorted(q_daily_top_items(spark, sf_small).collect())
    fc = tables["forecasts"]
    assert fc.count() == 30 * fc.select("branch", "ite_desc_std").distinct().count()


def test_job_inputs_from_paths_equal_the_query(spark, sf_small, tmp_path):
    inp = retail_inputs(spark, sf_small)
    for name in ("transactions", "products", "departments"):
        files.write_parquet(getattr(inp, name), str(tmp_path / name))
    files.write_csv(inp.item_map, str(tmp_path / "items"))
    files.write_csv(inp.dept_map.withColumn("remarks", F.lit(None).cast("string")), str(tmp_path / "depts"))
    back = job.read_inputs(
        spark, *[str(tmp_path / n) for n in ("transactions", "products", "departments", "items", "depts")]
    )
    got = L.daily_top_items(back, FIXTURE).collect()
    assert sorted(got) == sorted(q_daily_top_items(spark, sf_small).collect())


def test_source_restriction_reaches_the_scan(spark, sf_small, tmp_path):
    tx = retail_inputs(spark, sf_small).transactions
    for name, frame in (("text", tx), ("date", tx.withColumn("date", F.col("date").try_cast("date")))):
        path = str(tmp_path / name)
        files.write_parquet(frame, path)
        kept = jdbc.restrict_source(spark.read.parquet(path), dt.date(1998, 1, 1), ["B1", "B2"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
        assert "date" in pushed.replace("IsNotNull(date)", "") and "In(branch" in pushed
        want = tx.where((F.col("date").try_cast("date") > "1998-01-01") & F.col("branch").isin("B1", "B2"))
        assert kept.count() == want.count()


def test_evaluation_never_fits(spark, sf_small, tmp_path):
    from tillcast.plans.registry import FORECAST

    series = L.forecast_series(retail_inputs(spark, sf_small), FIXTURE, write=True)
    h = forecast.horizon_for(FORECAST.train_end)
    path = str(tmp_path / "fc")
    files.write_parquet(L.forecasts(series, FORECAST, h), path)
    ev = L.evaluation(series, spark.read.parquet(path), FORECAST, h)
    assert "InPandas" not in ev._jdf.queryExecution().executedPlan().toString()


def test_arguments_cover_the_run_parameters():
    a = job.arguments().parse_args(["--out", "x", "--since", "2022-01-01", "--branches", "A,B", "--top-n", "3"])
    assert (a.start_year, a.end_year, a.top_n, a.since) == (2023, 2024, 3, dt.date(2022, 1, 1))


def test_job_reads_the_fact_by_ranges(spark, sf_small, tmp_path):
    inp = retail_inputs(spark, sf_small)
    url = "jdbc:derby:memory:job_ranges;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    queries = []
    for name in ("transactions", "products", "departments"):
        frame = getattr(inp, name)
        # quoted lower-case names in Derby; date, time and type are words of its own
        named = frame.toDF(*[f"c_{c}" for c in frame.columns])
        named.write.format("jdbc").options(url=url, dbtable=name, **driver).mode("overwrite").save()
        queries.append(f"select * from {name}")
    bundle = jdbc.read_queries(spark, url, queries, driver)
    assert bundle["query_0"].rdd.getNumPartitions() == 1
    keys = ", ".join(f'"c_{c}" as {c.upper()}' for c in ("data_id", "branch", "quantity"))
    fact = job.read_inputs(
        spark, f"select {keys} from transactions", *queries[1:], *_maps(inp, tmp_path), jdbc_url=url,
        jdbc_options=driver, partition_columns=["data_id"], num_partitions=6,
    ).transactions
    counts = [r["count"] for r in fact.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) >= 6 and max(counts) <= 2 * sum(counts) / 6
    assert sum(counts) == inp.transactions.count()
    assert fact.agg(F.sum("QUANTITY")).first()[0] == inp.transactions.agg(F.sum("quantity")).first()[0]


def _maps(inp, tmp_path):
    files.write_csv(inp.item_map, str(tmp_path / "i"))
    files.write_csv(inp.dept_map.withColumn("remarks", F.lit(None).cast("string")), str(tmp_path / "d"))
    return str(tmp_path / "i"), str(tmp_path / "d")


def test_csv_facts_keep_declared_types(spark, sf_small, tmp_path):
    """Codes with leading zeros stay text; bad numbers become null; columns bind by name."""
    inp = retail_inputs(spark, sf_small)
    (tmp_path / "tx.csv").write_text(
        "quantity,data_id,branch,pos,transdate,ite_code,dep_code,date,time,type,delivery\n"
        "2.5,1,B1,1,,007,42,2024-01-02,10:00:00,,\nx,2,0012,1,,1e3,y,2024-01-03,25:00:00,D,\n"
    )
    (tmp_path / "p.csv").write_text("data_id,incode,ite_desc,dep_code,unit_prc,branch,pos\n1,007,0815,42,1.5,B1,1\n")
    (tmp_path / "r.csv").write_text("data_id,dept_code,dept_name,branch,pos\n1,42,BEVERAGES,B1,1\n")
    got = job.read_inputs(spark, *[str(tmp_path / n) for n in ("tx.csv", "p.csv", "r.csv")], *_maps(inp, tmp_path))
    rows = got.transactions.orderBy("data_id").select("ite_code", "branch", "quantity", "dep_code").collect()
    assert [tuple(r) for r in rows] == [("007", "B1", 2.5, 42), ("1e3", "0012", None, None)]
    assert got.products.first().incode == "007" and got.products.first().ite_desc == "0815"
    assert L.transaction_master(got, FIXTURE).schema["quantity"].dataType.simpleString() == "double"
