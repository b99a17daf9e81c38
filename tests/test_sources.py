"""Sources and sinks: CSV mapping files, CSV round trip, JDBC, counts, previews."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.sources import files, jdbc


def test_mapping_csv_keeps_value_space(spark, tmp_path):
    p = tmp_path / "items.csv"
    p.write_text(
        "ite_desc ,ite_desc_std,cat_flag,status,food_type\n"
        '" CHEESY",CHEESY,,active,food\n'
        "GO TAPA\t,GO TAPA,promo,active,\n"
    )
    df = files.read_mapping_csv(spark, str(p), ("ite_desc", "ite_desc_std", "cat_flag", "status", "food_type"))
    assert [r.ite_desc for r in df.collect()] == [" CHEESY", "GO TAPA\t"]
    assert df.where(F.col("cat_flag").isNull()).count() == 1


def test_mapping_csv_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_mapping_csv(spark, str(tmp_path / "nope.csv"), ("a",))


def test_csv_round_trip_with_dates(spark, tmp_path):
    df = spark.createDataFrame(
        [("B", "I", dt.date(2024, 1, 2), 3.0), ("B", "J", dt.date(2024, 1, 3), None)],
        "branch string, ite_desc_std string, date date, quantity double",
    )
    out = str(tmp_path / "daily")
    files.write_csv(df, out)
    back = files.read_csv(spark, out, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    inferred = files.read_csv(spark, out)
    assert inferred.count() == 2


def test_observe_counts_without_extra_pass(spark):
    df, obs = files.counted(spark.range(42), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 42


def test_preview_is_ordered_and_bounded(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    text = files.preview(df, ["k"], 3)
    assert text.splitlines() == ["k", "0", "1", "2"]
    assert "[data: a]" in files.preview_bundle({"a": df})


def test_evaluation_summary(spark):
    ev = spark.createDataFrame([("B2", "X", 1.234, 5.678), ("B1", "Y", 2.0, 10.0)],
                               "branch string, ite_desc_std string, mae double, mape double")
    lines = [r.line for r in files.evaluation_summary(ev).collect()]
    assert lines == ["B1 | Y: MAE=2.00, MAPE=10.00%", "B2 | X: MAE=1.23, MAPE=5.68%"]


def test_jdbc_queries(spark):
    url = "jdbc:derby:memory:tillcast_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(i, "B1" if i % 2 else "B2", f"2024-01-{1 + i % 28:02d}", float(i)) for i in range(100)]
    # upper-case names: Derby folds unquoted identifiers to upper case
    df = spark.createDataFrame(rows, "DATA_ID long, BRANCH string, TDATE string, QUANTITY double")
    df.write.format("jdbc").options(
        url=url, dbtable="RD5000", createTableColumnTypes="BRANCH VARCHAR(8), TDATE VARCHAR(10)", **props
    ).mode("overwrite").save()
    bundle = jdbc.read_queries(spark, url, ["select * from RD5000", "select count(*) as n from RD5000"], props)
    assert list(bundle) == ["query_0", "query_1"]
    assert bundle["query_0"].count() == 100
    src = bundle["query_0"].withColumnRenamed("TDATE", "date").withColumnRenamed("BRANCH", "branch")
    kept = jdbc.restrict_source(src, dt.date(2024, 1, 20), ["B1"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(BRANCH,B1)" in plan  # predicate reaches the database
    assert kept.count() == sum(1 for r in rows if r[1] == "B1" and int(r[2][-2:]) > 20)
    with pytest.raises(Exception):
        jdbc.read_queries(spark, url, ["select * from NO_SUCH_TABLE"], props)


DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def derby_table(spark, name, rows, schema):
    url = f"jdbc:derby:memory:{name};create=true"
    df = spark.createDataFrame(rows, schema)
    df.write.format("jdbc").options(url=url, dbtable=name, **DERBY).mode("overwrite").save()
    return url


def rows_by_partition(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in counts)


def test_ranges_follow_the_counts_of_a_crowded_key(spark):
    # 2,000 keys in 0..1,999, 40 spread up to 4 * 10^12, some null: equal widths would give one range nearly all
    rows = [(i, float(i)) for i in range(2000)] + [(10**11 * (i + 1), -1.0) for i in range(40)] + [(None, 0.5)] * 7
    url = derby_table(spark, "CROWDED", rows, "DATA_ID long, QUANTITY double")
    df = jdbc.read_ranges(spark, url, "select * from CROWDED", ["DATA_ID"], 8, DERBY)
    counts = rows_by_partition(df)
    assert sum(counts) == len(rows) and sorted(map(tuple, df.collect()), key=str) == sorted(rows, key=str)
    assert max(counts) <= 2 * len(rows) / 8 and len(counts) <= 2 * 8 + 1
    nulls = df.where(F.col("DATA_ID").isNull()).select(F.spark_partition_id()).distinct().collect()
    held = df.withColumn("p", F.spark_partition_id()).where(F.col("p") == nulls[0][0]).count()
    assert len(nulls) == 1 and held == 7


def test_a_heavy_key_is_dealt_out_by_the_next_column(spark):
    rows = [(1 if i % 3 else i, i) for i in range(900)] + [(None, i) for i in range(600)] + [(1, None)] * 3
    url = derby_table(spark, "HEAVY", rows, "DEP_CODE long, DATA_ID long")
    alone = jdbc.read_ranges(spark, url, "select * from HEAVY", ["DEP_CODE"], 10, DERBY)
    assert max(rows_by_partition(alone)) >= 600  # one key, one range
    df = jdbc.read_ranges(spark, url, "select * from HEAVY", ["DEP_CODE", "DATA_ID"], 10, DERBY)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(rows, key=str)
    assert max(rows_by_partition(df)) <= 2 * len(rows) / 10


def test_range_predicates_hold_every_row_once(spark):
    """Also rows written after the counting: beyond the ends, between ranges, beside a heavy key."""
    rng = __import__("random").Random(3)
    for case in range(6):
        keys = [rng.choice([None, 5, 5, 5, 6, rng.randrange(-50, 50), rng.randrange(10**6)]) for _ in range(rng.randrange(0, 200))]
        spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, d long").createOrReplaceTempView("counted")
        run = lambda sql: [tuple(r) for r in spark.sql(sql).collect()]
        predicates = jdbc.range_predicates(run, "select * from counted", ["k", "d"][: 1 + case % 2], 5)
        later = [*keys, None, -(10**9), 10**9, 4, 5, 6, 7, 0, 999_999]
        spark.createDataFrame([(k, i) for i, k in enumerate(later)], "k long, d long").createOrReplaceTempView("written")
        hits = " + ".join(f"coalesce(cast({p} as int), 0)" for p in map("({})".format, predicates))
        assert {r[0] for r in run(f"select {hits} from written")} == {1}


def test_ranges_need_a_plain_whole_number_column(spark):
    url = derby_table(spark, "PLAIN", [(1, "x", 2.5)], "DATA_ID long, NAME string, QUANTITY double")
    for column in ("QUANTITY", "NAME", "MISSING"):
        with pytest.raises(ValueError):
            jdbc.read_ranges(spark, url, "select DATA_ID, QUANTITY from PLAIN", [column], 2, DERBY)
    with pytest.raises(ValueError):
        jdbc.range_predicates(lambda sql: [], "select 1", ["a; drop table b"], 2)


def test_empty_table_reads_as_empty(spark):
    url = derby_table(spark, "NONE_YET", [], "DATA_ID long, QUANTITY double")
    assert jdbc.read_ranges(spark, url, "select * from NONE_YET", ["DATA_ID"], 4, DERBY).count() == 0
