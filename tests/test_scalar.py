"""Column expressions against the hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.config import IGNORE_FLAG, OverrideRule, default_override_rules
from tillcast.functions import scalar as S


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_time_of_day_wraps_and_nulls(spark):
    df = spark.createDataFrame(
        [("10:00:05",), ("25:00:00",), ("-01:00:00",), ("10:00",), ("x",), (None,), ("10:75:00",), ("1:2:3.5",)], "t string"
    )
    assert [r.t for r in S.with_time_of_day(df, "t").collect()] == [
        "10:00:05", "01:00:00", "23:00:00", None, None, None, "11:15:00", "01:02:03.500000",
    ]


def test_parse_date_bad_is_null_under_ansi(spark):
    df = spark.createDataFrame([("2024-02-29",), ("not-a-date",), (None,)], "d string")
    assert col_values(df, S.parse_date("d")) == [dt.date(2024, 2, 29), None, None]


def test_alpha_prefix(spark):
    df = spark.createDataFrame([("SID12",), ("FND",), ("1AB",), ("sid1",), (None,)], "c string")
    assert col_values(df, S.alpha_prefix("c")) == ["SID", "FND", None, None, None]


def test_lookup_exact_and_miss(spark):
    df = spark.createDataFrame([("SID",), ("SI",), ("ZZZ",), (None,)], "p string")
    m = {"SID": "TOPSIDERS", "SIZ": "SIZZLERS"}
    assert col_values(df, S.lookup("p", m)) == ["TOPSIDERS", None, None, None]


def test_overrides_last_rule_wins(spark):
    rules = default_override_rules("BX")
    df = spark.createDataFrame(
        [("BX", 53, "SID12"), ("BX", 42, "CHM1"), ("BX", 54, "CHM1"), ("BY", 53, "SID12"), ("BX", None, "A1")],
        "branch string, dep_code int, incode string",
    )
    out = col_values(df, S.apply_overrides(F.lit("BASE"), rules))
    assert out == ["PASTA DISHES", "BIGGS LOYALTY", "NANAYS FAVORITE", "BASE", "BASE"]


def test_overrides_are_data(spark):
    rules = [OverrideRule("A", branch="B"), OverrideRule("C", incode="X")]
    df = spark.createDataFrame([("B", 1, "X"), ("B", 1, "Y")], "branch string, dep_code int, incode string")
    assert col_values(df, S.apply_overrides(F.lit("Z"), rules)) == ["C", "A"]


def test_flag_precedence(spark):
    df = spark.createDataFrame(
        [("promo", "ignore"), (None, "bulk"), ("promo", "bulk"), (None, None), ("", None)],
        "i string, d string",
    )
    assert col_values(df, S.flag_precedence("i", "d", IGNORE_FLAG)) == [
        "ignore", "bulk", "promo", None, "",
    ]


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("ignore",), ("x",)], "f string")
    kept = df.where(S.not_equal_keep_null("f", "ignore")).collect()
    assert sorted([r.f for r in kept], key=str) == [None, "x"]


@pytest.mark.parametrize(
    "day,expected",
    [("2024-03-31", 30), ("2024-03-15", 16), ("2024-01-31", 29), ("2024-02-28", 1), ("2024-12-31", 31)],
)
def test_horizon(spark, day, expected):
    from tillcast.operators.forecast import horizon_for

    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert col_values(df, S.horizon_days("d")) == [expected]
    assert horizon_for(dt.date.fromisoformat(day)) == expected


def test_iso_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),)], "d date")
    assert col_values(df, S.weekday_monday0("d")) == [0, 6]
    assert col_values(df, S.iso_week("d")) == [1, 52]


def test_hash_split_matches_duckdb(spark):
    import duckdb

    keys = list(range(500))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k for r in df.where(S.hash_fraction_below(["k"], 42, 0.2)).collect()}
    con = duckdb.connect()
    want = {
        r[0]
        for r in con.execute(
            "select k from range(500) t(k) where substr(md5(concat_ws('|', cast(k as varchar), '42')), 1, 8) < '33333333'"
        ).fetchall()
    }
    assert got == want
    assert 60 < len(got) < 140
