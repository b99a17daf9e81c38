"""Generated inputs checked against pandas, the engine the original pipeline ran on."""

import datetime as dt
import re

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillcast.functions import scalar as S
from tillcast.operators import daily, outliers
from tillcast.operators.forecast import horizon_for

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def pandas_time(text):
    td = pd.to_timedelta(text, errors="coerce")
    return None if pd.isna(td) else str((pd.Timestamp("00:00:00") + td).time())


times = st.one_of(
    st.builds(
        lambda sp, sign, days, h, m, s, frac: f"{sp}{sign}{days}{h}:{m}:{s}{frac}{sp}",
        st.sampled_from(["", " "]),
        st.sampled_from(["", "-"]),
        st.sampled_from(["", "1 days ", "2 day "]),
        st.integers(0, 150).map(str) | st.integers(0, 9).map(lambda v: f"{v:02d}"),
        st.integers(0, 99).map(str) | st.integers(0, 59).map(lambda v: f"{v:02d}"),
        st.integers(0, 99).map(str) | st.integers(0, 59).map(lambda v: f"{v:02d}"),
        st.sampled_from(["", ".5", ".25", ".000001", ".1234567"]),
    ),
    st.sampled_from(["10:00", "x", "", "1:2", "10:00:00:00", "a1:00:00"]),
)


@SETTINGS
@given(st.lists(times, min_size=1, max_size=30))
def test_time_of_day_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r.t for r in S.with_time_of_day(df, "t").collect()]
    assert got == [pandas_time(v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="ABCsid12-_ ", max_size=6), min_size=1, max_size=30))
def test_alpha_prefix_matches_python_re(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(S.alpha_prefix("c")).collect()]
    want = [(m.group() if (m := re.match(r"^[A-Z]+", c)) else None) for c in codes]
    assert got == want


@SETTINGS
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31)))
def test_horizon_matches_pandas_month_end(d):
    ts = pd.Timestamp(d)
    assert horizon_for(d) == ((ts + pd.offsets.MonthEnd(1)) - ts).days


daily_rows = st.lists(
    st.tuples(
        st.sampled_from(["B1", "B2", None]),
        st.sampled_from(["a", "b", "c", "d", None]),
        st.sampled_from([dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2024, 5, 1), None]),
        st.one_of(st.none(), st.integers(-3, 20).map(float)),
    ),
    min_size=1,
    max_size=40,
)
SCHEMA = "branch string, ite_desc_std string, date date, quantity double"


@SETTINGS
@given(daily_rows)
def test_daily_totals_match_pandas_groupby(spark, rows):
    got = {(r.branch, r.ite_desc_std, r.date): r.quantity for r in daily.daily_totals(spark.createDataFrame(rows, SCHEMA)).collect()}
    pdf = pd.DataFrame(rows, columns=["branch", "ite_desc_std", "date", "quantity"])
    want_s = pdf.groupby(["branch", "ite_desc_std", "date"])["quantity"].sum()
    want = {k: float(v) for k, v in want_s.items()}
    assert got == want


@SETTINGS
@given(daily_rows, st.integers(1, 3))
def test_top_n_matches_pandas_sort_head(spark, rows, n):
    pdf = pd.DataFrame(rows, columns=["branch", "ite_desc_std", "date", "quantity"])
    totals = pdf.groupby(["branch", "ite_desc_std"], as_index=False)["quantity"].sum()
    want = (
        totals.sort_values(["branch", "quantity"], ascending=[True, False], kind="stable")
        .groupby("branch").head(n)
    )
    sdf = spark.createDataFrame(
        [(b, i, float(q)) for b, i, q in totals.itertuples(index=False)],
        "branch string, ite_desc_std string, quantity double",
    )
    got = {(r.branch, r.ite_desc_std) for r in daily.top_n_per_group(sdf, n).collect()}
    assert got == set(zip(want["branch"], want["ite_desc_std"]))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 50).map(float)), min_size=1, max_size=25))
def test_iqr_flags_match_pandas_quantile(spark, values):
    rows = [("B", "I", dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    out = outliers.iqr_flags(spark.createDataFrame(rows, SCHEMA)).orderBy("date").collect()
    s = pd.Series(values, dtype="float64")
    q1, q3 = s.quantile([0.25, 0.75])
    iqr = q3 - q1
    want = ((s < q1 - 1.5 * iqr) | (s > q3 + 1.5 * iqr)).tolist()
    assert [r.anomaly for r in out] == want
