"""The whole pipeline as one job: L1 -> L2 -> L3 -> L4, outputs written.

Plain function composition in place of an orchestrator. Every stage is
handed to the next as a written table (Parquet under ``out_dir``), so a
failed stage can be rerun from the previous output and the lineage of each
stage starts at files. CSV copies are written where the original pipeline
wrote CSV (daily top items, flagged, capped, forecasts).

Inputs are database queries, or Parquet / CSV paths, and the two mapping CSVs:

    python -m tillcast.plans.job --out /shared/run1 \\
        --jdbc-url jdbc:... --jdbc-option user=... --jdbc-option password=... \\
        --transactions 'select * from rd5000' --products 'select * from rd5500' \\
        --departments 'select * from rd1800' \\
        --item-map items.csv --dept-map departments.csv --since 2022-01-01 --branches A,B

or the driver's test tables: ``--sf-dir /root/testdata/sf0.01``.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import logging
from collections.abc import Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.config import FIXTURE, ForecastConfig, RunParams
from tillcast.operators import daily, forecast, outliers
from tillcast.plans import compositions as L
from tillcast.sources import files, jdbc, schemas
from tillcast.sources.fixtures import RetailInputs, retail_inputs

log = logging.getLogger(__name__)


def _stage(
    spark: SparkSession, df: DataFrame, out_dir: str, name: str, csv: bool = False, by_month: bool = False, months: Sequence[int] | None = None
) -> DataFrame:
    """Write a stage, counting its rows on the way (S7), and read it back."""
    path = f"{out_dir.rstrip('/')}/{name}"
    watched, seen = files.counted(df, name)
    if by_month:
        files.write_by_month(watched, path, months=months)
    else:
        files.write_parquet(watched, path)
    log.info("%s: %d rows -> %s", name, _seen(seen), path)
    back = spark.read.parquet(path)
    if csv:
        files.write_csv(back, f"{path}_csv")
    return back


def _seen(observed) -> int:
    try:
        return observed.get["rows"]
    except Py4JJavaError:  # Spark drops the count of a plan that it finds to be empty
        return 0


def only_months(tx: DataFrame, months: Sequence[int], date_col: str = "date") -> DataFrame:
    """Transactions of some months (202403, ...), by ranges of the raw date that reach the source.
    ISO text sorts like its dates."""
    typed = dict(tx.dtypes)[date_col] == "date"
    value = F.lit if typed else (lambda day: F.lit(day.isoformat()))
    ranges = []
    for m in months:
        first = dt.date(m // 100, m % 100, 1)
        after = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
        ranges.append((F.col(date_col) >= value(first)) & (F.col(date_col) < value(after)))
    return tx.where(reduce(or_, ranges))


def fact_stages(
    spark: SparkSession, inp: RetailInputs, p: RunParams, out_dir: str, months: Sequence[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The transaction master and the daily totals, stored by month. With ``months`` these alone
    are computed, from these months' transactions, and replaced; all months are returned."""
    if months:
        inp = dataclasses.replace(inp, transactions=only_months(inp.transactions, months))
    written = _stage(spark, L.transaction_master(inp, p), out_dir, "transaction_master", by_month=True, months=months)
    fresh = written.where(F.col(files.MONTH).isin(list(months))) if months else written
    totals = daily.daily_totals(fresh.drop(files.MONTH))
    return written, _stage(spark, totals, out_dir, "daily", by_month=True, months=months)


def run_pipeline(
    spark: SparkSession,
    inp: RetailInputs,
    p: RunParams,
    out_dir: str,
    forecast_years: bool = False,
    months: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    """Run and write every stage; returns the written tables, re-read. With ``months`` only
    these are recomputed from the transactions; what follows reads all months' totals."""
    master, day = fact_stages(spark, inp, p, out_dir, months)
    chosen = daily.daily_top_items(day, p.start_year, p.end_year, p.top_n).drop(files.MONTH)
    top = _stage(spark, chosen, out_dir, "daily_top_items", csv=True)
    flagged = _stage(
        spark,
        outliers.cap_outliers(top, k=p.iqr_k, start_year=p.start_year, end_year=p.end_year),
        out_dir,
        "flagged",
        csv=True,
    )
    capped = _stage(
        spark, flagged.select("branch", "ite_desc_std", "date", "quantity_cap"), out_dir, "capped", csv=True
    )
    # the forecaster needs history up to train_end; with the year range alone
    # it may have none, so it can use the capped series of all years
    series = capped
    if not forecast_years:
        series = _stage(
            spark,
            outliers.cap_outliers(top, k=p.iqr_k).select("branch", "ite_desc_std", "date", "quantity_cap"),
            out_dir,
            "series",
        )
    cfg = ForecastConfig(order=p.arima_order, train_end=p.train_end)
    h = forecast.horizon_for(cfg.train_end)
    forecasts = _stage(spark, L.forecasts(series, cfg, h), out_dir, "forecasts", csv=True)
    evaluation = _stage(spark, L.evaluation(series, forecasts, cfg, h), out_dir, "evaluation")
    if log.isEnabledFor(logging.INFO):  # S8: the last stage has one row a series
        log.info("[data: evaluation]\n%s", files.preview(evaluation, evaluation.columns[:2], 5))
    return {
        "transaction_master": master,
        "daily": day,
        "daily_top_items": top,
        "flagged": flagged,
        "capped": capped,
        "forecasts": forecasts,
        "evaluation": evaluation,
    }


def read_inputs(
    spark: SparkSession,
    transactions: str,
    products: str,
    departments: str,
    item_map: str,
    dept_map: str,
    since: dt.date | None = None,
    branches: list[str] | None = None,
    jdbc_url: str | None = None,
    jdbc_options: dict[str, str] | None = None,
    partition_columns: Sequence[str] = (),
    num_partitions: int = 32,
) -> RetailInputs:
    """The five inputs, the transactions restricted at their source.

    With ``jdbc_url`` the first three are queries, else paths of Parquet
    folders or CSV files (columns typed as declared in ``schemas``). With
    ``partition_columns`` the transactions come through ``num_partitions``
    connections (``jdbc.read_ranges``), else through one. Credentials come
    from the caller's options.
    """
    if jdbc_url and partition_columns:
        fact = jdbc.read_ranges(spark, jdbc_url, transactions, partition_columns, num_partitions, jdbc_options)
        tables = [fact, *jdbc.read_queries(spark, jdbc_url, [products, departments], jdbc_options).values()]
    elif jdbc_url:
        tables = list(jdbc.read_queries(spark, jdbc_url, [transactions, products, departments], jdbc_options).values())
    else:
        declared = (schemas.TRANSACTIONS, schemas.PRODUCTS, schemas.DEPARTMENTS)
        tables = [_read_path(spark, p, s) for p, s in zip((transactions, products, departments), declared)]
    if since is not None or branches:
        tables[0] = jdbc.restrict_source(tables[0], since, branches)
    maps = files.read_mappings(spark, dept_map, item_map)
    return RetailInputs(*tables, maps["item"], maps["department"])


def _read_path(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet as it is; CSV in one pass with declared types, so that a code such as 007 stays text."""
    return files.read_csv(spark, path, schema) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)


def arguments() -> argparse.ArgumentParser:
    d = RunParams()
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--out", required=True, help="output folder (shared file system on a cluster)")
    ap.add_argument("--sf-dir", help="folder with the driver's Parquet tables, in place of the inputs below")
    for name in ("transactions", "products", "departments"):
        ap.add_argument(f"--{name}", help="Parquet folder or CSV path; with --jdbc-url a query")
    ap.add_argument("--item-map", help="item mapping CSV")
    ap.add_argument("--dept-map", help="department mapping CSV")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    ap.add_argument("--partition-columns", help="read the transactions in parallel by ranges of this whole-number "
                    "column; more columns, comma-separated, deal out keys that repeat often")
    ap.add_argument("--num-partitions", type=int, default=32, help="connections for --partition-columns")
    ap.add_argument("--since", type=dt.date.fromisoformat, help="only transactions after this date")
    ap.add_argument("--branches", help="only these branches, comma-separated")
    ap.add_argument("--override-branch", help="branch of the department overrides")
    ap.add_argument("--start-year", type=int, default=d.start_year)
    ap.add_argument("--end-year", type=int, default=d.end_year)
    ap.add_argument("--top-n", type=int, default=d.top_n)
    ap.add_argument("--iqr-k", type=float, default=d.iqr_k)
    ap.add_argument("--order", default=",".join(map(str, d.arima_order)), help="ARIMA p,d,q")
    ap.add_argument("--train-end", type=dt.date.fromisoformat, default=d.train_end)
    ap.add_argument("--forecast-years", action="store_true", help="forecast from the year range alone")
    ap.add_argument("--months", help="recompute only these months of the master and the totals: 202403,202404")
    ap.add_argument("--master", default=None, help="only for local runs")
    return ap


def main(argv: list[str] | None = None) -> None:
    from tillcast.config import default_override_rules
    from tillcast.session import drop_materialized, get_session

    ap = arguments()
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    p = RunParams(
        start_year=args.start_year,
        end_year=args.end_year,
        top_n=args.top_n,
        iqr_k=args.iqr_k,
        arima_order=tuple(int(x) for x in args.order.split(",")),
        train_end=args.train_end,
    )
    if args.override_branch:
        p = dataclasses.replace(p, override_rules=tuple(default_override_rules(args.override_branch)))
    needed = ("transactions", "products", "departments", "item_map", "dept_map")
    if not args.sf_dir and not all(getattr(args, n) for n in needed):
        ap.error("give --sf-dir, or all of " + ", ".join("--" + n.replace("_", "-") for n in needed))
    spark = get_session(args.master)
    if args.sf_dir:
        inp = retail_inputs(spark, args.sf_dir)
        if not args.override_branch:
            p = dataclasses.replace(p, override_rules=FIXTURE.override_rules)
    else:
        inp = read_inputs(
            spark,
            *[getattr(args, n) for n in needed],
            since=args.since,
            branches=args.branches.split(",") if args.branches else None,
            jdbc_url=args.jdbc_url,
            jdbc_options=dict(x.split("=", 1) for x in args.jdbc_option),
            partition_columns=args.partition_columns.split(",") if args.partition_columns else (),
            num_partitions=args.num_partitions,
        )
    months = [int(m) for m in args.months.split(",")] if args.months else None
    out = run_pipeline(spark, inp, p, args.out, args.forecast_years, months)
    print("Evaluation Summary (MAE, MAPE%):")
    for row in files.evaluation_summary(out["evaluation"]).collect():  # one line a series
        print(row.line)
    drop_materialized(spark)  # outputs live in --out; intermediates are no longer read


if __name__ == "__main__":
    main()
