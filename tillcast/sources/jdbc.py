"""Database reads through Spark's JDBC source."""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Rows per round trip; the JDBC default of some drivers (10 or 0 = all) is
# either slow or loads everything into one executor's memory.
DEFAULT_FETCHSIZE = "10000"


def read_queries(
    spark: SparkSession,
    url: str,
    queries: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """``{"query_0": df, ...}`` in list order, one JDBC read per query.

    Reads are lazy; the schema of each query is resolved here, so a bad
    query fails now (logged, then re-raised). Connection settings such as
    ``user``, ``password`` and ``driver`` go in ``properties`` and never in
    code or committed config.
    """
    out: dict[str, DataFrame] = {}
    for i, q in enumerate(queries):
        try:
            out[f"query_{i}"] = _reader(spark, url, properties).option("query", q).load()
        except Exception:
            log.exception("query_%d failed", i)
            raise
    return out


@dataclass(frozen=True)
class KeyRange:
    """Rows whose key lies in ``[low, high]`` (both ends included), at the time of counting."""

    low: int
    high: int
    rows: int


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None):
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", DEFAULT_FETCHSIZE)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader


def _checked_column(column: str) -> str:
    """Column names become part of SQL text, so only plain identifiers pass."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", column):
        raise ValueError(f"not a plain column name: {column!r}")
    return column


def count_buckets(
    run: Callable[[str], list], query: str, column: str, pieces: Sequence[tuple[int, int]], where: str = ""
) -> list[KeyRange]:
    """Rows of ``query`` in each of the key intervals ``pieces``, counted at the source.

    One statement: each row is given the number of its interval by a CASE and
    the source groups by it, so a scan sends one row an interval. ``run`` sends a
    statement and returns its rows. CASE, comparisons and GROUP BY of a
    subquery are understood by every database; there is no rounding.
    """
    low, high = pieces[0][0], pieces[-1][1]
    cases = " ".join(f"when {column} <= {upper} then {n}" for n, (_, upper) in enumerate(pieces[:-1]))
    number = f"case {cases} else {len(pieces) - 1} end" if cases else "0"
    inside = f"{column} >= {low} and {column} <= {high}" + (f" and {where}" if where else "")
    counted = run(
        f"select bucket, count(*) as n_rows from (select {number} as bucket from ({query}) q where {inside}) b group by bucket"
    )
    rows = {int(r[0]): int(r[1]) for r in counted}
    return [KeyRange(lo, hi, rows.get(n, 0)) for n, (lo, hi) in enumerate(pieces)]


def cut_evenly(low: int, high: int, pieces: int) -> list[tuple[int, int]]:
    """Whole-number intervals of equal width that cover ``[low, high]``."""
    width = -(-(high - low + 1) // pieces)
    return [(at, min(at + width - 1, high)) for at in range(low, high + 1, width)]


def plan_ranges(
    run: Callable[[str], list], query: str, column: str, num_partitions: int, where: str = "", buckets: int = 64
) -> tuple[list[KeyRange], int, list[KeyRange]]:
    """Ranges of a whole-number key with about equal numbers of rows, from counts at the source.

    The interval between the smallest and the largest key is cut into
    ``buckets`` and counted; every bucket that holds more than a quarter of a
    range's share is cut and counted again, down to single keys, so a key
    crowded into one corner costs a few more statements and not a long range.
    Neighbouring buckets are then joined up to the share. Returns the ranges,
    the number of null keys, and those single keys that alone exceed the share.
    """
    found = run(
        f"select min({column}) as lo, max({column}) as hi, count({column}) as n_keys, count(*) as n_rows from ({query}) q"
        + (f" where {where}" if where else "")
    )[0]
    if found[0] is None:
        return [], int(found[3]), []
    low, high, rows, nulls = int(found[0]), int(found[1]), int(found[2]), int(found[3]) - int(found[2])
    share = max(1, -(-rows // num_partitions))
    settled: list[KeyRange] = []
    open_ranges = [KeyRange(low, high, rows)]
    while open_ranges:
        counted: list[KeyRange] = []
        for r in open_ranges:
            counted += count_buckets(run, query, column, cut_evenly(r.low, r.high, buckets), where)
        open_ranges = [r for r in counted if r.rows * 4 > share and r.high > r.low]
        settled += [r for r in counted if r not in open_ranges]
    joined: list[KeyRange] = []
    for r in sorted(settled, key=lambda r: r.low):
        if joined and joined[-1].rows + r.rows <= share:
            joined[-1] = KeyRange(joined[-1].low, r.high, joined[-1].rows + r.rows)
        else:
            joined.append(r)
    return joined, nulls, [r for r in joined if r.low == r.high and r.rows > share]


def range_predicates(
    run: Callable[[str], list], query: str, columns: Sequence[str], num_partitions: int, where: str = ""
) -> list[str]:
    """Predicates that deal the rows of ``query`` out by ranges of ``columns[0]``.

    Together they hold every row once, whatever is written between counting
    and reading: the outer ranges are open and null keys have a predicate of
    their own. A single key heavier than a range's share is dealt out by the
    next column in the same way.
    """
    column = _checked_column(columns[0])
    ranges, nulls, heavy = plan_ranges(run, query, column, num_partitions, where)
    total = nulls + sum(r.rows for r in ranges)
    parts = lambda rows: max(2, -(-rows * num_partitions // max(1, total)))
    out: list[str] = []
    for n, r in enumerate(ranges):
        ends = [f"{column} >= {r.low}"] if n else []
        ends += [f"{column} < {later.low}" for later in ranges[n + 1 : n + 2]]
        if r in heavy and len(columns) > 1:
            one = f"{column} = {r.low}"
            inner = range_predicates(run, query, columns[1:], parts(r.rows), f"{one} and {where}" if where else one)
            out += [f"{one} and ({p})" for p in inner]
            # what may be written beyond the outer ends meanwhile
            out += [] if n else [f"{column} < {r.low}"]
            out += [] if n + 1 < len(ranges) else [f"{column} > {r.low}"]
        else:
            out.append(" and ".join(ends) or f"{column} is not null")
    if nulls and len(columns) > 1:
        none = f"{column} is null"
        inner = range_predicates(run, query, columns[1:], parts(nulls), f"{none} and {where}" if where else none)
        return out + [f"{none} and ({p})" for p in inner]
    return [*out, f"{column} is null"]


def read_ranges(
    spark: SparkSession,
    url: str,
    query: str,
    columns: Sequence[str],
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """S1 for the big table: one read a range of a whole-number key, in parallel.

    Equal widths between the smallest and the largest key leave nearly all
    rows to one connection when the keys are crowded; here the source counts
    the rows of each bucket of keys and the ranges follow the counts
    (``plan_ranges``). ``columns`` names the key and, for keys that repeat, the
    columns that deal out its heavy values.
    """
    run = lambda sql: _reader(spark, url, properties).option("query", sql).load().collect()
    schema = _reader(spark, url, properties).option("query", query).load().schema
    for c in columns:
        kind = next((f.dataType for f in schema.fields if f.name.lower() == c.lower()), None)
        whole = isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0
        if not whole:
            raise ValueError(f"{c} must be a whole-number column of the query, found {kind}")
    predicates = range_predicates(run, query, columns, num_partitions)
    log.info("reading by %d ranges of %s", len(predicates), ", ".join(columns))
    props = {"fetchsize": DEFAULT_FETCHSIZE, **(properties or {})}
    return spark.read.jdbc(url, f"({query}) q", predicates=predicates, properties=props)


def restrict_source(
    df: DataFrame, since: dt.date | None, branches: Sequence[str] | None, date_col: str = "date"
) -> DataFrame:
    """``date > since`` (strict) and ``branch IN (...)``.

    Both predicates reach the JDBC / Parquet source. A date column is compared
    as it is. ISO text sorts like its dates, so text is first compared as text
    (``>=``, pushed down), and then what comes through as a date, which drops
    text that is no date. Either restriction may be left out (None).
    """
    d = F.col(date_col)
    kept = df.where(F.col("branch").isin(list(branches))) if branches else df
    if since is None:
        return kept
    if dict(df.dtypes)[date_col] == "date":
        return kept.where(d > F.lit(since))
    return kept.where((d >= F.lit(since.isoformat())) & (d.try_cast("date") > F.lit(since)))
