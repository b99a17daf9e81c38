"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage codegen; none needs Python on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import OverrideRule

# Duration text as pandas ``to_timedelta`` reads it: optional sign, optional
# "N days", H:M:S with any number of digits per field, optional fraction.
# Field widths keep the total in nanoseconds inside a signed 64-bit value.
TIME_PATTERN = r"^\s*([-+]?)\s*(\d+\s+days?,?\s+)?(\d{1,6}):(\d{1,7}):(\d{1,9})(?:\.(\d+))?\s*$"
NANOS_PER_DAY = 86_400_000_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """ISO date text -> DATE; anything unparsable -> null (never raises under ANSI)."""
    return _col(c).try_cast("date")


def with_time_of_day(df: DataFrame, src: str, dst: str | None = None) -> DataFrame:
    """Duration text in ``src`` -> the time of day it lands on after midnight.

    ``25:00:00`` wraps to ``01:00:00``, ``-01:00:00`` to ``23:00:00``,
    ``10:75:00`` carries to ``11:15:00``; a fraction is kept as
    ``HH:MM:SS.ffffff`` (nanoseconds, then cut to microseconds, as pandas
    does). Text that is not a duration (``10:00``, ``x``) gives null.
    Whole-day parts do not change the time of day; with a day part the sign
    belongs to the days only (``-1 days 02:00:00`` is 02:00:00), as in pandas.

    Written as stacked projections so each intermediate is computed once per
    row: inside CASE branches Spark does not share common subexpressions,
    and a single nested expression would re-run the parse for every use.
    """
    dst = dst or src
    c = F.col(src)
    tmp = ["__tod_tok", "__tod_neg", "__tod_hms", "__tod_sf", "__tod_us"]
    out = df.withColumns(
        {
            # one regex (the validation); fields are then cut with plain splits
            "__tod_tok": F.when(c.rlike(TIME_PATTERN), F.element_at(F.split(F.trim(c), r"\s+"), -1)),
            "__tod_neg": F.trim(c).startswith("-") & (F.instr(c, "day") == 0),
        }
    )
    out = out.withColumn("__tod_hms", F.split(F.translate("__tod_tok", "+-", ""), ":"))
    out = out.withColumn("__tod_sf", F.split(F.get("__tod_hms", 2), r"\."))
    hms = lambda i: F.get("__tod_hms", i)  # noqa: E731  (get: null past the end, even under ANSI)
    sf = lambda i: F.get("__tod_sf", i)
    whole = hms(0).try_cast("long") * 3600 + hms(1).try_cast("long") * 60 + sf(0).try_cast("long")
    frac = F.coalesce(F.rpad(F.substring(sf(1), 1, 9), 9, "0").try_cast("long"), F.lit(0))
    nanos = whole * 1_000_000_000 + frac
    signed = F.when(F.col("__tod_neg"), -nanos).otherwise(nanos)
    out = out.withColumn("__tod_us", (F.pmod(signed, F.lit(NANOS_PER_DAY)) / 1000).cast("long"))
    us = F.col("__tod_us")
    secs = (us / 1_000_000).cast("long")
    rest = us % 1_000_000
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")  # noqa: E731  (no formatter for each row)
    base = F.concat(two(secs / 3600), F.lit(":"), two((secs % 3600) / 60), F.lit(":"), two(secs % 60))
    text = F.when(rest == 0, base).otherwise(F.concat(base, F.lit("."), F.lpad(rest.cast("string"), 6, "0")))
    return out.withColumn(dst, text).drop(*tmp)


def alpha_prefix(c: str | Column) -> Column:
    """Leading run of upper-case letters; null when there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"^[A-Z]+", 0), F.lit(""))


def lookup(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Exact dictionary lookup as a literal map (no join); a miss gives null."""
    if not mapping:
        return F.lit(None).cast("string")
    kv = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*kv), _col(c))


def apply_overrides(
    base: Column,
    rules: Iterable[OverrideRule],
    branch: str | Column = "branch",
    dep_code: str | Column = "dep_code",
    incode: str | Column = "incode",
) -> Column:
    """Ordered override rules, last match wins, else ``base``.

    Built as one CASE WHEN with the rules in reverse order, so the first
    branch taken is the last rule that matches.
    """
    branch, dep_code, incode = _col(branch), _col(dep_code), _col(incode)
    out = None
    for rule in reversed(list(rules)):
        cond = F.lit(True)
        if rule.branch is not None:
            cond = cond & (branch == F.lit(rule.branch))
        if rule.dep_codes is not None:
            cond = cond & dep_code.isin(list(rule.dep_codes))
        if rule.incode is not None:
            cond = cond & (incode == F.lit(rule.incode))
        out = F.when(cond, F.lit(rule.value)) if out is None else out.when(cond, F.lit(rule.value))
    return base if out is None else out.otherwise(base)


def flag_precedence(item_flag: str | Column, dept_flag: str | Column, ignore: str) -> Column:
    """Item flag, else department flag; a department ``ignore`` always wins."""
    item_flag, dept_flag = _col(item_flag), _col(dept_flag)
    return F.when(dept_flag.eqNullSafe(F.lit(ignore)), F.lit(ignore)).otherwise(
        F.coalesce(item_flag, dept_flag)
    )


def not_equal_keep_null(c: str | Column, value: str) -> Column:
    """``c != value`` that keeps nulls (pandas semantics)."""
    return ~_col(c).eqNullSafe(F.lit(value))


def weekday_monday0(c: str | Column) -> Column:
    """Day of week with Monday = 0 (not ``dayofweek``, which is Sunday = 1)."""
    return F.weekday(_col(c)).cast("int")


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(_col(c)).cast("int")


def horizon_days(train_end: str | Column) -> Column:
    """Days from ``train_end`` to the end of its month, or of the next month
    when ``train_end`` is itself a month end (03-31 -> 30, 03-15 -> 16)."""
    d = _col(train_end)
    return F.datediff(F.last_day(F.date_add(d, 1)), d)


def category_text(c: str | Column) -> Column:
    """Value as text for label encoding; null becomes its own category 'None'."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def hash_fraction_below(keys: list[str | Column], seed: int, fraction: float) -> Column:
    """Deterministic split predicate: first 32 bits of md5(keys|seed) < fraction * 2^32.

    No shuffle, no global ordering, same answer on every retry and in any
    engine with md5 (DuckDB gives the same split).
    """
    threshold = format(int(fraction * 2**32), "08x")
    text = F.concat_ws("|", *[_col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 8) < F.lit(threshold)
