"""Column helpers. All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

Instant = str | date | datetime


def moment(value: Instant) -> Column:
    """Literal TIMESTAMP_NTZ; a date means its midnight."""
    if isinstance(value, datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def as_date(value: Instant) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value[:10])


def within_days(col: str | Column, start: Instant | None, end: Instant | None) -> Column:
    """``start`` and ``end`` are whole days, both inclusive; a bound of None is open.

    The bounds are literals on the bare column, so they reach the Parquet scan.
    """
    c = F.col(col) if isinstance(col, str) else col
    tests = []
    if start is not None:
        tests.append(c >= moment(as_date(start)))
    if end is not None:
        tests.append(c < moment(as_date(end) + timedelta(days=1)))
    return all_of(tests)


def all_of(tests: list[Column]) -> Column:
    return reduce(and_, tests) if tests else F.lit(True)


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days (a duration, not the number of midnights passed)."""
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def date_key(col: str | Column) -> Column:
    """YYYYMMDD as INT, from calendar fields (cheaper than formatting a string)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")


def hour_bucket(col: str | Column) -> Column:
    """Hours since 1970 as BIGINT; non-decreasing in the timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_date(F.to_date(c)).cast("bigint") * 24 + F.hour(c)


def day_bucket(col: str | Column) -> Column:
    """Days since 1970 as BIGINT; non-decreasing in the timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_date(F.to_date(c)).cast("bigint")


def minor_units(col: str | Column, scale: int = 2) -> Column:
    """An amount held at ``scale`` decimals as BIGINT minor units."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * F.lit(float(10**scale))).cast("bigint")


def wide_sum(minor: Column) -> Column:
    """Exact DECIMAL(38,0) sum of BIGINT values that may exceed BIGINT.

    High and low bits are summed apart as BIGINT, which stays on the codegen path and holds
    for 8 * 10^12 rows of any amounts; a DECIMAL buffer per row would be several times slower."""
    high = F.sum(F.shiftright(minor, 20)).cast("decimal(20,0)")
    low = F.sum(minor.bitwiseAND(F.lit(1048575).cast("bigint"))).cast("decimal(20,0)")
    return (high * F.lit(1048576).cast("decimal(7,0)") + low).cast("decimal(38,0)")


def from_minor(total: Column, scale: int) -> Column:
    return total.cast("double") / F.lit(float(10**scale))


def exact_sum(col: str | Column, scale: int = 2) -> Column:
    """Sum of amounts held at ``scale`` decimals, added up as whole minor units: exact, and
    independent of the order in which partial sums meet, so that a retried or re-partitioned
    job gives the same bits."""
    return from_minor(wide_sum(minor_units(col, scale)), scale)


def exact_mean(col: str | Column, scale: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(exact_sum(c, scale), F.count(c))


def nan_to_null(col: str | Column) -> Column:
    """Spark orders NaN above every number; checks here treat it as missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def title_case(col: str | Column) -> Column:
    """Upper-case the first letter after any non-alphanumeric (``O'Brien Mary-Jane``)."""
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 2147483647)))), ""
    )


def cohort_label(col: str | Column, granularity: str) -> Column:
    """``week`` counts Mondays from the first Monday of the year (days before it are week 00)."""
    c = F.col(col) if isinstance(col, str) else col
    if granularity == "month":
        return F.date_format(c, "yyyy-MM")
    if granularity == "quarter":
        return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))
    if granularity == "week":
        week = F.floor((F.dayofyear(c) - 1 + 7 - F.weekday(c)) / 7).cast("string")
        return F.concat(F.year(c).cast("string"), F.lit("-W"), F.lpad(week, 2, "0"))
    raise ValueError(f"unknown cohort granularity: {granularity}")


def present(df: DataFrame, columns: list[str] | tuple[str, ...]) -> list[str]:
    """The given columns that the frame has, in the given order."""
    return [c for c in columns if c in df.columns]


def require(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
