"""Figures that grow with the new data only: mergeable sketches stored per day, merged over any range.

Distinct counts use HyperLogLog sketches, quantiles KLL sketches. Both merge without loss, so a day is summarised once
and a month, a year or "all but yesterday" is answered from one small row per day. The exact figures remain available
from the rows themselves; the errors stated here are tested.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from merclake.functions.columns import Instant, as_date, exact_sum, from_minor, minor_units, wide_sum, within_days

#: Logarithm of the registers of a distinct sketch. The standard error is 1.04 / sqrt(2**LG_K), 0.8 %; an estimate is
#: within three of them, :data:`DISTINCT_ERROR`, in all but some of a thousand cases.
LG_K = 14
DISTINCT_ERROR = 0.025
#: Size parameter of a quantile sketch. The true rank of an answered quantile is within :data:`RANK_ERROR` of what was
#: asked for, in 99 % of cases, however many rows and merges there were.
KLL_K = 400
RANK_ERROR = 0.01


def daily_customer_sketches(orders: DataFrame) -> DataFrame:
    """One row per ``order_date_key``: orders, revenue in minor units, and a sketch of the customers (binary)."""
    return orders.groupBy(F.col("order_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders"), wide_sum(minor_units("total_amount")).alias("amount"),
        F.hll_sketch_agg("customer_id", LG_K).alias("customers"),
    )


def _key(day: Instant) -> int:
    return int(as_date(day).strftime("%Y%m%d"))


def sales_between(daily: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """Orders, revenue and about how many customers of the days from ``start`` to ``end``, from daily rows."""
    days = daily.where(F.col("date_key").between(_key(start), _key(end)))
    return days.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"), from_minor(F.sum("amount"), 2).alias("revenue"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("customers")), F.lit(0)).alias("customers"),
    )


def exact_sales_between(orders: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """The same from the orders, with the exact number of customers."""
    rows = orders.where(within_days("order_timestamp", start, end))
    return rows.agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("total_amount").alias("revenue"), F.count_distinct("customer_id").alias("customers")
    )


def column_sketches(df: DataFrame, columns: list[str], part: str | Column) -> DataFrame:
    """``part, column, rows, missing, low, high, sketch``: figures of numeric columns per part (a day, a load). All parts
    and columns come from one scan; NaN counts as missing."""
    part = F.col(part) if isinstance(part, str) else part
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("x")) for c in columns])
    long = df.select(part.alias("part"), F.explode(cells).alias("c")).select("part", "c.column", "c.x")
    return long.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("x").isNull()).alias("missing"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.kll_sketch_agg_double("x", F.lit(KLL_K)).alias("sketch"),
    )


def profile_of(sketches: DataFrame, quantiles: list[float]) -> DataFrame:
    """``column, rows, missing, low, high, quantiles`` (an array, NULL for a column without values) over all given parts."""
    merged = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("sketch"),
    )
    asked = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, map(float, quantiles))))
    return merged.withColumn("quantiles", F.when(F.col("missing") < F.col("rows"), asked)).drop("sketch")


def rank_is_close(df: DataFrame, column: str, shares: list[float], values: list[float], error: float = RANK_ERROR) -> DataFrame:
    """One row ``is_close``: whether every value is a quantile of its share, give or take ``error``. A value that
    occurs often has all the ranks from the rows below it to the rows up to it."""
    x = F.nanvl(F.col(column).cast("double"), F.lit(None))
    fits = [
        (F.try_divide(F.count_if(x <= v), F.count(x)) >= share - error) & (F.try_divide(F.count_if(x < v), F.count(x)) <= share + error)
        for share, v in zip(shares, values)
    ]
    return df.agg(reduce(and_, fits).alias("is_close"))
