"""Slow drift of metrics, and how metrics move together.

A cumulative sum chart adds up how far a metric has been above its target by more than a slack, and starts again from
zero whenever it would fall below. That restart looks sequential, but the sum equals the running total minus its running
minimum, and both combine over blocks: a block gives its total and its least running total, one row each, and the
chart is drawn inside the blocks side by side. Steps are whole numbers (``scale`` decimals), so the result does not
depend on how the series is cut.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merclake.functions.columns import nan_to_null
from merclake.functions.sequence import beside, ranged


def _chart(rows: DataFrame, step: Column, name: str) -> DataFrame:
    """Add ``name``: the running total of the steps minus the least running total so far, or minus zero."""
    part = ["metric_name", "_range"]
    inside = W.partitionBy(*part).orderBy("idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("_run", F.sum(step).over(inside))
    placed = placed.withColumn("_low", F.min("_run").over(inside))
    blocks = W.partitionBy("metric_name").orderBy("_range")
    before = blocks.rowsBetween(W.unboundedPreceding, -1)
    summary = (
        placed.groupBy(*part).agg(F.sum(step).alias("_total"), F.min("_run").alias("_least"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .withColumn("_floor", F.least(F.lit(0), F.coalesce(F.min(F.col("_start") + F.col("_least")).over(before), F.lit(0))))
        .select(*part, "_start", "_floor")
    )
    out = beside(placed, summary, part)
    low = F.least(F.col("_floor"), F.col("_start") + F.col("_low"))
    return out.withColumn(name, F.col("_start") + F.col("_run") - low).drop("_run", "_low", "_start", "_floor")


def cusum(series: DataFrame, limits: DataFrame, threshold: float = 5.0, slack: float = 0.5, scale: int = 4) -> DataFrame:
    """``metric_name, idx, value, above, below, drift``: the sums upwards and downwards after every value, and ``up``,
    ``down`` or NULL where one is over the threshold. ``limits`` has ``metric_name, target, unit``: the value to hold
    and what slack and threshold are counted in, the usual deviation. A missing value adds nothing."""
    known = series.withColumn("value", nan_to_null("value")).join(limits, "metric_name")
    rows = ranged(known, ["metric_name", "idx"])
    whole = F.lit(float(10**scale))
    off = F.try_divide(F.col("value") - F.col("target"), F.col("unit"))
    up = F.coalesce(F.rint((off - slack) * whole).cast("bigint"), F.lit(0))
    down = F.coalesce(F.rint((-off - slack) * whole).cast("bigint"), F.lit(0))
    charted = _chart(_chart(rows, up, "_up"), down, "_down")
    above, below = F.col("_up") / whole, F.col("_down") / whole
    drift = F.when((above > threshold) & (above >= below), "up").when(below > threshold, "down")
    return charted.select("metric_name", "idx", "value", above.alias("above"), below.alias("below"), drift.alias("drift"))


def drift_periods(charted: DataFrame) -> DataFrame:
    """``metric_name, drift, first_idx, last_idx, points``: how long each metric was off, upwards and downwards."""
    return charted.where(F.col("drift").isNotNull()).groupBy("metric_name", "drift").agg(
        F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("points")
    )


def correlations(df: DataFrame, metrics: list[str]) -> DataFrame:
    """``metric_a, metric_b, points, correlation`` of every pair of the given columns, over the rows where both have a
    value: one aggregation for all pairs. NULL where a column does not vary."""
    pairs = list(combinations(metrics, 2))
    value = {m: nan_to_null(F.col(m).cast("double")) for m in metrics}
    both = {p: value[p[0]].isNotNull() & value[p[1]].isNotNull() for p in pairs}
    held = lambda p, m: F.when(both[p], value[m])
    spread = lambda p: F.stddev_pop(held(p, p[0])) * F.stddev_pop(held(p, p[1]))
    sums = df.agg(
        *[F.count_if(both[p]).alias(f"n{i}") for i, p in enumerate(pairs)],
        *[F.try_divide(F.covar_pop(held(p, p[0]), held(p, p[1])), spread(p)).alias(f"c{i}") for i, p in enumerate(pairs)],
    )
    rows = F.array(*[
        F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"n{i}").alias("points"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ])
    return sums.select(F.explode(rows).alias("r")).select("r.*")
