"""Last-touch attribution on a stream: orders meet the touches of some time before them.

Two streams are joined by unit and time interval. Watermarks on both sides bound what is kept: a touch until no order
within ``within`` of it can come, an order until its touches are complete. So state costs the rows of that span, not the
history, and an order is emitted once, when its last touch is certain. What comes later than ``lateness`` behind the
newest row is left out by the stream; :func:`attribute_rest` finds these orders among the stored ones and attributes
them as a batch, so the two together hold every order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merclake.streaming.windows import last_touch


def stream_last_touch(
    orders: DataFrame, touches: DataFrame, within: str = "7 days", lateness: str = "10 minutes", unit_col: str = "customer_id",
    order_time: str = "order_timestamp", touch_time: str = "event_timestamp", source: str | Column = "utm_source", id_col: str = "order_id",
) -> DataFrame:
    """Orders with ``attributed_source``: the source of the unit's last touch in the time ``within`` before the order, its
    very time included; NULL without one. Touches of one time count by the larger source. Both frames are streams, and
    the times of the result are timestamps."""
    src = F.col(source) if isinstance(source, str) else source
    span = F.expr(f"INTERVAL {within}")
    left = orders.withColumn(order_time, F.col(order_time).cast("timestamp")).withWatermark(order_time, lateness)
    right = touches.where(src.isNotNull()).select(
        F.col(unit_col).alias("_unit"), F.col(touch_time).cast("timestamp").alias("_touched"), src.cast("string").alias("_source")
    ).withWatermark("_touched", lateness)
    near = (F.col(unit_col) == F.col("_unit")) & (F.col("_touched") <= F.col(order_time)) & (F.col("_touched") >= F.col(order_time) - span)
    joined = left.join(right, near, "leftOuter")
    rest = [c for c in orders.columns if c not in (id_col, order_time)]
    latest = F.max(F.when(F.col("_touched").isNotNull(), F.struct("_touched", "_source")))
    # an order is one group, and closed with its time
    grouped = joined.groupBy(id_col, order_time, *rest).agg(latest.alias("_last"))
    return grouped.select(*orders.columns, F.col("_last._source").alias("attributed_source"))


def bounded_last_touch(
    orders: DataFrame, touches: DataFrame, within: str = "7 days", unit_col: str = "customer_id", order_time: str = "order_timestamp",
    touch_time: str = "event_timestamp", source: str | Column = "utm_source", id_col: str = "order_id",
) -> DataFrame:
    """The same over batch frames; a busy unit is spread over ranges of its rows."""
    src = F.col(source) if isinstance(source, str) else source
    dated = touches.where(src.isNotNull()).withColumn("_source", F.struct(F.col(touch_time).alias("at"), src.cast("string").alias("source")))
    found = last_touch(orders, dated.withColumn("_source", F.to_json("_source")), unit_col, order_time, touch_time, "_source", id_col)
    kind = dict(touches.dtypes)[touch_time]
    seen = F.from_json("attributed_source", f"at {kind}, source string")
    recent = seen["at"] >= F.col(order_time) - F.expr(f"INTERVAL {within}")
    return found.withColumn("attributed_source", F.when(recent, seen["source"]))


def attribute_rest(orders: DataFrame, touches: DataFrame, attributed: DataFrame, id_col: str = "order_id", **options) -> DataFrame:
    """Stored orders that the stream has not emitted, late ones among them, attributed from the stored touches. Write
    them to a table of their own; run again, they are found again until the stream or that table has them."""
    rest = orders.join(attributed.select(id_col), id_col, "left_anti")
    return bounded_last_touch(rest, touches, id_col=id_col, **options)
