"""Aggregate tables of the warehouse: daily sales, product performance, stock, campaigns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from merclake.functions.columns import (
    Instant, as_date, date_key, exact_sum, from_minor, minor_units, moment, wide_sum, within_days,
)


def _per_day_and_customer(orders: DataFrame, full: bool) -> DataFrame:
    """Sums per day and customer. Days follow from it without a distinct count, and it is the
    one shuffle of orders that the daily measures and the first days share."""
    more = [
        F.sum(minor_units("discount_amount", 4)).alias("discount"), F.sum(minor_units("shipping_amount")).alias("shipping"),
        F.count("item_count").alias("with_items"),
    ]
    return orders.groupBy(F.col("order_date_key").alias("date_key"), "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(minor_units("total_amount")).alias("amount"),
        F.count("total_amount").alias("with_amount"), F.sum("item_count").alias("items"), *(more if full else []),
    )


def _daily(per_customer: DataFrame, full: bool) -> DataFrame:
    revenue = from_minor(wide_sum(F.col("amount")), 2)
    more = [
        from_minor(wide_sum(F.col("discount")), 4).alias("total_discount"),
        from_minor(wide_sum(F.col("shipping")), 2).alias("total_shipping"),
        F.try_divide(F.sum("items"), F.sum("with_items")).alias("avg_items_per_order"),
    ]
    return per_customer.groupBy("date_key").agg(
        F.sum("orders").alias("total_orders"),
        revenue.alias("total_revenue"),
        F.sum("items").alias("total_items_sold"),
        F.try_divide(revenue, F.sum("with_amount")).alias("avg_order_value"),
        F.count("customer_id").alias("unique_customers"),
        *(more if full else []),
    )


def daily_sales(orders: DataFrame, day_key: int | None = None) -> DataFrame:
    """One row per ``order_date_key`` (or the given one): orders, revenue, items, mean order
    value and customers. A batch computes all days at once. One day is also asked for as a range of the bare
    ``order_timestamp``, which reaches the scan and spares the history."""
    scope = orders if day_key is None else orders.where(F.col("order_date_key") == day_key)
    if day_key is not None and dict(orders.dtypes).get("order_timestamp") in ("timestamp", "timestamp_ntz"):
        day = date(day_key // 10000, day_key // 100 % 100, day_key % 100)
        scope = scope.where(within_days("order_timestamp", day, day))
    return _daily(_per_day_and_customer(scope, False), False)


def daily_sales_full(orders: DataFrame, page_views: DataFrame) -> DataFrame:
    """All measures of the daily table. A customer is new on the day of the first order;
    ``conversion_rate`` is orders per session. Days with orders or page views appear."""
    per_customer = _per_day_and_customer(orders, True)
    first_days = per_customer.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("date_key").alias("date_key")
    )
    new = first_days.groupBy("date_key").agg(F.count(F.lit(1)).alias("new_customers"))
    views = page_views.groupBy("date_key").agg(
        F.count_distinct("session_id").alias("total_sessions"), F.count(F.lit(1)).alias("total_page_views")
    )
    out = _daily(per_customer, True).join(new, "date_key", "left").join(views, "date_key", "full_outer")
    zero = ["total_orders", "total_items_sold", "unique_customers", "new_customers", "total_sessions", "total_page_views"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})
    money = ["total_revenue", "total_discount", "total_shipping", "avg_order_value", "avg_items_per_order"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in money})
    return out.withColumn("returning_customers", F.col("unique_customers") - F.col("new_customers")).withColumn(
        "conversion_rate", F.coalesce(F.try_divide(F.col("total_orders"), F.col("total_sessions")), F.lit(0.0))
    )


def product_performance(items: DataFrame, page_views: DataFrame) -> DataFrame:
    """Per product and day: units, revenue and orders from the lines (which carry
    ``order_date_key``), views and cart additions from page views, orders per view."""
    sold = items.groupBy("product_id", F.col("order_date_key").alias("date_key")).agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        exact_sum("line_total", 4).alias("revenue"),
        F.count_distinct("order_id").alias("orders_count"),
    )
    seen = page_views.where(F.col("product_id").isNotNull()).groupBy("product_id", "date_key").agg(
        F.count(F.lit(1)).alias("page_views"),
        F.count_if(F.col("event_type").isin("click", "add_to_cart")).alias("add_to_cart_count"),
    )
    out = sold.join(seen, ["product_id", "date_key"], "full_outer")
    counts = ["units_sold", "orders_count", "page_views", "add_to_cart_count"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return out.withColumn("revenue", F.coalesce("revenue", F.lit(0.0))).withColumn(
        "conversion_rate", F.coalesce(F.try_divide(F.col("orders_count"), F.col("page_views")), F.lit(0.0))
    )


def inventory_snapshot(products: DataFrame, items: DataFrame, day: Instant) -> DataFrame:
    """Stock of every product at the end of ``day``: on hand and available (nothing is
    reserved), units sold that day, whole days of supply at the rate of the last 30 days
    (NULL when nothing was sold), and value at cost. ``items`` carry the order time."""
    end = moment(as_date(day)) + F.expr("INTERVAL 1 DAY")
    sold = items.where((F.col("order_timestamp") >= end - F.expr("INTERVAL 30 DAYS")) & (F.col("order_timestamp") < end))
    rate = sold.groupBy("product_id").agg(
        F.sum("quantity").alias("recent"),
        F.sum(F.when(F.col("order_timestamp") >= moment(as_date(day)), F.col("quantity"))).alias("today"),
    )
    stock = F.col("stock_quantity")
    return products.join(rate, "product_id", "left").select(
        "product_id",
        date_key(F.lit(as_date(day))).alias("date_key"),
        stock.alias("quantity_on_hand"),
        F.lit(0).alias("quantity_reserved"),
        stock.alias("quantity_available"),
        (stock > 0).alias("is_in_stock"),
        F.floor(F.try_divide(stock, F.col("recent") / F.lit(30.0))).cast("bigint").alias("days_of_supply"),
        F.coalesce(F.col("today"), F.lit(0.0)).cast("bigint").alias("units_sold"),
        (F.rint(stock * F.col("cost_price") * 100) / 100).alias("inventory_value"),
    )


def campaign_metrics(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Click-through rate, cost per click and per conversion, and return on spend per
    campaign; ``orders`` carry ``campaign_id``. NULL where a ratio has no base."""
    revenue = orders.groupBy("campaign_id").agg(exact_sum("total_amount").alias("revenue"))
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return (
        campaigns.join(revenue, "campaign_id", "left")
        .withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
        .withColumn("ctr", ratio("clicks", "impressions"))
        .withColumn("cpc", ratio("spend", "clicks"))
        .withColumn("cpa", ratio("spend", "conversions"))
        .withColumn("roas", ratio("revenue", "spend"))
    )
