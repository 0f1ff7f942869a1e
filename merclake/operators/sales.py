"""Sales, customer and catalogue reports over the star schema."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merclake.functions.columns import (
    Instant, as_date, exact_mean, exact_sum, from_minor, minor_units, moment, wide_sum, within_days,
)


def _distinct(col: str | Column, approx: bool) -> Column:
    return F.approx_count_distinct(col) if approx else F.count_distinct(col if isinstance(col, Column) else F.col(col))


def sales_overview(
    orders: DataFrame, start: Instant, end: Instant, compare_previous: bool = True,
    page_views: DataFrame | None = None, approx: bool = False,
) -> DataFrame:
    """One row: revenue, orders, average order value, customers, and growth against the
    equally long period that ends the day before ``start``. Both periods are read in one scan.
    Growth is NULL where the previous period has no revenue or orders. ``conversion_rate``
    (orders per session) is filled when page views with a ``session_id`` are given."""
    first, last = as_date(start), as_date(end)
    prev_last = first - timedelta(days=1)
    prev_first = prev_last - (last - first)
    scope = orders.where(within_days("order_timestamp", prev_first if compare_previous else first, last))
    now = F.col("order_timestamp") >= moment(first)
    total, size = F.col("total_amount"), F.col("order_id")
    out = scope.agg(
        F.coalesce(exact_sum(F.when(now, total)), F.lit(0.0)).alias("total_revenue"),
        F.count(F.when(now, size)).alias("total_orders"),
        F.coalesce(exact_mean(F.when(now, total)), F.lit(0.0)).alias("avg_order_value"),
        _distinct(F.when(now, F.col("customer_id")), approx).alias("total_customers"),
        exact_sum(F.when(~now, total)).alias("_revenue"),
        F.count(F.when(~now, size)).alias("_orders"),
    )
    growth = lambda cur, prev: F.when(F.col(prev) > 0, (F.col(cur) - F.col(prev)) / F.col(prev) * 100)
    out = out.select(
        "total_revenue", "total_orders", "avg_order_value", "total_customers",
        (growth("total_revenue", "_revenue") if compare_previous else F.lit(None).cast("double")).alias("revenue_growth"),
        (growth("total_orders", "_orders") if compare_previous else F.lit(None).cast("double")).alias("orders_growth"),
    )
    if page_views is not None:
        sessions = page_views.where(within_days("event_timestamp", first, last)).agg(F.count_distinct("session_id"))
        out = out.withColumn("conversion_rate", F.try_divide(F.col("total_orders"), sessions.scalar()))
    return out


def sales_metrics(orders: DataFrame, start: Instant | None = None, end: Instant | None = None) -> DataFrame:
    return orders.where(within_days("order_timestamp", start, end)).agg(
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.coalesce(exact_mean("total_amount"), F.lit(0.0)).alias("avg_order_value"),
        F.count_distinct("customer_id").alias("total_customers"),
    )


def sales_trend(
    orders: DataFrame, start: Instant, end: Instant, granularity: str = "day", approx: bool = False
) -> DataFrame:
    """Revenue, orders and customers per day, week (from Monday) or month."""
    if granularity not in ("day", "week", "month"):
        raise ValueError(f"unknown granularity: {granularity}")
    period = F.to_date("order_timestamp") if granularity == "day" else F.trunc(F.to_date("order_timestamp"), granularity)
    return (
        orders.where(within_days("order_timestamp", start, end))
        .groupBy(period.alias("period"))
        .agg(
            exact_sum("total_amount").alias("revenue"),
            F.count("order_id").alias("orders"),
            _distinct("customer_id", approx).alias("customers"),
        )
    )


def sales_trend_totals(trend: DataFrame) -> DataFrame:
    return trend.agg(
        F.coalesce(exact_sum("revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
    )


def sales_by_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, start: Instant, end: Instant
) -> DataFrame:
    """Revenue, distinct orders and revenue share per category."""
    picked = orders.where(within_days("order_timestamp", start, end)).select("order_id")
    # Fold lines of one order and category before counting, so the wide join result is
    # reduced map-side and a category that holds most rows is spread by order.
    per_order = (
        items.select("order_id", "product_id", "line_total")
        .join(picked, "order_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "order_id")
        .agg(F.sum(minor_units("line_total", 4)).alias("_minor"))
    )
    by_category = per_order.groupBy("category").agg(
        wide_sum(F.col("_minor")).alias("_minor"), F.count(F.lit(1)).alias("orders")
    )
    # one row per category of the catalogue
    total = F.sum("_minor").over(W.partitionBy(F.lit(0))).cast("double")
    share = F.try_divide(F.col("_minor").cast("double") * F.lit(100.0), total)
    return by_category.select(
        "category", from_minor(F.col("_minor"), 4).alias("revenue"), "orders",
        F.coalesce(share, F.lit(0.0)).alias("percentage"),
    )


def hourly_distribution(orders: DataFrame, start: Instant | None = None, end: Instant | None = None) -> DataFrame:
    return (
        orders.where(within_days("order_timestamp", start, end))
        .groupBy(F.hour("order_timestamp").alias("hour"))
        .agg(F.count("order_id").alias("orders"), exact_sum("total_amount").alias("revenue"))
    )


def customer_cohorts(customers: DataFrame, limit: int | None = 12) -> DataFrame:
    """The newest ``limit`` first-order months with size, mean lifetime value and mean orders."""
    cohorts = (
        customers.where(F.col("is_current") & F.col("first_order_date").isNotNull())
        .groupBy(F.date_format("first_order_date", "yyyy-MM").alias("cohort"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            exact_mean("lifetime_value").alias("avg_ltv"),
            F.try_divide(F.sum("total_orders"), F.count("total_orders")).alias("avg_orders"),
        )
    )
    return cohorts if limit is None else cohorts.orderBy(F.col("cohort").desc()).limit(limit)


def order_metrics(
    orders: DataFrame, start: Instant | None = None, end: Instant | None = None, approx: bool = False
) -> DataFrame:
    return orders.where(within_days("order_timestamp", start, end)).agg(
        F.count("order_id").alias("total_orders"),
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(exact_mean("total_amount"), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("total_items_sold"),
        _distinct("customer_id", approx).alias("unique_customers"),
    )


def customer_metrics(customers: DataFrame) -> DataFrame:
    """All five figures in one pass."""
    return customers.where("is_current").agg(
        F.count("customer_id").alias("total_customers"),
        F.count_if(F.col("segment") == "new").alias("new_customers"),
        F.count_if(F.col("segment") == "vip").alias("vip_customers"),
        F.count_if(F.col("segment") == "at_risk").alias("at_risk_customers"),
        F.coalesce(exact_mean("lifetime_value"), F.lit(0.0)).alias("avg_lifetime_value"),
    )


def segment_distribution(customers: DataFrame) -> DataFrame:
    return customers.where("is_current").groupBy("segment").agg(
        F.count("customer_id").alias("count"), F.coalesce(exact_mean("lifetime_value"), F.lit(0.0)).alias("avg_ltv")
    )


def weighted_avg_ltv(segments: DataFrame) -> DataFrame:
    """Mean lifetime value over segments, weighted by their size."""
    return segments.agg(
        F.try_divide(F.sum(F.col("avg_ltv") * F.col("count")), F.sum("count")).alias("avg_lifetime_value")
    )


def product_metrics(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("product_id").alias("total_products"),
        F.count_if("is_active").alias("active_products"),
        F.count_if(~F.col("is_in_stock")).alias("out_of_stock"),
        F.coalesce(exact_mean("unit_price"), F.lit(0.0)).alias("avg_price"),
        F.count_distinct("category").alias("categories_count"),
    )


def category_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(F.count("product_id").alias("count"))


def top_selling_products(
    items: DataFrame, products: DataFrame, orders: DataFrame, limit: int, start: Instant, end: Instant
) -> DataFrame:
    """Best products by revenue; lines are summed per product before product columns are joined."""
    picked = orders.where(within_days("order_timestamp", start, end)).select("order_id")
    sold = (
        items.select("order_id", "product_id", "quantity", "line_total")
        .join(picked, "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), exact_sum("line_total", 4).alias("revenue"))
    )
    return (
        sold.join(products.select("product_id", "name", "category"), "product_id")
        .orderBy(F.col("revenue").desc_nulls_last(), "product_id")
        .limit(limit)
        .select("product_id", "name", "category", "units_sold", "revenue")
    )


def weekday_averages(orders: DataFrame) -> DataFrame:
    """Mean daily revenue and orders per weekday (0 = Monday), over the days that have orders."""
    daily = orders.groupBy(F.to_date("order_timestamp").alias("day")).agg(
        exact_sum("total_amount").alias("revenue"), F.count("order_id").alias("orders")
    )
    return daily.groupBy(F.weekday("day").alias("day_of_week")).agg(
        exact_mean("revenue").alias("avg_revenue"),
        F.try_divide(F.sum("orders"), F.count("orders")).alias("avg_orders"),
    )


def payment_method_share(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("payment_method").agg(
        F.count("order_id").alias("orders"), exact_sum("total_amount").alias("revenue")
    )
    # one row per payment method
    return counts.withColumn(
        "percentage", F.col("orders") * F.lit(100.0) / F.sum("orders").over(W.partitionBy(F.lit(0)))
    )


#: Upper bounds of the lifetime-value buckets.
LTV_BUCKETS = [(100.0, "0-100"), (500.0, "100-500"), (1000.0, "500-1000")]
LTV_TOP_BUCKET = "1000+"


def ltv_bucket_share(customers: DataFrame) -> DataFrame:
    """Customers per lifetime-value bucket; a bucket holds its lower bound, not its upper one."""
    label = F.lit(LTV_TOP_BUCKET)
    for upper, name in reversed(LTV_BUCKETS):
        label = F.when(F.col("lifetime_value") < upper, F.lit(name)).otherwise(label)
    counts = (
        customers.where(F.col("is_current") & F.col("lifetime_value").isNotNull())
        .groupBy(label.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return counts.withColumn(
        "percentage", F.col("customers") * F.lit(100.0) / F.sum("customers").over(W.partitionBy(F.lit(0)))
    )
