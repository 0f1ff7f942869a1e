"""Raw commerce files -> star-schema columns, and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from merclake.functions.columns import Instant, as_date, date_key


# Fixed value: address that page types are appended to.
STORE_URL = "http://store.com/"


def _masked_initial(c: str):
    return F.concat(F.left(F.col(c), F.lit(1)), F.lit("***"))


def load_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        F.col("customer_id").alias("customer_key"),
        F.sha2(F.col("email"), 256).alias("email_hash"),
        _masked_initial("first_name").alias("first_name_masked"),
        _masked_initial("last_name").alias("last_name_masked"),
        "country",
        F.lower("segment").alias("segment"),
        "lifetime_value",
        "total_orders",
        F.lit(True).alias("is_current"),
    )


def load_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id", F.col("sku").alias("product_key"), "sku", "name", F.lower("category").alias("category"),
        "unit_price", "cost_price", "stock_quantity", "avg_rating",
        F.lit(True).alias("is_active"), (F.col("stock_quantity") > 0).alias("is_in_stock"),
    )


def load_orders(raw: DataFrame) -> DataFrame:
    ts = F.col("order_timestamp").cast("timestamp_ntz")
    return raw.select(
        "order_id", "order_number", "customer_id", date_key(ts).alias("order_date_key"),
        F.lower("status").alias("status"), ts.alias("order_timestamp"), "item_count", "subtotal", "tax_amount",
        "shipping_amount", "total_amount", "payment_method", "device_type",
    )


def load_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
    )


def load_clickstream(raw: DataFrame) -> DataFrame:
    """The session stands in for the visitor; the text ``None`` is no customer."""
    ts = F.col("event_timestamp").cast("timestamp_ntz")
    return raw.select(
        F.col("event_id").alias("page_view_id"), "session_id", F.col("session_id").alias("visitor_id"),
        F.when(F.col("customer_id") != "None", F.col("customer_id")).alias("customer_id"),
        date_key(ts).alias("date_key"), ts.alias("event_timestamp"),
        F.concat(F.lit(STORE_URL), F.col("page_type")).alias("page_url"),
        F.concat(F.lit("/"), F.col("page_type")).alias("page_path"),
        "page_type", "device_type", F.col("time_on_page").alias("time_on_page_seconds"),
    )


LOADERS = {
    "customers": load_customers, "products": load_products, "orders": load_orders,
    "order_items": load_order_items, "clickstream": load_clickstream,
}


def calendar(days: DataFrame, day_col: str = "full_date") -> DataFrame:
    """Calendar columns for a frame with one date per row. Weekdays run from 0 = Monday, the
    week is the ISO week, and the fiscal year is the calendar year."""
    d = F.col(day_col)
    return days.select(
        date_key(d).alias("date_key"), d.alias("full_date"), F.weekday(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"),
        F.year(d).alias("year"), (F.weekday(d) >= 5).alias("is_weekend"), F.lit(False).alias("is_holiday"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"),
    )


def dim_date(spark: SparkSession, start: Instant, end: Instant) -> DataFrame:
    bounds = spark.range(1).select(
        F.explode(F.sequence(F.lit(as_date(start)), F.lit(as_date(end)), F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    return calendar(bounds)


def dim_date_of(df: DataFrame, time_col: str) -> DataFrame:
    """The calendar from the first to the last day of a table."""
    span = df.agg(F.min(F.to_date(time_col)).alias("lo"), F.max(F.to_date(time_col)).alias("hi"))
    return calendar(span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")))
