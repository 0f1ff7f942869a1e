"""The star schema over the given Parquet tables.

Each function returns the columns of one model table. Columns the tables do not
hold are stand-ins; they are defined here and nowhere else. Joins are added only
by the function that needs them, so a query over order totals never reads line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merclake.functions.columns import date_key, exact_sum
from merclake.operators.enrichment import customer_lifetime_value, enrich_customers, first_order_flag, with_location
from merclake.streaming.windows import sessionize

#: "Today" for every recency and trailing window: the day after the last order.
REFERENCE_DATE = "2001-08-02"
FIRST_DAY = "1995-01-01"
LAST_DAY = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("processing")
    )
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        date_key("o_orderdate").alias("order_date_key"),
        status.alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") * 100).alias("discount_percent"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_total"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
    )


def items_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's customer and time."""
    orders = fact_orders(spark, sf_dir).select("order_id", "customer_id", "order_timestamp", "order_date_key")
    return fact_order_items(spark, sf_dir).join(orders, "order_id")


def fact_orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the measures that come from their lines."""
    li = table(spark, sf_dir, "lineitem")
    gross = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    cut = F.rint(F.col("l_extendedprice") * F.col("l_discount") * 10000).cast("bigint")
    lines = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("item_count"),
        (F.sum(gross) / F.lit(100.0)).alias("subtotal"),
        (F.sum(cut) / F.lit(10000.0)).alias("discount_amount"),
        (F.max("l_discount") >= 0.05).alias("has_promo_code"),
    )
    return (
        fact_orders(spark, sf_dir)
        .join(lines, "order_id", "left")
        .withColumn("item_count", F.coalesce("item_count", F.lit(0)))
        .withColumn("subtotal", F.coalesce("subtotal", F.lit(0.0)))
        .withColumn("discount_amount", F.coalesce("discount_amount", F.lit(0.0)))
        .withColumn("shipping_amount", F.lit(0.0))
        .withColumn("has_promo_code", F.coalesce("has_promo_code", F.lit(False)))
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        (F.rint(F.col("p_retailprice") * 60) / 100).alias("cost_price"),
        F.col("p_size").alias("stock_quantity"),
        F.lit(10).alias("reorder_level"),
        (F.col("p_size") > 0).alias("is_in_stock"),
        F.lit(True).alias("is_active"),
        F.lit(0.0).alias("avg_rating"),
        F.lit("1995-01-01").cast("date").alias("launch_date"),
    )


def dim_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one row per nation; nation and region are reference tables of fixed size."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


def dim_customers_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_key"),
        F.col("c_nationkey").alias("location_id"),
        F.col("c_mktsegment").alias("market_segment"),
        F.lit(True).alias("is_current"),
    )


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("page_view_id"),
        F.col("user_id").alias("visitor_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_timestamp"),
        date_key("ts").alias("date_key"),
        F.col("event_type"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as orders: the only amounts with a time of day."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_timestamp"),
        F.col("value").alias("total_amount"),
    )


def customer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with lifetime value and order counts only."""
    value = customer_lifetime_value(fact_orders(spark, sf_dir), REFERENCE_DATE)
    return dim_customers_base(spark, sf_dir).join(value, "customer_id", "left")


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with location, segment, lifetime value, order counts and acquisition month."""
    base = with_location(dim_customers_base(spark, sf_dir), dim_locations(spark, sf_dir))
    orders = fact_orders(spark, sf_dir)
    return enrich_customers(base, orders, REFERENCE_DATE).withColumnRenamed("customer_segment", "segment")


def orders_for_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide orders with the first-order flag, as the feature operators expect them."""
    return first_order_flag(fact_orders_wide(spark, sf_dir))


def session_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize(page_views(spark, sf_dir))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in: one campaign per market segment; views, clicks and purchases of its customers
    are impressions, clicks and conversions, the value of its clicks is the spend."""
    people = dim_customers_base(spark, sf_dir).select("customer_id", "market_segment")
    seen = page_views(spark, sf_dir).groupBy("customer_id").agg(
        F.count_if(F.col("event_type") == "view").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("conversions"),
        exact_sum(F.when(F.col("event_type") == "click", F.col("value"))).alias("spend"),
    )
    return (
        people.join(seen, "customer_id")
        .groupBy(F.col("market_segment").alias("campaign_id"))
        .agg(
            F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"), F.coalesce(exact_sum("spend"), F.lit(0.0)).alias("spend"),
        )
    )


def campaign_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dim_customers_base(spark, sf_dir).select("customer_id", F.col("market_segment").alias("campaign_id"))
    return fact_orders(spark, sf_dir).join(people, "customer_id")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as a careless export would hold them: blanks around text, five date formats,
    currency signs, missing discounts, and every seventh order twice."""
    o = table(spark, sf_dir, "orders")
    kind = F.pmod("o_orderkey", F.lit(5))
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    for i, fmt in enumerate(["yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy-MM-dd'T'HH:mm:ss"], start=1):
        text = F.when(kind == i, F.date_format("o_orderdate", fmt)).otherwise(text)
    times = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, 2).otherwise(1)
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.concat(F.lit("  ORD-"), F.col("o_orderkey").cast("string"), F.lit("\t")).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        text.alias("order_timestamp"),
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("\n")).alias("payment_method"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("total_amount"),
        F.concat(F.format_number("o_totalprice", 2), F.lit(" €")).alias("subtotal"),
        F.when(kind == 0, F.lit("£1.50")).alias("discount_amount"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("_copy"),
    ).drop("_copy")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with untidy names, addresses (every tenth broken), phones and countries."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    email = F.concat(F.lit(" User."), key, F.lit("@Example.COM "))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("customer_key"),
        F.when(F.pmod("c_custkey", F.lit(10)) == 0, F.concat(F.lit("user"), key, F.lit(" at example"))).otherwise(email).alias("email"),
        F.concat(F.lit("+1 (555) 0"), key).alias("phone"),
        F.concat(F.lit(" o'"), F.lower("c_mktsegment"), F.lit("-JANE")).alias("first_name"),
        F.upper("c_mktsegment").alias("last_name"),
        F.lower("n_name").alias("country"),
        F.when(F.pmod("c_custkey", F.lit(3)) > 0, F.lit(4).cast("bigint")).alias("total_orders"),
        F.col("c_acctbal").alias("lifetime_value"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with text prices; every fiftieth has none and every ninth no stock figure."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    price = F.concat(F.lit("€ "), F.format_number("p_retailprice", 2))
    return p.select(
        key.alias("product_id"),
        F.concat(F.lit(" SKU-"), key.cast("string")).alias("sku"),
        F.concat(F.lit("\t"), F.col("p_name"), F.lit(" ")).alias("name"),
        F.col("p_type").alias("category"),
        F.when(F.pmod(key, F.lit(50)) == 0, "0").otherwise(price).alias("unit_price"),
        F.format_number(F.rint(F.col("p_retailprice") * 60) / 100, 2).alias("cost_price"),
        F.when(F.pmod(key, F.lit(9)) > 0, F.col("p_size")).alias("stock_quantity"),
    )


def _json_event(**fields) -> Column:
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as ``(topic, value)`` messages: views and clicks of the shop, orders, and
    registrations. Error events become broken JSON (even ids) or an unknown type (odd ids)."""
    e = table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", '"k": *(-?[0-9]+)', 1))
    k = F.col("k")
    kind = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "click", "add_to_cart")
        .when(F.col("event_type") == "purchase", "order_created")
        .when(F.col("event_type") == "signup", "user_registered")
        .otherwise("unheard_of")
    )
    user = F.col("user_id").cast("string")
    value = _json_event(
        event_id=F.col("event_id").cast("string"), event_type=kind,
        event_timestamp=F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        order_id=F.concat(F.lit("ORD-"), F.col("event_id").cast("string")), customer_id=user,
        total_amount=F.col("value"), session_id=F.concat(F.lit("s-"), user), visitor_id=user,
        page_url=F.concat(F.lit("http://store.com/p/"), k), page_path=F.concat(F.lit("/p/"), k),
        product_id=k, product_name=F.concat(F.lit("item "), k), quantity=F.lit(1), unit_price=F.col("value"),
    )
    broken = (F.col("event_type") == "error") & (F.pmod("event_id", F.lit(2)) == 0)
    topic = F.when(F.col("event_type") == "purchase", "orders").when(
        F.col("event_type").isin("view", "click"), "clickstream"
    ).otherwise("events")
    return e.select(topic.alias("topic"), F.when(broken, F.concat(F.lit("{"), "event_type")).otherwise(value).alias("value"))


def raw_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of every purchase as messages, newest first: created; payment after half an
    hour (ids divisible by 3); update to ``processing`` after one hour (even ids); cancellation
    after two (ids divisible by 5), else shipment after three (ids divisible by 7)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    ident = F.col("event_id")
    step = lambda test, kind, minutes, status: F.when(
        test, F.struct(F.lit(kind).alias("kind"), F.lit(minutes).alias("minutes"), F.lit(status).alias("status"))
    )
    cancelled = F.pmod(ident, F.lit(5)) == 0
    life = F.array_compact(
        F.array(
            step(~cancelled & (F.pmod(ident, F.lit(7)) == 0), "shipment_created", 180, None),
            step(cancelled, "order_cancelled", 120, None),
            step(F.pmod(ident, F.lit(2)) == 0, "order_updated", 60, "processing"),
            step(F.pmod(ident, F.lit(3)) == 0, "payment_received", 30, None),
            step(F.lit(True), "order_created", 0, None),
        )
    )
    rows = e.select("event_id", "ts", "user_id", "value", F.explode(life).alias("s"))
    at = F.col("ts") + F.make_dt_interval(mins=F.col("s.minutes"))
    value = _json_event(
        event_id=F.concat_ws("-", F.col("event_id").cast("string"), F.col("s.kind")), event_type=F.col("s.kind"),
        event_timestamp=F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        order_id=F.concat(F.lit("ORD-"), F.col("event_id").cast("string")), customer_id=F.col("user_id").cast("string"),
        total_amount=F.col("value"), status=F.col("s.status"),
    )
    return rows.select(F.lit("orders").alias("topic"), value.alias("value"))
