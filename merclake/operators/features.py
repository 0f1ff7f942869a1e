"""Customer and product features for models, churn and value scores, demand series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merclake.functions.columns import Instant, as_date, day_bucket, exact_mean, exact_sum, moment, require, whole_days
from merclake.functions.sequence import with_previous
from merclake.operators.enrichment import attach_quantiles
from merclake.session import materialize


def customer_features(orders: DataFrame, reference_date: Instant) -> DataFrame:
    """One row per customer: recency, counts, spend statistics, items, promotion use, tenure,
    orders per month and mean gap. Expects item_count, has_promo_code and is_first_order."""
    require(orders, ["customer_id", "order_timestamp", "total_amount", "item_count", "has_promo_code", "is_first_order"])
    base = orders.groupBy("customer_id").agg(
        whole_days(F.max("order_timestamp"), moment(reference_date)).alias("recency_days"),
        F.count(F.lit(1)).alias("order_count"),
        exact_sum("total_amount").alias("total_spend"),
        exact_mean("total_amount").alias("avg_order_value"),
        F.max("total_amount").alias("max_order_value"),
        F.min("total_amount").alias("min_order_value"),
        F.stddev_samp("total_amount").alias("std_order_value"),
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"),
        F.sum("item_count").alias("total_items"),
        F.try_divide(F.sum("item_count"), F.count("item_count")).alias("avg_items_per_order"),
        F.count_if("has_promo_code").alias("promo_order_count"),
        F.bool_or("is_first_order").alias("is_new_customer"),
    )
    n, life = F.col("order_count"), F.col("lifespan_days")
    return (
        base.withColumn("tenure_days", whole_days(F.col("first_order_date"), moment(reference_date)))
        .withColumn("lifespan_days", whole_days(F.col("first_order_date"), F.col("last_order_date")))
        .withColumn("promo_usage_rate", F.col("promo_order_count") / n)
        .withColumn("orders_per_month", F.when(life > 0, n / (life / F.lit(30.0))).otherwise(n.cast("double")))
        .withColumn("avg_days_between_orders", F.when(n > 1, life / (n - 1)))
    )


def product_features(items: DataFrame, products: DataFrame, reference_date: Instant) -> DataFrame:
    """Products with units, revenue, orders, mean quantity and price, price deviation, age and
    days of supply at the 30-day rate (999 when nothing was sold)."""
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        exact_sum("line_total", 4).alias("total_revenue"),
        F.count_distinct("order_id").alias("orders_count"),
        F.avg("quantity").alias("avg_quantity_per_order"),
        F.avg("unit_price").alias("avg_selling_price"),
        F.stddev_samp("unit_price").alias("price_variance"),
    )
    out = products.join(sold, "product_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_units_sold", "total_revenue", "orders_count")})
    if "launch_date" in products.columns:
        out = out.withColumn("days_since_launch", F.datediff(F.lit(as_date(reference_date)), "launch_date"))
    if "stock_quantity" in products.columns and "reorder_level" in products.columns:
        per_day = F.col("total_units_sold") / F.lit(30.0)
        out = out.withColumn(
            "days_of_supply",
            F.when(F.col("total_units_sold") > 0, F.col("stock_quantity") / per_day).otherwise(F.lit(999.0)),
        )
    return out


def _share_of(col: str, cut: Column) -> Column:
    return F.least(F.greatest(F.try_divide(F.col(col), cut), F.lit(0.0)), F.lit(1.0))


#: What the churn score measures order rate and spend against.
CHURN_QUANTILES = {"orders_per_month": [0.9], "total_spend": [0.9]}


def churn_features(
    features: DataFrame, lookback_days: int = 90, interpolation: str = "nearest", found: dict[str, list[float | None]] | None = None
) -> DataFrame:
    """Risk scores from recency (0-2) and from order rate and spend against their 90 %
    quantiles (0-1; ``found`` has them if they are known), weighted .5/.3/.2; churned above 0.7."""
    out = attach_quantiles(features, CHURN_QUANTILES, interpolation, found=found)
    recency = F.col("recency_days") / F.lit(float(lookback_days))
    risk = (
        F.col("recency_risk_score") * 0.5 + F.col("frequency_risk_score") * 0.3 + F.col("monetary_risk_score") * 0.2
    )
    return (
        out.withColumn("is_inactive", F.col("recency_days") > lookback_days)
        .withColumn("recency_risk_score", F.least(F.greatest(recency, F.lit(0.0)), F.lit(2.0)))
        .withColumn("frequency_risk_score", 1 - _share_of("orders_per_month", F.col("_q.orders_per_month")[0]))
        .withColumn("monetary_risk_score", 1 - _share_of("total_spend", F.col("_q.total_spend")[0]))
        .drop("_q")
        .withColumn("churn_risk_score", risk)
        .withColumn("is_churned", F.col("churn_risk_score") > 0.7)
    )


def churn_outlook(churn: DataFrame) -> DataFrame:
    """``churn_probability`` (the risk score, at most 1) and the expected next purchase: last
    order plus the customer's mean gap (NULL with a single order)."""
    gap = F.rint("avg_days_between_orders").cast("int")
    return churn.withColumn("churn_probability", F.least("churn_risk_score", F.lit(1.0))).withColumn(
        "predicted_next_purchase_date", F.date_add(F.to_date("last_order_date"), gap)
    )


def clv_features(features: DataFrame, projection_months: int = 12, interpolation: str = "nearest") -> DataFrame:
    out = attach_quantiles(features, {"total_spend": [0.25, 0.5, 0.75]}, interpolation)
    cut = lambda i: F.col("_q.total_spend")[i]
    spend = F.col("total_spend")
    return (
        out.withColumn("historical_clv", spend)
        .withColumn("projected_clv", F.col("avg_order_value") * F.col("orders_per_month") * projection_months)
        .withColumn("revenue_per_day", F.when(F.col("tenure_days") > 0, spend / F.col("tenure_days")).otherwise(0.0))
        .withColumn(
            "clv_quartile", F.when(spend >= cut(2), 4).when(spend >= cut(1), 3).when(spend >= cut(0), 2).otherwise(1)
        )
        .drop("_q")
    )


TARGETS = ("churn", "clv", "next_purchase")


def ml_dataset(orders: DataFrame, reference_date: Instant, target: str = "churn", **options) -> DataFrame:
    """Customer features plus those of the target, without dates, numeric NULLs as 0.
    ``next_purchase`` has the base features only."""
    if target not in TARGETS:
        raise ValueError(f"unknown target: {target}")
    out = customer_features(orders, reference_date)
    if target == "churn":
        out = churn_features(materialize(out), **options)
    elif target == "clv":
        out = clv_features(materialize(out), **options)
    return out.drop("first_order_date", "last_order_date").na.fill(0)


def behaviour_features(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer: distinct products and categories, favourite category, preferred weekday
    (1 = Monday) and hour, weekend shopper, returned lines. ``items`` carry the customer and
    ``is_returned``. Ties go to the smallest value. A customer is a weekend shopper when at
    least half of the orders fall on Saturday or Sunday."""
    by_product = items.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("is_returned").alias("returned")
    )
    by_category = (
        by_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("lines").alias("lines"), F.sum("returned").alias("returned"), F.count(F.lit(1)).alias("products"))
    )
    favourite = F.min_by("category", F.struct(-F.col("lines"), F.col("category")))
    bought = by_category.groupBy("customer_id").agg(
        F.sum("products").alias("unique_products_purchased"),
        F.count(F.lit(1)).alias("unique_categories_purchased"),
        favourite.alias("favorite_category"),
        (F.sum("returned") > 0).alias("has_returned_items"),
        F.try_divide(F.sum("returned"), F.sum("lines")).alias("return_rate"),
    )
    weekday = F.weekday("order_timestamp") + 1
    when = orders.groupBy("customer_id").agg(
        F.mode(weekday, True).alias("preferred_day_of_week"),
        F.mode(F.hour("order_timestamp"), True).alias("preferred_hour"),
        (F.count_if(weekday >= 6) * 2 >= F.count(F.lit(1))).alias("is_weekend_shopper"),
    )
    return when.join(bought, "customer_id", "left")


def product_behaviour(
    items: DataFrame, products: DataFrame, page_views: DataFrame, reference_date: Instant
) -> DataFrame:
    """Per product: customers, return rate, units per day over the last 7 and 30 days, views,
    cart additions, purchases, purchases per view, and the share of cart additions not bought.

    ``items`` carry customer and order time. Trailing windows end the day before the
    reference date. ``stockout`` is true when no stock is left."""
    ref = moment(as_date(reference_date))
    last = lambda days: (F.col("order_timestamp") >= ref - F.expr(f"INTERVAL {days} DAYS")) & (F.col("order_timestamp") < ref)
    sold = items.groupBy("product_id").agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.try_divide(F.count_if("is_returned"), F.count(F.lit(1))).alias("return_rate"),
        (F.coalesce(F.sum(F.when(last(7), F.col("quantity"))), F.lit(0.0)) / F.lit(7.0)).alias("sales_velocity_7d"),
        (F.coalesce(F.sum(F.when(last(30), F.col("quantity"))), F.lit(0.0)) / F.lit(30.0)).alias("sales_velocity_30d"),
    )
    seen = page_views.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count_if(F.col("event_type").isin("view", "page_view", "product_view")).alias("views"),
        F.count_if(F.col("event_type").isin("click", "add_to_cart")).alias("cart_additions"),
        F.count_if(F.col("event_type").isin("purchase", "checkout_completed")).alias("purchases"),
    )
    out = products.select("product_id", (F.col("stock_quantity") <= 0).alias("stockout"))
    out = out.join(sold, "product_id", "left").join(seen, "product_id", "left")
    counts = ["unique_customers", "views", "cart_additions", "purchases"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("sales_velocity_7d", "sales_velocity_30d")})
    lost = F.greatest(F.lit(0.0), 1 - F.try_divide(F.col("purchases"), F.col("cart_additions")))
    return out.withColumn("conversion_rate", F.try_divide(F.col("purchases"), F.col("views"))).withColumn(
        "cart_abandonment_rate", F.when(F.col("cart_additions") > 0, lost)
    )


def stockout_frequency(levels: DataFrame, time_col: str = "snapshot_at", id_col: str = "snapshot_id") -> DataFrame:
    """``(product_id, stockout_frequency)``: how often the stock of a product ran out, that is fell to zero or below
    from more, or was empty at the first snapshot. ``levels`` has product_id, stock_quantity, a time and an id."""
    before = with_previous(levels, ["product_id"], [time_col, id_col], {"_before": "stock_quantity"}, day_bucket(time_col))
    ran_out = (F.col("stock_quantity") <= 0) & (F.coalesce("_before", F.lit(1)) > 0)
    return before.groupBy("product_id").agg(F.count_if(ran_out).alias("stockout_frequency"))


def demand_features(items: DataFrame, lags: tuple[int, ...] = (1, 7), means: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Units per product and day of sale with the units k days before (0 on a day without a
    sale, NULL before the product's first day) and the mean over the last k calendar days, or
    over the days since the first when they are fewer. ``items`` carry the order time.

    Calendar gaps are handled by range frames, so no row is made for a day without a sale."""
    daily = items.groupBy("product_id", F.to_date("order_timestamp").alias("day")).agg(F.sum("quantity").alias("units"))
    # a product has at most one row per calendar day here
    order = W.partitionBy("product_id").orderBy("_n")
    out = daily.withColumn("_n", F.unix_date("day"))
    out = out.withColumn("_age", F.col("_n") - F.min("_n").over(order.rangeBetween(W.unboundedPreceding, 0)))
    for k in lags:
        then = F.coalesce(F.sum("units").over(order.rangeBetween(-k, -k)), F.lit(0.0))
        out = out.withColumn(f"units_lag_{k}", F.when(F.col("_age") >= k, then))
    for k in means:
        total = F.sum("units").over(order.rangeBetween(-(k - 1), 0))
        out = out.withColumn(f"units_mean_{k}", total / F.least(F.lit(k), F.col("_age") + 1))
    return out.drop("_n", "_age")
