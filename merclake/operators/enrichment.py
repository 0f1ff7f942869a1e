"""Customer value, time features, sessions and cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merclake.functions.columns import (
    Instant, cohort_label, day_bucket, exact_mean, exact_sum, moment, seconds_between, whole_days,
)
from merclake.functions.ranks import cuts
from merclake.functions.sequence import beside, ranged, with_dense_rank, with_previous
from merclake.session import materialize


def attach_quantiles(
    df: DataFrame, probs: dict[str, list[float]], interpolation: str, name: str = "_q", found: dict[str, list[float | None]] | None = None
) -> DataFrame:
    """Add a struct column with one array of quantiles per column of ``probs``, as literals: the quantiles are
    computed first, so that nothing of their search is repeated in the plan of the result."""
    found = cuts(df, probs, interpolation) if found is None else found
    arrays = [F.array(*[F.lit(v).cast("double") for v in values]).alias(c) for c, values in found.items()]
    return df.withColumn(name, F.struct(*arrays))


def _steps(value: str, cuts: str, high_is_good: bool) -> Column:
    v = F.col(value)
    at = lambda i: F.col(f"_q.{cuts}")[i]
    if high_is_good:
        return (
            F.when(v >= at(3), 5).when(v >= at(2), 4).when(v >= at(1), 3).when(v >= at(0), 2).otherwise(1)
        )
    return F.when(v <= at(0), 5).when(v <= at(1), 4).when(v <= at(2), 3).when(v <= at(3), 2).otherwise(1)


#: Least combined score of each segment, best first.
RFM_SEGMENTS = [(12, "vip"), (9, "loyal"), (6, "potential")]


def _per_customer(orders: DataFrame, customer_col: str, date_col: str, amount_col: str) -> DataFrame:
    return orders.groupBy(customer_col).agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(amount_col).alias("total_revenue"),
        exact_mean(amount_col).alias("avg_order_value"),
        F.min(date_col).alias("first_order_date"),
        F.max(date_col).alias("last_order_date"),
    )


def _with_rfm(base: DataFrame, reference_date: Instant, interpolation: str) -> DataFrame:
    fifths = [0.2, 0.4, 0.6, 0.8]
    measured = materialize(base).withColumns({
        "recency_days": whole_days(F.col("last_order_date"), moment(reference_date)),
        "frequency": F.col("total_orders"),
        "monetary": F.col("total_revenue"),
    })
    scored = attach_quantiles(
        measured, {"recency_days": fifths, "frequency": fifths, "monetary": fifths}, interpolation
    )
    total = F.col("rfm_recency_score") + F.col("rfm_frequency_score") + F.col("rfm_monetary_score")
    label = F.when(F.col("rfm_recency_score") <= 2, "at_risk").otherwise("new")
    for least, name in reversed(RFM_SEGMENTS):
        label = F.when(F.col("rfm_combined_score") >= least, name).otherwise(label)
    return (
        scored.withColumns({
            "rfm_recency_score": _steps("recency_days", "recency_days", False),
            "rfm_frequency_score": _steps("frequency", "frequency", True),
            "rfm_monetary_score": _steps("monetary", "monetary", True),
        })
        .drop("_q")
        .withColumn("rfm_combined_score", total)
        .withColumn("customer_segment", label)
    )


def _with_value(base: DataFrame, reference_date: Instant) -> DataFrame:
    lifespan = F.col("customer_lifespan_days")
    orders = F.col("total_orders")
    return (
        base.withColumn("customer_lifespan_days", whole_days(F.col("first_order_date"), F.col("last_order_date")))
        .withColumn("days_since_first_order", whole_days(F.col("first_order_date"), moment(reference_date)))
        .withColumn(
            "purchase_frequency_yearly",
            F.when(lifespan > 0, orders / (lifespan / F.lit(365.0))).otherwise(orders.cast("double")),
        )
        .withColumn("projected_annual_value", F.col("avg_order_value") * F.col("purchase_frequency_yearly"))
        .withColumn("lifetime_value", F.col("total_revenue"))
    )


RFM_COLUMNS = [
    "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score", "rfm_combined_score", "customer_segment",
]
VALUE_COLUMNS = [
    "total_orders", "total_revenue", "avg_order_value", "lifetime_value", "purchase_frequency_yearly",
    "first_order_date", "last_order_date",
]


def rfm_scores(
    orders: DataFrame, reference_date: Instant, customer_col: str = "customer_id",
    date_col: str = "order_timestamp", amount_col: str = "total_amount", interpolation: str = "nearest",
) -> DataFrame:
    """Recency, frequency and monetary value per customer, each scored 1-5 against the
    20/40/60/80 % quantiles over all customers, the combined score and its segment."""
    base = _per_customer(orders, customer_col, date_col, amount_col)
    out = _with_rfm(base, reference_date, interpolation)
    return out.select(customer_col, "recency_days", "frequency", "monetary", *RFM_COLUMNS)


def customer_lifetime_value(
    orders: DataFrame, reference_date: Instant, customer_col: str = "customer_id",
    date_col: str = "order_timestamp", amount_col: str = "total_amount",
) -> DataFrame:
    """Historical value and a one-year projection (mean order value x orders per year)."""
    return _with_value(_per_customer(orders, customer_col, date_col, amount_col), reference_date)


def add_cohorts(df: DataFrame, date_col: str = "first_order_date", granularity: str = "month") -> DataFrame:
    if date_col not in df.columns:
        return df
    return df.withColumn("acquisition_cohort", cohort_label(date_col, granularity))


def enrich_customers(
    customers: DataFrame, orders: DataFrame, reference_date: Instant, interpolation: str = "nearest"
) -> DataFrame:
    """Customers with their RFM scores, lifetime value and acquisition month. Columns the
    customer frame already has under the same names are replaced."""
    base = _per_customer(orders, "customer_id", "order_timestamp", "total_amount")
    scored = _with_value(_with_rfm(base, reference_date, interpolation), reference_date)
    wanted = RFM_COLUMNS + VALUE_COLUMNS
    out = customers.drop(*wanted).join(scored.select("customer_id", *wanted), "customer_id", "left")
    return add_cohorts(out)


def order_time_features(
    orders: DataFrame, date_col: str = "order_timestamp", legacy_weekend: bool = False
) -> DataFrame:
    """Weekday (1 = Monday), hour, month, quarter, weekend flag, the customer's order
    sequence (equal times share a number) and a first-order flag.

    The weekend is Saturday and Sunday; ``legacy_weekend`` counts Friday too."""
    weekday = F.weekday(date_col) + 1
    out = (
        orders.withColumn("order_day_of_week", weekday)
        .withColumn("order_hour", F.hour(date_col))
        .withColumn("order_month", F.month(date_col))
        .withColumn("order_quarter", F.quarter(date_col))
        .withColumn("is_weekend_order", weekday >= (5 if legacy_weekend else 6))
    )
    if "customer_id" not in orders.columns:
        return out
    out = with_dense_rank(out, ["customer_id"], date_col, "customer_order_sequence", day_bucket(date_col))
    return out.withColumn("is_first_order", F.col("customer_order_sequence") == 1)


def first_order_flag(orders: DataFrame, date_col: str = "order_timestamp") -> DataFrame:
    """Add ``is_first_order``: whether no order of the customer is earlier. A combinable minimum, no ranks."""
    first = orders.groupBy("customer_id").agg(F.min(date_col).alias("_first"))
    return beside(orders, first, ["customer_id"]).withColumn("is_first_order", F.col(date_col) == F.col("_first")).drop("_first")


def days_since_previous_order(orders: DataFrame, date_col: str = "order_timestamp", id_col: str = "order_id") -> DataFrame:
    """Whole days since the customer's preceding order; NULL on the first. Orders without a customer
    follow each other like those of one customer, spread over ranges of equal size."""
    rows = ranged(orders, ["customer_id", date_col, id_col])
    out = with_previous(rows, ["customer_id"], [date_col, id_col], {"_before": date_col}, F.col("_range")).drop("_range")
    return out.withColumn("days_since_previous_order", whole_days(F.col("_before"), F.col(date_col))).drop("_before")


def product_sales_metrics(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products with units, revenue, line count, mean selling price and units per day over
    the whole order period (when the lines carry ``order_timestamp``)."""
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        exact_sum("line_total", 4).alias("total_product_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.avg(F.try_divide(F.col("line_total"), F.col("quantity"))).alias("avg_selling_price"),
    )
    if "order_timestamp" in items.columns:
        length = seconds_between(F.min("order_timestamp"), F.max("order_timestamp")) / F.lit(86400.0)
        days = items.agg(F.greatest(length, F.lit(1.0)).alias("d")).scalar()
        sold = sold.withColumn("sales_velocity_daily", F.col("total_units_sold") / days)
    out = products.join(sold, "product_id", "left")
    for c in ("total_units_sold", "total_product_revenue", "order_count"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out


def session_metrics(page_views: DataFrame, session_col: str = "session_id", time_col: str = "event_timestamp") -> DataFrame:
    """Page views with the number of pages and the duration of their session.

    The per-session sums combine before the shuffle; only the join carries full
    rows, and AQE splits a session that outgrows one task."""
    per_session = page_views.groupBy(session_col).agg(
        F.count(F.lit(1)).alias("pages_per_session"),
        F.min(time_col).alias("session_start"),
        F.max(time_col).alias("session_end"),
    ).withColumn("session_duration_seconds", seconds_between(F.col("session_start"), F.col("session_end")))
    return page_views.join(per_session, session_col, "left")


#: Fixed value: default salt of the PII hash.
DEFAULT_SALT = "ecommerce-salt"


def hash_pii(df: DataFrame, columns: list[str], salt: str = DEFAULT_SALT, drop_raw: bool = False) -> DataFrame:
    """Add ``{c}_hash`` (salted SHA-256; NULL and '' stay NULL) and ``{c}_masked`` (first and
    last two characters around ``***``; up to four characters give ``***``)."""
    for c in [c for c in columns if c in df.columns]:
        col = F.col(c).cast("string")
        df = df.withColumn(
            f"{c}_hash", F.when(F.length(col) > 0, F.sha2(F.concat(F.lit(salt), col), 256))
        ).withColumn(
            f"{c}_masked",
            F.when(F.length(col) > 4, F.concat(F.left(col, F.lit(2)), F.lit("***"), F.right(col, F.lit(2)))).when(
                col.isNotNull(), F.lit("***")
            ),
        )
    return df.drop(*columns) if drop_raw else df


def url_parameters(df: DataFrame, url_col: str = "page_url", referrer_col: str | None = None) -> DataFrame:
    """UTM source, medium and campaign from the URL's query, and the referrer's host."""
    for name in ("utm_source", "utm_medium", "utm_campaign"):
        df = df.withColumn(name, F.try_parse_url(F.col(url_col), F.lit("QUERY"), F.lit(name)))
    if referrer_col:
        df = df.withColumn("referrer_domain", F.try_parse_url(F.col(referrer_col), F.lit("HOST")))
    return df


def with_location(df: DataFrame, locations: DataFrame, on: str = "location_id") -> DataFrame:
    """Add the columns of the location table. The planner broadcasts it if its size allows."""
    return df.join(locations, on, "left")
