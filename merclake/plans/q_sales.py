"""Sales, catalogue, lookup and aggregate queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from merclake.functions.columns import as_date
from merclake.operators import aggregates, lookups, sales
from merclake.operators.datasets import co_purchased_with, interactions, order_baskets
from merclake.operators.enrichment import product_sales_metrics, with_location
from merclake.operators.features import churn_features, churn_outlook, customer_features
from merclake.plans import star
from merclake.session import materialize, shared_dir
from merclake.plans.registry import (
    CF, CHURN, CLV, DC, DIM_CUSTOMERS, DP, FI, FIO, FO, FW, PV, RFM, SQL, SV, mean, query, total, with_,
)

FIRST = LAST = None  # open bounds: the reports cover all orders, whatever their dates


def days_of(df: DataFrame, time_col: str) -> tuple[date, date, date]:
    """The first day of the data, the day that begins its second half, and the last day."""
    found = df.agg(F.min(time_col), F.max(time_col)).first()
    first, last = (x.date() if x else as_date(star.REFERENCE_DATE) for x in found)
    return first, first + timedelta(days=((last - first).days + 1) // 2), last


@query(
    "sales_by_category",
    with_(FO, FI, DP, """cat AS (SELECT category, sum(CAST(round(line_total * 10000) AS BIGINT)) AS minor,
 count(DISTINCT order_id) AS orders FROM fo JOIN fi USING (order_id) JOIN dp USING (product_id) GROUP BY 1)""")
    + """SELECT category, CAST(minor AS DOUBLE) / 10000.0 AS revenue, orders,
 CAST(minor AS DOUBLE) * 100.0 / CAST(sum(minor) OVER () AS DOUBLE) AS percentage FROM cat""",
)
def sales_by_category(spark, d):
    return sales.sales_by_category(
        star.fact_orders(spark, d), star.fact_order_items(spark, d), star.dim_products(spark, d), FIRST, LAST
    )


_HALVES = """m AS (SELECT CAST(min(order_timestamp) AS DATE) AS lo, CAST(max(order_timestamp) AS DATE) AS hi FROM fo),
h AS (SELECT fo.*, order_timestamp >= lo + CAST((hi - lo + 1) // 2 AS INTEGER) AS now FROM fo, m)"""


@query(
    "sales_overview",
    with_(FO, _HALVES, f"""a AS (SELECT {total('CASE WHEN now THEN total_amount END')} AS r, count(*) FILTER (WHERE now) AS n,
 count(DISTINCT customer_id) FILTER (WHERE now) AS c, {total('CASE WHEN NOT now THEN total_amount END')} AS pr,
 count(*) FILTER (WHERE NOT now) AS pn FROM h)""")
    + """SELECT r AS total_revenue, n AS total_orders, r / n AS avg_order_value, c AS total_customers,
 (r - pr) / pr * 100 AS revenue_growth, CAST(n - pn AS DOUBLE) / pn * 100 AS orders_growth FROM a""",
)
def sales_overview(spark, d):
    """The second half of the days against the first."""
    orders = star.fact_orders(spark, d)
    _, half, last = days_of(orders, "order_timestamp")
    return sales.sales_overview(orders, half, last)


@query(
    "sales_overview_conversion",
    with_(PV, SV, f"""a AS (SELECT {total("CASE WHEN event_type = 'purchase' THEN value END")} AS r,
 count(*) FILTER (WHERE event_type = 'purchase') AS n, count(DISTINCT customer_id) FILTER (WHERE event_type = 'purchase') AS c,
 count(DISTINCT session_id) AS s FROM sv)""")
    + """SELECT r AS total_revenue, n AS total_orders, r / n AS avg_order_value, c AS total_customers,
 CAST(NULL AS DOUBLE) AS revenue_growth, CAST(NULL AS DOUBLE) AS orders_growth, CAST(n AS DOUBLE) / s AS conversion_rate FROM a""",
)
def sales_overview_conversion(spark, d):
    views = star.page_views(spark, d)
    first, _, last = days_of(views, "event_timestamp")
    return sales.sales_overview(
        star.purchases(spark, d), first, last, compare_previous=False, page_views=star.session_views(spark, d)
    )


def _trend_sql(period: str) -> str:
    return with_(FO) + f"""SELECT CAST({period} AS DATE) AS period, {total('total_amount')} AS revenue, count(*) AS orders,
 count(DISTINCT customer_id) AS customers FROM fo GROUP BY 1"""


@query("sales_trend_daily", _trend_sql("order_timestamp"))
def sales_trend_daily(spark, d):
    return sales.sales_trend(star.fact_orders(spark, d), FIRST, LAST, "day")


@query("sales_trend_weekly", _trend_sql("date_trunc('week', order_timestamp)"))
def sales_trend_weekly(spark, d):
    return sales.sales_trend(star.fact_orders(spark, d), FIRST, LAST, "week")


@query("sales_trend_monthly", _trend_sql("date_trunc('month', order_timestamp)"))
def sales_trend_monthly(spark, d):
    return sales.sales_trend(star.fact_orders(spark, d), FIRST, LAST, "month")


@query("sales_trend_totals", with_(FO) + f"SELECT {total('total_amount')} AS total_revenue, count(*) AS total_orders FROM fo")
def sales_trend_totals(spark, d):
    return sales.sales_trend_totals(sales_trend_daily(spark, d))


@query(
    "hourly_distribution",
    f"""SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS orders, {total('value')} AS revenue FROM events
 WHERE event_type = 'purchase' GROUP BY 1""",
)
def hourly_distribution(spark, d):
    return sales.hourly_distribution(star.purchases(spark, d))


@query(
    "customer_cohorts",
    with_(DIM_CUSTOMERS) + f"""SELECT strftime(first_order_date, '%Y-%m') AS cohort, count(*) AS customers,
 {mean('lifetime_value')} AS avg_ltv, CAST(sum(total_orders) AS DOUBLE) / count(total_orders) AS avg_orders
 FROM dc WHERE first_order_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
)
def customer_cohorts(spark, d):
    return sales.customer_cohorts(star.customer_values(spark, d))


@query(
    "order_metrics",
    with_(FO, FW) + f"""SELECT count(*) AS total_orders, {total('total_amount')} AS total_revenue,
 {mean('total_amount')} AS avg_order_value, CAST(sum(item_count) AS BIGINT) AS total_items_sold,
 count(DISTINCT customer_id) AS unique_customers FROM fw""",
)
def order_metrics(spark, d):
    return sales.order_metrics(star.fact_orders_wide(spark, d))


@query(
    "sales_metrics",
    with_(FO) + f"""SELECT {total('total_amount')} AS total_revenue, count(*) AS total_orders,
 {mean('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS total_customers FROM fo""",
)
def sales_metrics(spark, d):
    return sales.sales_metrics(star.fact_orders(spark, d))


@query(
    "customer_metrics",
    with_(DIM_CUSTOMERS) + f"""SELECT count(*) AS total_customers, count(*) FILTER (WHERE segment = 'new') AS new_customers,
 count(*) FILTER (WHERE segment = 'vip') AS vip_customers, count(*) FILTER (WHERE segment = 'at_risk') AS at_risk_customers,
 {mean('lifetime_value')} AS avg_lifetime_value FROM dc""",
)
def customer_metrics(spark, d):
    return sales.customer_metrics(star.dim_customers(spark, d))


SEGMENTS = f"""sg AS (SELECT segment, count(*) AS count, coalesce({mean('lifetime_value')}, 0.0) AS avg_ltv FROM dc GROUP BY 1)"""


@query("segment_distribution", with_(DIM_CUSTOMERS, SEGMENTS) + "SELECT * FROM sg")
def segment_distribution(spark, d):
    return sales.segment_distribution(star.dim_customers(spark, d))


@query(
    "weighted_avg_ltv",
    with_(DIM_CUSTOMERS, SEGMENTS) + "SELECT round(sum(avg_ltv * count) / sum(count), 6) AS avg_lifetime_value FROM sg",
)
def weighted_avg_ltv(spark, d):
    out = sales.weighted_avg_ltv(segment_distribution(spark, d))
    return out.select(F.round("avg_lifetime_value", 6).alias("avg_lifetime_value"))


@query(
    "product_metrics",
    with_(DP) + f"""SELECT count(*) AS total_products, count(*) FILTER (WHERE is_active) AS active_products,
 count(*) FILTER (WHERE NOT is_in_stock) AS out_of_stock, {mean('unit_price')} AS avg_price,
 count(DISTINCT category) AS categories_count FROM dp""",
)
def product_metrics(spark, d):
    return sales.product_metrics(star.dim_products(spark, d))


@query("category_counts", with_(DP) + "SELECT category, count(*) AS count FROM dp GROUP BY 1")
def category_counts(spark, d):
    return sales.category_counts(star.dim_products(spark, d))


@query(
    "top_selling_products",
    with_(FO, FI, DP) + f"""SELECT product_id, name, category, sum(quantity) AS units_sold, {total('line_total', 4)} AS revenue
 FROM fi JOIN dp USING (product_id) JOIN fo USING (order_id) GROUP BY 1, 2, 3 ORDER BY revenue DESC, product_id LIMIT 100""",
)
def top_selling_products(spark, d):
    return sales.top_selling_products(
        star.fact_order_items(spark, d), star.dim_products(spark, d), star.fact_orders(spark, d), 100, FIRST, LAST
    )


@query(
    "weekday_averages",
    with_(FO, f"""dd AS (SELECT CAST(order_timestamp AS DATE) AS day, {total('total_amount')} AS revenue, count(*) AS orders
 FROM fo GROUP BY 1)""")
    + f"""SELECT CAST(isodow(day) - 1 AS INTEGER) AS day_of_week, {mean('revenue')} AS avg_revenue,
 CAST(sum(orders) AS DOUBLE) / count(orders) AS avg_orders FROM dd GROUP BY 1""",
)
def weekday_averages(spark, d):
    return sales.weekday_averages(star.fact_orders(spark, d))


@query(
    "payment_method_share",
    with_(FO) + f"""SELECT payment_method, count(*) AS orders, {total('total_amount')} AS revenue,
 count(*) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS percentage FROM fo GROUP BY 1""",
)
def payment_method_share(spark, d):
    return sales.payment_method_share(star.fact_orders(spark, d))


@query(
    "ltv_bucket_share",
    with_(DIM_CUSTOMERS) + """SELECT CASE WHEN lifetime_value < 100 THEN '0-100' WHEN lifetime_value < 500 THEN '100-500'
 WHEN lifetime_value < 1000 THEN '500-1000' ELSE '1000+' END AS bucket, count(*) AS customers,
 count(*) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS percentage FROM dc WHERE lifetime_value IS NOT NULL GROUP BY 1""",
)
def ltv_bucket_share(spark, d):
    return sales.ltv_bucket_share(star.customer_values(spark, d))


# --- lists and lookups -------------------------------------------------------------

@query("list_orders_page", with_(FO) + "SELECT * FROM fo WHERE status = 'delivered' AND total_amount >= 1000 ORDER BY order_timestamp DESC, order_id LIMIT 50 OFFSET 50")
def list_orders_page(spark, d):
    return lookups.list_orders(star.fact_orders(spark, d), 2, 50, status="delivered", min_amount=1000.0)


@query(
    "list_orders_info",
    with_(FO) + """SELECT count(*) AS total, 2 AS page, 50 AS page_size, CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages
 FROM fo WHERE status = 'delivered'""",
)
def list_orders_info(spark, d):
    return lookups.page_info(lookups.find_orders(star.fact_orders(spark, d), status="delivered"), 2, 50)


@query(
    "orders_page_after",
    with_(FO)
    + "SELECT fo.* FROM fo WHERE total_amount <= 250000 ORDER BY total_amount DESC, order_id LIMIT 50",
)
def orders_page_after(spark, d):
    return lookups.page_after(star.fact_orders(spark, d), "total_amount", "order_id", (250000.0, -1), 50)


_BIGGEST = "(SELECT arg_max(order_id, (total_amount, order_id)) FROM fo)"


def _biggest_order(spark, d):
    return star.fact_orders(spark, d).agg(F.max_by("order_id", F.struct("total_amount", "order_id"))).scalar()


@query("order_detail", with_(FO) + f"SELECT * FROM fo WHERE order_id = {_BIGGEST}")
def order_detail(spark, d):
    return lookups.detail(star.fact_orders(spark, d), "order_id", _biggest_order(spark, d))


@query(
    "order_line_items",
    with_(FO, FI) + f"SELECT order_id, product_id, quantity, line_total FROM fi WHERE order_id = {_BIGGEST}",
)
def order_line_items(spark, d):
    lines = lookups.detail(star.fact_order_items(spark, d), "order_id", _biggest_order(spark, d))
    return lines.select("order_id", "product_id", "quantity", "line_total")


@query(
    "customer_orders",
    with_(FO, "b AS (SELECT customer_id, count(*) AS n FROM fo GROUP BY 1)")
    + """SELECT * FROM fo WHERE customer_id = (SELECT arg_max(customer_id, (n, customer_id)) FROM b)
 ORDER BY order_timestamp DESC, order_id LIMIT 50""",
)
def customer_orders(spark, d):
    orders = star.fact_orders(spark, d)
    busiest = orders.groupBy("customer_id").count().agg(F.max_by("customer_id", F.struct("count", "customer_id"))).scalar()
    newest = [F.col("order_timestamp").desc_nulls_last(), F.col("order_id")]
    return lookups.page(lookups.detail(orders, "customer_id", busiest), newest, 1, 50)


_CUST = "customer_id, customer_key, country, segment, total_orders, lifetime_value"


@query(
    "list_customers",
    with_(DIM_CUSTOMERS) + f"""SELECT {_CUST} FROM dc WHERE segment = 'vip' AND lifetime_value >= 0
 ORDER BY lifetime_value DESC NULLS LAST, customer_id LIMIT 50""",
)
def list_customers(spark, d):
    return lookups.list_customers(star.dim_customers(spark, d), segment="vip", min_ltv=0.0).select(*_CUST.split(", "))


@query(
    "customer_detail",
    with_(DIM_CUSTOMERS, "b AS (SELECT customer_id AS c, count(*) AS n FROM fo GROUP BY 1)")
    + f"SELECT {_CUST} FROM dc WHERE customer_id = (SELECT arg_max(c, (n, c)) FROM b)",
)
def customer_detail(spark, d):
    orders = star.fact_orders(spark, d)
    busiest = orders.groupBy("customer_id").count().agg(F.max_by("customer_id", F.struct("count", "customer_id"))).scalar()
    return lookups.customer_detail(star.dim_customers(spark, d), busiest).select(*_CUST.split(", "))


@query(
    "top_spenders",
    with_(DIM_CUSTOMERS) + f"SELECT {_CUST} FROM dc ORDER BY lifetime_value DESC NULLS LAST, customer_id LIMIT 10",
)
def top_spenders(spark, d):
    return lookups.top_spenders(star.dim_customers(spark, d)).select(*_CUST.split(", "))


@query(
    "at_risk_customers",
    with_(FO, RFM, CLV, DC, FW, CF, CHURN) + f"""SELECT {', '.join('dc.' + c for c in _CUST.split(', '))},
 round(least(churn_risk_score, 1.0), 9) AS churn_probability FROM dc LEFT JOIN ch USING (customer_id) WHERE segment = 'at_risk'
 ORDER BY churn_risk_score >= 1.0 DESC, least(churn_risk_score, 1.0) DESC NULLS LAST, customer_id LIMIT 100""",
)
def at_risk_customers(spark, d):
    churn = churn_outlook(
        churn_features(materialize(customer_features(star.orders_for_features(spark, d), star.REFERENCE_DATE)))
    )
    people = star.dim_customers(spark, d).join(churn.select("customer_id", "churn_probability"), "customer_id", "left")
    out = lookups.at_risk_customers(people).select(*_CUST.split(", "), "churn_probability")
    return out.withColumn("churn_probability", F.round("churn_probability", 9))


@query("at_risk_from_stored_scores", SQL["at_risk_customers"])
def at_risk_from_stored_scores(spark, d):
    """The same from scores that were stored for the day: the list reads one segment of one day."""
    path = shared_dir(spark, "scores")
    churn = churn_outlook(
        churn_features(materialize(customer_features(star.orders_for_features(spark, d), star.REFERENCE_DATE)))
    )
    people = star.dim_customers(spark, d).join(churn.select("customer_id", "churn_probability"), "customer_id", "left")
    lookups.store_scores(people, path, star.REFERENCE_DATE)
    out = lookups.at_risk_customers(lookups.stored_scores(spark, path, star.REFERENCE_DATE)).select(*_CUST.split(", "), "churn_probability")
    return out.withColumn("churn_probability", F.round("churn_probability", 9))


_PROD = "product_id, sku, name, brand, category, unit_price, stock_quantity"


@query(
    "list_products",
    with_(DP) + f"""SELECT {_PROD} FROM dp WHERE is_active AND is_in_stock AND unit_price >= 0 AND unit_price <= 2000
 ORDER BY name, product_id LIMIT 50 OFFSET 50""",
)
def list_products(spark, d):
    return lookups.list_products(
        star.dim_products(spark, d), 2, 50, in_stock_only=True, min_price=0.0, max_price=2000.0
    ).select(*_PROD.split(", "))


@query("product_search", with_(DP) + f"SELECT {_PROD} FROM dp WHERE name ILIKE '%RING%'")
def product_search(spark, d):
    return lookups.find_products(star.dim_products(spark, d), search="RING").select(*_PROD.split(", "))


@query(
    "product_detail",
    with_(DP) + f"SELECT {_PROD} FROM dp WHERE product_id = (SELECT arg_max(product_id, (unit_price, product_id)) FROM dp)",
)
def product_detail(spark, d):
    products = star.dim_products(spark, d)
    dearest = products.agg(F.max_by("product_id", F.struct("unit_price", "product_id"))).scalar()
    return lookups.detail(products, "product_id", dearest).select(*_PROD.split(", "))


@query(
    "low_stock",
    with_(DP) + f"SELECT {_PROD} FROM dp WHERE stock_quantity <= 10 ORDER BY stock_quantity, product_id LIMIT 100",
)
def low_stock(spark, d):
    return lookups.low_stock(star.dim_products(spark, d)).select(*_PROD.split(", "))


@query(
    "orders_with_customer",
    with_(FO) + """SELECT order_id, total_amount, customer_id, c_name AS customer_key, n_name AS country, r_name AS region
 FROM fo LEFT JOIN customer ON c_custkey = customer_id LEFT JOIN nation ON n_nationkey = c_nationkey
 LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def orders_with_customer(spark, d):
    people = with_location(star.dim_customers_base(spark, d), star.dim_locations(spark, d))
    out = lookups.orders_with_customer(star.fact_orders(spark, d), people)
    return out.select("order_id", "total_amount", "customer_id", "customer_key", "country", "region")


@query(
    "customers_with_orders",
    "SELECT c_custkey AS customer_id, c_name AS customer_key FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
)
def customers_with_orders(spark, d):
    people = star.dim_customers_base(spark, d).select("customer_id", "customer_key")
    return lookups.having_members(people, "customer_id", star.fact_orders(spark, d), "customer_id")


@query(
    "latest_orders_per_customer",
    with_(FO) + """SELECT * FROM fo QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_timestamp DESC, order_id) <= 5""",
)
def latest_orders_per_customer(spark, d):
    newest = [F.col("order_timestamp").desc_nulls_last(), F.col("order_id")]
    return lookups.latest_per_parent(star.fact_orders(spark, d), "customer_id", newest, 5)


# --- aggregate tables --------------------------------------------------------------

@query(
    "daily_sales",
    with_(FO, FW) + f"""SELECT order_date_key AS date_key, count(*) AS total_orders, {total('total_amount')} AS total_revenue,
 CAST(sum(item_count) AS BIGINT) AS total_items_sold, {mean('total_amount')} AS avg_order_value,
 count(DISTINCT customer_id) AS unique_customers FROM fw GROUP BY 1""",
)
def daily_sales(spark, d):
    return aggregates.daily_sales(star.fact_orders_wide(spark, d))


@query(
    "daily_sales_full",
    with_(FO, FW, PV, SV, f"""a AS (SELECT order_date_key AS date_key, count(*) AS total_orders, {total('total_amount')} AS total_revenue,
 CAST(sum(item_count) AS BIGINT) AS total_items_sold, {mean('total_amount')} AS avg_order_value,
 count(DISTINCT customer_id) AS unique_customers, {total('discount_amount', 4)} AS total_discount,
 {total('shipping_amount')} AS total_shipping, CAST(sum(item_count) AS DOUBLE) / count(item_count) AS avg_items_per_order
 FROM fw GROUP BY 1),
f AS (SELECT customer_id, min(order_date_key) AS date_key FROM fw GROUP BY 1),
n AS (SELECT date_key, count(*) AS new_customers FROM f GROUP BY 1),
v AS (SELECT date_key, count(DISTINCT session_id) AS total_sessions, count(*) AS total_page_views FROM sv GROUP BY 1),
j AS (SELECT coalesce(a.date_key, v.date_key) AS date_key, a.* EXCLUDE (date_key), n.new_customers, v.total_sessions, v.total_page_views
 FROM a LEFT JOIN n ON a.date_key = n.date_key FULL OUTER JOIN v ON a.date_key = v.date_key)""")
    + """SELECT date_key, coalesce(total_orders, 0) AS total_orders, coalesce(total_revenue, 0.0) AS total_revenue,
 coalesce(total_items_sold, 0) AS total_items_sold, coalesce(avg_order_value, 0.0) AS avg_order_value,
 coalesce(unique_customers, 0) AS unique_customers, coalesce(total_discount, 0.0) AS total_discount,
 coalesce(total_shipping, 0.0) AS total_shipping, coalesce(avg_items_per_order, 0.0) AS avg_items_per_order,
 coalesce(new_customers, 0) AS new_customers, coalesce(total_sessions, 0) AS total_sessions,
 coalesce(total_page_views, 0) AS total_page_views, coalesce(unique_customers, 0) - coalesce(new_customers, 0) AS returning_customers,
 CASE WHEN coalesce(total_sessions, 0) = 0 THEN 0.0 ELSE CAST(coalesce(total_orders, 0) AS DOUBLE) / total_sessions END AS conversion_rate FROM j""",
)
def daily_sales_full(spark, d):
    return aggregates.daily_sales_full(star.fact_orders_wide(spark, d), star.session_views(spark, d))


@query(
    "product_performance",
    with_(FO, FI, FIO, PV, f"""s AS (SELECT product_id, order_date_key AS date_key, CAST(sum(quantity) AS BIGINT) AS units_sold,
 {total('line_total', 4)} AS revenue, count(DISTINCT order_id) AS orders_count FROM fio GROUP BY 1, 2),
v AS (SELECT product_id, date_key, count(*) AS page_views, count(*) FILTER (WHERE event_type IN ('click', 'add_to_cart')) AS add_to_cart_count
 FROM pv WHERE product_id IS NOT NULL GROUP BY 1, 2)""")
    + """SELECT coalesce(s.product_id, v.product_id) AS product_id, coalesce(s.date_key, v.date_key) AS date_key,
 coalesce(units_sold, 0) AS units_sold, coalesce(revenue, 0.0) AS revenue, coalesce(orders_count, 0) AS orders_count,
 coalesce(page_views, 0) AS page_views, coalesce(add_to_cart_count, 0) AS add_to_cart_count,
 CASE WHEN coalesce(page_views, 0) = 0 THEN 0.0 ELSE CAST(coalesce(orders_count, 0) AS DOUBLE) / page_views END AS conversion_rate
 FROM s FULL OUTER JOIN v ON s.product_id = v.product_id AND s.date_key = v.date_key""",
)
def product_performance(spark, d):
    return aggregates.product_performance(star.items_with_orders(spark, d), star.page_views(spark, d))


@query(
    "inventory_snapshot",
    with_(FO, FI, FIO, DP, """s AS (SELECT product_id, sum(quantity) AS recent,
 sum(quantity) FILTER (WHERE order_timestamp >= TIMESTAMP '2001-08-01') AS today FROM fio
 WHERE order_timestamp >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY AND order_timestamp < TIMESTAMP '2001-08-02' GROUP BY 1)""")
    + """SELECT product_id, 20010801 AS date_key, stock_quantity AS quantity_on_hand, 0 AS quantity_reserved,
 stock_quantity AS quantity_available, stock_quantity > 0 AS is_in_stock,
 CAST(floor(stock_quantity / (recent / CAST(30 AS DOUBLE))) AS BIGINT) AS days_of_supply,
 CAST(coalesce(today, 0) AS BIGINT) AS units_sold, round_even(stock_quantity * cost_price * 100, 0) / 100 AS inventory_value
 FROM dp LEFT JOIN s USING (product_id)""",
)
def inventory_snapshot(spark, d):
    return aggregates.inventory_snapshot(star.dim_products(spark, d), star.items_with_orders(spark, d), star.LAST_DAY)


@query(
    "campaign_metrics",
    f"""WITH e AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS i, count(*) FILTER (WHERE event_type = 'click') AS c,
 count(*) FILTER (WHERE event_type = 'purchase') AS p, {total("CASE WHEN event_type = 'click' THEN value END")} AS s FROM events GROUP BY 1),
k AS (SELECT c_mktsegment AS campaign_id, CAST(sum(i) AS BIGINT) AS impressions, CAST(sum(c) AS BIGINT) AS clicks,
 CAST(sum(p) AS BIGINT) AS conversions, coalesce({total('s')}, 0.0) AS spend FROM customer JOIN e ON user_id = c_custkey GROUP BY 1),
r AS (SELECT c_mktsegment AS campaign_id, {total('o_totalprice')} AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT campaign_id, impressions, clicks, conversions, spend, coalesce(revenue, 0.0) AS revenue,
 CAST(clicks AS DOUBLE) / nullif(impressions, 0) AS ctr, spend / nullif(clicks, 0) AS cpc, spend / nullif(conversions, 0) AS cpa,
 coalesce(revenue, 0.0) / nullif(spend, 0) AS roas FROM k LEFT JOIN r USING (campaign_id)""",
)
def campaign_metrics(spark, d):
    return aggregates.campaign_metrics(star.campaigns(spark, d), star.campaign_orders(spark, d))


@query(
    "product_sales_metrics",
    with_(FO, FI, FIO, DP, f"""r AS (SELECT greatest((epoch_us(max(order_timestamp)) - epoch_us(min(order_timestamp))) / 1e6 / CAST(86400 AS DOUBLE), 1.0) AS days FROM fio),
s AS (SELECT product_id, sum(quantity) AS u, {total('line_total', 4)} AS rv, count(*) AS n, avg(line_total / quantity) AS p FROM fio GROUP BY 1)""")
    + """SELECT product_id, coalesce(u, 0) AS total_units_sold, coalesce(rv, 0) AS total_product_revenue, coalesce(n, 0) AS order_count,
 round(p, 6) AS avg_selling_price, u / days AS sales_velocity_daily FROM dp LEFT JOIN s USING (product_id), r""",
)
def product_sales(spark, d):
    out = product_sales_metrics(star.dim_products(spark, d), star.items_with_orders(spark, d))
    return out.select(
        "product_id", "total_units_sold", "total_product_revenue", "order_count",
        F.round("avg_selling_price", 6).alias("avg_selling_price"), "sales_velocity_daily",
    )


@query(
    "interactions",
    with_(FO, FI, FIO) + f"""SELECT customer_id, product_id, sum(quantity) AS purchase_count, {total('line_total', 4)} AS total_spent
 FROM fio GROUP BY 1, 2""",
)
def customer_product_interactions(spark, d):
    return interactions(star.items_with_orders(spark, d))


@query("order_baskets", with_(FI) + "SELECT order_id, product_id, count(*) AS times FROM fi GROUP BY 1, 2")
def baskets(spark, d):
    return order_baskets(star.fact_order_items(spark, d))


@query(
    "co_purchased_with_best_seller",
    with_(FI, "p AS (SELECT DISTINCT order_id, product_id FROM fi)",
          "b AS (SELECT product_id, sum(quantity) AS q FROM fi GROUP BY 1)",
          "a AS (SELECT p.* FROM p WHERE product_id = (SELECT arg_max(product_id, (q, product_id)) FROM b))")
    + """SELECT a.product_id, p.product_id AS other_id, count(*) AS orders FROM a JOIN p USING (order_id)
 WHERE a.product_id <> p.product_id GROUP BY 1, 2""",
)
def co_purchased(spark, d):
    items = star.fact_order_items(spark, d)
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("q"))
    best = sold.agg(F.max_by("product_id", F.struct("q", "product_id"))).scalar()
    return co_purchased_with(items, [best])
