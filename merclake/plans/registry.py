"""The catalogue of runnable queries and the SQL each one must agree with.

The SQL is written over the given tables. The fragments below spell out the star schema of
``plans.star`` once, as common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(func: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return add


REF = "TIMESTAMP '2001-08-02 00:00:00'"


def total(x: str, scale: int = 2) -> str:
    """Exact sum in minor units."""
    return f"(CAST(sum(CAST(round(({x}) * {10**scale}) AS BIGINT)) AS DOUBLE) / {10**scale}.0)"


def mean(x: str, scale: int = 2) -> str:
    return f"({total(x, scale)} / count({x}))"


def _ranked(rel: str, col: str) -> str:
    return (
        f"(SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY {col}) - 1 AS rn, count(*) OVER () AS n "
        f"FROM {rel} WHERE {col} IS NOT NULL)"
    )


def nearest(rel: str, col: str, p: float) -> str:
    """Quantile at rank floor(p*(n-1)+0.5)."""
    return f"(SELECT max(v) FROM {_ranked(rel, col)} WHERE rn = floor(CAST({p} AS DOUBLE) * (n - 1) + 0.5))"


def linear(rel: str, col: str, p: float) -> str:
    """Quantile interpolated between its two neighbours."""
    pos = f"(CAST({p} AS DOUBLE) * (n - 1))"
    lo = f"max(CASE WHEN rn = floor({pos}) THEN v END)"
    hi = f"max(CASE WHEN rn = least(floor({pos}) + 1, n - 1) THEN v END)"
    return f"(SELECT {lo} + ({hi} - {lo}) * (max({pos}) - floor(max({pos}))) FROM {_ranked(rel, col)})"


FO = """fo AS (SELECT o_orderkey AS order_id, 'ORD-' || o_orderkey AS order_number, o_custkey AS customer_id,
 o_orderdate AS order_timestamp, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
 CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
 o_totalprice AS total_amount, o_orderpriority AS payment_method FROM orders)"""
FI = """fi AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
 l_extendedprice / l_quantity AS unit_price, l_extendedprice * (1 - l_discount) AS line_total,
 l_returnflag = 'R' AS is_returned FROM lineitem)"""
FIO = """fio AS (SELECT fi.*, fo.customer_id, fo.order_timestamp, fo.order_date_key FROM fi JOIN fo USING (order_id))"""
FW = f"""fl AS (SELECT l_orderkey AS order_id, CAST(sum(l_quantity) AS BIGINT) AS item_count,
 {total('l_extendedprice')} AS subtotal, {total('l_extendedprice * l_discount', 4)} AS discount_amount,
 max(l_discount) >= 0.05 AS has_promo_code FROM lineitem GROUP BY 1),
fw AS (SELECT fo.*, coalesce(item_count, 0) AS item_count, coalesce(subtotal, 0.0) AS subtotal,
 coalesce(discount_amount, 0.0) AS discount_amount, CAST(0 AS DOUBLE) AS shipping_amount,
 coalesce(has_promo_code, false) AS has_promo_code FROM fo LEFT JOIN fl USING (order_id))"""
DP = """dp AS (SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS name, p_brand AS brand,
 p_type AS category, p_retailprice AS unit_price, round_even(p_retailprice * 60, 0) / 100 AS cost_price,
 p_size AS stock_quantity, 10 AS reorder_level, p_size > 0 AS is_in_stock, true AS is_active,
 CAST(0 AS DOUBLE) AS avg_rating, DATE '1995-01-01' AS launch_date FROM part)"""
PV = """pv AS (SELECT event_id AS page_view_id, user_id AS visitor_id, user_id AS customer_id, ts AS event_timestamp,
 CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, event_type, value,
 CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS product_id FROM events)"""
SV = """pl AS (SELECT *, lag(event_timestamp) OVER (PARTITION BY visitor_id ORDER BY event_timestamp, page_view_id) AS b FROM pv),
po AS (SELECT * EXCLUDE (b), CASE WHEN b IS NULL OR event_timestamp - b > INTERVAL 30 MINUTE THEN event_timestamp END AS o FROM pl),
sw AS (SELECT * EXCLUDE (o), last_value(o IGNORE NULLS) OVER (PARTITION BY visitor_id ORDER BY event_timestamp, page_view_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start FROM po),
sv AS (SELECT *, visitor_id || '-' || epoch_us(session_start) AS session_id FROM sw)"""


def rfm_sql(quantile=nearest, src: str = "fo") -> str:
    cut = {c: [quantile("rb", c, p) for p in (0.2, 0.4, 0.6, 0.8)] for c in ("recency_days", "frequency", "monetary")}
    up = lambda c, s: f"CASE WHEN {c} >= {s}4 THEN 5 WHEN {c} >= {s}3 THEN 4 WHEN {c} >= {s}2 THEN 3 WHEN {c} >= {s}1 THEN 2 ELSE 1 END"
    down = "CASE WHEN recency_days <= r1 THEN 5 WHEN recency_days <= r2 THEN 4 WHEN recency_days <= r3 THEN 3 WHEN recency_days <= r4 THEN 2 ELSE 1 END"
    cols = ", ".join(f"{cut[c][i]} AS {s}{i + 1}" for c, s in (("recency_days", "r"), ("frequency", "f"), ("monetary", "m")) for i in range(4))
    return f"""rb AS (SELECT customer_id, date_sub('day', max(order_timestamp), {REF}) AS recency_days, count(*) AS frequency,
 {total('total_amount')} AS monetary FROM {src} GROUP BY 1),
rq AS (SELECT {cols}),
rs AS (SELECT customer_id, recency_days, frequency, monetary, {down} AS rfm_recency_score,
 {up('frequency', 'f')} AS rfm_frequency_score, {up('monetary', 'm')} AS rfm_monetary_score FROM rb, rq),
rfm AS (SELECT *, rfm_recency_score + rfm_frequency_score + rfm_monetary_score AS rfm_combined_score,
 CASE WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 12 THEN 'vip'
 WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 9 THEN 'loyal'
 WHEN rfm_recency_score + rfm_frequency_score + rfm_monetary_score >= 6 THEN 'potential'
 WHEN rfm_recency_score <= 2 THEN 'at_risk' ELSE 'new' END AS customer_segment FROM rs)"""


RFM = rfm_sql()
CLV = f"""cb AS (SELECT customer_id, count(*) AS total_orders, {total('total_amount')} AS total_revenue,
 {mean('total_amount')} AS avg_order_value, min(order_timestamp) AS first_order_date, max(order_timestamp) AS last_order_date
 FROM fo GROUP BY 1),
cc AS (SELECT *, date_sub('day', first_order_date, last_order_date) AS customer_lifespan_days,
 date_sub('day', first_order_date, {REF}) AS days_since_first_order FROM cb),
cd AS (SELECT *, CASE WHEN customer_lifespan_days > 0 THEN total_orders / (customer_lifespan_days / CAST(365 AS DOUBLE))
 ELSE CAST(total_orders AS DOUBLE) END AS purchase_frequency_yearly FROM cc),
clv AS (SELECT *, avg_order_value * purchase_frequency_yearly AS projected_annual_value, total_revenue AS lifetime_value FROM cd)"""
DC = """dc AS (SELECT c_custkey AS customer_id, c_name AS customer_key, c_nationkey AS location_id, c_mktsegment AS market_segment,
 true AS is_current, n_name AS country, r_name AS region, rfm_recency_score, rfm_frequency_score, rfm_monetary_score,
 rfm_combined_score, customer_segment AS segment, total_orders, total_revenue, avg_order_value, lifetime_value,
 purchase_frequency_yearly, first_order_date, last_order_date, strftime(first_order_date, '%Y-%m') AS acquisition_cohort
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 LEFT JOIN rfm ON rfm.customer_id = c_custkey LEFT JOIN clv ON clv.customer_id = c_custkey)"""
DIM_CUSTOMERS = ", ".join([FO, RFM, CLV, DC])
CF = f"""ft AS (SELECT *, dense_rank() OVER (PARTITION BY customer_id ORDER BY order_timestamp) AS seq FROM fw),
fb AS (SELECT customer_id, date_sub('day', max(order_timestamp), {REF}) AS recency_days, count(*) AS order_count,
 {total('total_amount')} AS total_spend, {mean('total_amount')} AS avg_order_value, max(total_amount) AS max_order_value,
 min(total_amount) AS min_order_value, stddev_samp(total_amount) AS std_order_value, min(order_timestamp) AS first_order_date,
 max(order_timestamp) AS last_order_date, CAST(sum(item_count) AS BIGINT) AS total_items,
 CAST(sum(item_count) AS DOUBLE) / count(item_count) AS avg_items_per_order,
 CAST(count(*) FILTER (WHERE has_promo_code) AS BIGINT) AS promo_order_count, bool_or(seq = 1) AS is_new_customer FROM ft GROUP BY 1),
fc AS (SELECT *, date_sub('day', first_order_date, {REF}) AS tenure_days,
 date_sub('day', first_order_date, last_order_date) AS lifespan_days FROM fb),
cf AS (SELECT *, CAST(promo_order_count AS DOUBLE) / order_count AS promo_usage_rate,
 CASE WHEN lifespan_days > 0 THEN order_count / (lifespan_days / CAST(30 AS DOUBLE)) ELSE CAST(order_count AS DOUBLE) END AS orders_per_month,
 CASE WHEN order_count > 1 THEN CAST(lifespan_days AS DOUBLE) / (order_count - 1) END AS avg_days_between_orders FROM fc)"""


def churn_sql(src: str = "cf", name: str = "ch") -> str:
    return f"""{name}q AS (SELECT {nearest(src, 'orders_per_month', 0.9)} AS q1, {nearest(src, 'total_spend', 0.9)} AS q2),
{name}a AS (SELECT {src}.*, recency_days > 90 AS is_inactive,
 least(greatest(recency_days / CAST(90 AS DOUBLE), 0.0), 2.0) AS recency_risk_score,
 1 - least(greatest(orders_per_month / q1, 0.0), 1.0) AS frequency_risk_score,
 1 - least(greatest(total_spend / q2, 0.0), 1.0) AS monetary_risk_score FROM {src}, {name}q),
{name}b AS (SELECT *, recency_risk_score * CAST(0.5 AS DOUBLE) + frequency_risk_score * CAST(0.3 AS DOUBLE)
 + monetary_risk_score * CAST(0.2 AS DOUBLE) AS churn_risk_score FROM {name}a),
{name} AS (SELECT *, churn_risk_score > CAST(0.7 AS DOUBLE) AS is_churned FROM {name}b)"""


CHURN = churn_sql()


def clv_features_sql(src: str = "cf", name: str = "cv") -> str:
    return f"""{name}q AS (SELECT {nearest(src, 'total_spend', 0.25)} AS q1, {nearest(src, 'total_spend', 0.5)} AS q2,
 {nearest(src, 'total_spend', 0.75)} AS q3),
{name} AS (SELECT {src}.*, total_spend AS historical_clv, avg_order_value * orders_per_month * 12 AS projected_clv,
 CASE WHEN tenure_days > 0 THEN total_spend / tenure_days ELSE 0.0 END AS revenue_per_day,
 CASE WHEN total_spend >= q3 THEN 4 WHEN total_spend >= q2 THEN 3 WHEN total_spend >= q1 THEN 2 ELSE 1 END AS clv_quartile
 FROM {src}, {name}q)"""


CLVF = clv_features_sql()


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
