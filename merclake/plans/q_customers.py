"""Customer value, features and training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from merclake.operators import datasets, enrichment as en, features as ft
from merclake.plans import star
from merclake.plans.registry import (
    CF, CHURN, CLV, CLVF, DIM_CUSTOMERS, DP, FI, FIO, FO, FW, PV, RFM, SV, churn_sql, clv_features_sql, linear, query,
    rfm_sql, total, with_,
)
from merclake.session import materialize, shared_dir

REF = star.REFERENCE_DATE


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Round figures whose last bits depend on the order of floating-point sums."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _customer_rows(spark, d) -> DataFrame:
    """Customer features computed once: the risk scores read them for their quantiles and
    again for their rows."""
    return materialize(ft.customer_features(star.orders_for_features(spark, d), REF))


@query("rfm_scores", with_(FO, RFM) + "SELECT * FROM rfm")
def rfm_scores(spark, d):
    return en.rfm_scores(star.fact_orders(spark, d), REF)


@query("rfm_scores_linear", with_(FO, rfm_sql(linear)) + "SELECT * FROM rfm")
def rfm_scores_linear(spark, d):
    return en.rfm_scores(star.fact_orders(spark, d), REF, interpolation="linear")


@query("customer_lifetime_value", with_(FO, CLV) + "SELECT * FROM clv")
def customer_lifetime_value(spark, d):
    return en.customer_lifetime_value(star.fact_orders(spark, d), REF)


@query("enrich_customers", with_(DIM_CUSTOMERS) + "SELECT * FROM dc")
def enrich_customers(spark, d):
    return star.dim_customers(spark, d)


def _cohorts(granularity: str, label: str) -> None:
    sql = with_(FO, CLV) + f"SELECT {label} AS acquisition_cohort, count(*) AS customers FROM clv GROUP BY 1"

    @query(f"cohorts_{granularity}", sql)
    def cohorts(spark, d):
        value = en.customer_lifetime_value(star.fact_orders(spark, d), REF)
        return en.add_cohorts(value, granularity=granularity).groupBy("acquisition_cohort").agg(
            F.count(F.lit(1)).alias("customers")
        )


_cohorts("month", "strftime(first_order_date, '%Y-%m')")
_cohorts("quarter", "year(first_order_date) || '-Q' || quarter(first_order_date)")
_cohorts("week", "strftime(first_order_date, '%Y-W%W')")


@query(
    "order_time_features",
    with_(FO, """q AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY customer_id ORDER BY order_timestamp) AS INTEGER) AS customer_order_sequence FROM fo)""")
    + """SELECT *, CAST(isodow(order_timestamp) AS INTEGER) AS order_day_of_week, CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
 CAST(month(order_timestamp) AS INTEGER) AS order_month, CAST(quarter(order_timestamp) AS INTEGER) AS order_quarter,
 isodow(order_timestamp) >= 6 AS is_weekend_order, customer_order_sequence = 1 AS is_first_order FROM q""",
)
def order_time_features(spark, d):
    return en.order_time_features(star.fact_orders(spark, d))


@query(
    "days_since_previous_order",
    with_(FO) + """SELECT order_id, customer_id, date_sub('day', lag(order_timestamp) OVER (PARTITION BY customer_id
 ORDER BY order_timestamp, order_id), order_timestamp) AS days_since_previous_order FROM fo""",
)
def days_since_previous_order(spark, d):
    out = en.days_since_previous_order(star.fact_orders(spark, d))
    return out.select("order_id", "customer_id", "days_since_previous_order")


@query(
    "session_metrics",
    with_(PV, SV, "m AS (SELECT session_id, count(*) AS pages_per_session, min(event_timestamp) AS a, max(event_timestamp) AS b FROM sv GROUP BY 1)")
    + """SELECT page_view_id, session_id, pages_per_session, a AS session_start, b AS session_end,
 (epoch_us(b) - epoch_us(a)) / CAST(1000000 AS DOUBLE) AS session_duration_seconds FROM sv JOIN m USING (session_id)""",
)
def session_metrics(spark, d):
    views = star.session_views(spark, d).drop("session_start")
    return en.session_metrics(views).select(
        "page_view_id", "session_id", "pages_per_session", "session_start", "session_end", "session_duration_seconds"
    )


@query("customer_features", with_(FO, FW, CF) + "SELECT * REPLACE (round(std_order_value, 4) AS std_order_value) FROM cf")
def customer_features(spark, d):
    return rounded(ft.customer_features(star.orders_for_features(spark, d), REF), ["std_order_value"], 4)


@query(
    "churn_features",
    with_(FO, FW, CF, CHURN) + """SELECT * REPLACE (round(std_order_value, 4) AS std_order_value,
 round(churn_risk_score, 9) AS churn_risk_score) FROM ch""",
)
def churn_features(spark, d):
    out = ft.churn_features(_customer_rows(spark, d))
    return rounded(rounded(out, ["std_order_value"], 4), ["churn_risk_score"], 9)


@query(
    "churn_outlook",
    with_(FO, FW, CF, CHURN) + """SELECT customer_id, round(least(churn_risk_score, 1.0), 9) AS churn_probability,
 CAST(CAST(last_order_date AS DATE) + CAST(round_even(avg_days_between_orders, 0) AS INTEGER) AS DATE) AS predicted_next_purchase_date FROM ch""",
)
def churn_outlook(spark, d):
    out = ft.churn_outlook(ft.churn_features(_customer_rows(spark, d)))
    return rounded(out.select("customer_id", "churn_probability", "predicted_next_purchase_date"), ["churn_probability"], 9)


@query("clv_features", with_(FO, FW, CF, CLVF) + "SELECT * REPLACE (round(std_order_value, 4) AS std_order_value) FROM cv")
def clv_features(spark, d):
    return rounded(ft.clv_features(_customer_rows(spark, d)), ["std_order_value"], 4)


_FILLED = """coalesce(round(std_order_value, 4), 0.0) AS std_order_value,
 coalesce(avg_days_between_orders, 0.0) AS avg_days_between_orders"""


@query(
    "ml_dataset_churn",
    with_(FO, FW, CF, CHURN) + f"""SELECT * EXCLUDE (first_order_date, last_order_date) REPLACE ({_FILLED},
 round(churn_risk_score, 9) AS churn_risk_score) FROM ch""",
)
def ml_dataset_churn(spark, d):
    out = ft.ml_dataset(star.orders_for_features(spark, d), REF, "churn")
    return rounded(rounded(out, ["std_order_value"], 4), ["churn_risk_score"], 9)


@query(
    "ml_dataset_clv",
    with_(FO, FW, CF, CLVF) + f"SELECT * EXCLUDE (first_order_date, last_order_date) REPLACE ({_FILLED}) FROM cv",
)
def ml_dataset_clv(spark, d):
    return rounded(ft.ml_dataset(star.orders_for_features(spark, d), REF, "clv"), ["std_order_value"], 4)


@query(
    "ml_dataset_next_purchase",
    with_(FO, FW, CF) + f"SELECT * EXCLUDE (first_order_date, last_order_date) REPLACE ({_FILLED}) FROM cf",
)
def ml_dataset_next_purchase(spark, d):
    return rounded(ft.ml_dataset(star.orders_for_features(spark, d), REF, "next_purchase"), ["std_order_value"], 4)


@query(
    "product_features",
    with_(FI, DP, f"""s AS (SELECT product_id, sum(quantity) AS u, {total('line_total', 4)} AS rv, count(DISTINCT order_id) AS n,
 avg(quantity) AS q, avg(unit_price) AS p, stddev_samp(unit_price) AS v FROM fi GROUP BY 1)""")
    + """SELECT product_id, coalesce(u, 0) AS total_units_sold, coalesce(rv, 0) AS total_revenue, coalesce(n, 0) AS orders_count,
 q AS avg_quantity_per_order, round(p, 6) AS avg_selling_price, round(v, 4) AS price_variance,
 CAST(date_diff('day', launch_date, DATE '2001-08-02') AS INTEGER) AS days_since_launch,
 CASE WHEN u > 0 THEN stock_quantity / (u / CAST(30 AS DOUBLE)) ELSE 999.0 END AS days_of_supply FROM dp LEFT JOIN s USING (product_id)""",
)
def product_features(spark, d):
    out = ft.product_features(star.fact_order_items(spark, d), star.dim_products(spark, d), REF)
    out = rounded(rounded(out, ["avg_selling_price"]), ["price_variance"], 4)
    return out.select(
        "product_id", "total_units_sold", "total_revenue", "orders_count", "avg_quantity_per_order", "avg_selling_price",
        "price_variance", "days_since_launch", "days_of_supply",
    )


@query(
    "customer_behaviour",
    with_(FO, FI, FIO, DP, """k AS (SELECT customer_id, category, count(*) AS lines, count(DISTINCT product_id) AS products,
 count(*) FILTER (WHERE is_returned) AS returned FROM fio JOIN dp USING (product_id) GROUP BY 1, 2),
b AS (SELECT customer_id, CAST(sum(products) AS BIGINT) AS unique_products_purchased, count(*) AS unique_categories_purchased,
 arg_min(category, (-lines, category)) AS favorite_category, sum(returned) > 0 AS has_returned_items,
 CAST(sum(returned) AS DOUBLE) / CAST(sum(lines) AS DOUBLE) AS return_rate FROM k GROUP BY 1),
h AS (SELECT customer_id, isodow(order_timestamp) AS w, count(*) AS n FROM fo GROUP BY 1, 2),
p AS (SELECT customer_id, CAST(arg_min(w, (-n, w)) AS INTEGER) AS preferred_day_of_week FROM h GROUP BY 1),
r AS (SELECT customer_id, hour(order_timestamp) AS w, count(*) AS n FROM fo GROUP BY 1, 2),
s AS (SELECT customer_id, CAST(arg_min(w, (-n, w)) AS INTEGER) AS preferred_hour FROM r GROUP BY 1),
t AS (SELECT customer_id, count(*) FILTER (WHERE isodow(order_timestamp) >= 6) * 2 >= count(*) AS is_weekend_shopper FROM fo GROUP BY 1)""")
    + "SELECT * FROM p JOIN s USING (customer_id) JOIN t USING (customer_id) LEFT JOIN b USING (customer_id)",
)
def customer_behaviour(spark, d):
    return ft.behaviour_features(star.items_with_orders(spark, d), star.dim_products(spark, d), star.fact_orders(spark, d))


@query(
    "product_behaviour",
    with_(FO, FI, FIO, DP, PV, """s AS (SELECT product_id, count(DISTINCT customer_id) AS c,
 CAST(count(*) FILTER (WHERE is_returned) AS DOUBLE) / count(*) AS r,
 coalesce(sum(quantity) FILTER (WHERE order_timestamp >= TIMESTAMP '2001-08-02' - INTERVAL 7 DAY AND order_timestamp < TIMESTAMP '2001-08-02'), 0) / CAST(7 AS DOUBLE) AS v7,
 coalesce(sum(quantity) FILTER (WHERE order_timestamp >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY AND order_timestamp < TIMESTAMP '2001-08-02'), 0) / CAST(30 AS DOUBLE) AS v30
 FROM fio GROUP BY 1),
e AS (SELECT product_id, count(*) FILTER (WHERE event_type IN ('view', 'page_view', 'product_view')) AS views,
 count(*) FILTER (WHERE event_type IN ('click', 'add_to_cart')) AS adds,
 count(*) FILTER (WHERE event_type IN ('purchase', 'checkout_completed')) AS buys FROM pv WHERE product_id IS NOT NULL GROUP BY 1)""")
    + """SELECT product_id, stock_quantity <= 0 AS stockout, coalesce(c, 0) AS unique_customers, r AS return_rate,
 coalesce(v7, 0.0) AS sales_velocity_7d, coalesce(v30, 0.0) AS sales_velocity_30d, coalesce(views, 0) AS views,
 coalesce(adds, 0) AS cart_additions, coalesce(buys, 0) AS purchases,
 CAST(buys AS DOUBLE) / nullif(views, 0) AS conversion_rate,
 CASE WHEN adds > 0 THEN greatest(CAST(0 AS DOUBLE), 1 - CAST(buys AS DOUBLE) / adds) END AS cart_abandonment_rate
 FROM dp LEFT JOIN s USING (product_id) LEFT JOIN e USING (product_id)""",
)
def product_behaviour(spark, d):
    return ft.product_behaviour(
        star.items_with_orders(spark, d), star.dim_products(spark, d), star.page_views(spark, d), REF
    )


@query(
    "stockout_frequency",
    """WITH l AS (SELECT l_partkey AS product_id, l_shipdate AS shipped, l_orderkey * 8 + l_linenumber AS id, CAST(l_quantity AS BIGINT) % 7 - 2 AS stock FROM lineitem),
p AS (SELECT *, lag(stock) OVER (PARTITION BY product_id ORDER BY shipped, id) AS before FROM l)
SELECT product_id, count(*) FILTER (WHERE stock <= 0 AND coalesce(before, 1) > 0) AS stockout_frequency FROM p GROUP BY 1""",
)
def stockout_frequency(spark, d):
    """Stand-in for stock levels: one snapshot per line, with a stock that follows from its quantity."""
    levels = star.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("snapshot_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("snapshot_id"),
        (F.col("l_quantity").cast("bigint") % 7 - 2).alias("stock_quantity"),
    )
    return ft.stockout_frequency(levels)


@query(
    "demand_features",
    with_(FO, FI, FIO, """y AS (SELECT product_id, CAST(order_timestamp AS DATE) AS day, sum(quantity) AS units FROM fio GROUP BY 1, 2),
z AS (SELECT product_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM y GROUP BY 1),
f AS (SELECT z.product_id, z.day, coalesce(units, 0.0) AS units, y.day IS NOT NULL AS sold FROM z LEFT JOIN y ON y.product_id = z.product_id AND y.day = z.day),
g AS (SELECT sold, product_id, day, units, lag(units, 1) OVER w AS units_lag_1, lag(units, 7) OVER w AS units_lag_7,
 round(avg(units) OVER (PARTITION BY product_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS units_mean_7,
 round(avg(units) OVER (PARTITION BY product_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 9) AS units_mean_30
 FROM f WINDOW w AS (PARTITION BY product_id ORDER BY day))""")
    + "SELECT * EXCLUDE (sold) FROM g WHERE sold",
)
def demand_features(spark, d):
    return rounded(ft.demand_features(star.items_with_orders(spark, d)), ["units_mean_7", "units_mean_30"], 9)


def _split_features(spark, d) -> DataFrame:
    out = ft.churn_features(_customer_rows(spark, d))
    return out.select("customer_id", F.col("is_churned").cast("int").alias("y"), "total_spend")


@query(
    "stratified_split_sizes",
    with_(FO, FW, CF, CHURN, "n AS (SELECT CAST(is_churned AS INTEGER) AS y, count(*) AS n FROM ch GROUP BY 1)")
    + """SELECT y, 'val' AS split, CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS samples FROM n
 UNION ALL SELECT y, 'train', CAST(n - ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) FROM n""",
)
def stratified_split_sizes(spark, d):
    split = datasets.train_val_split(_split_features(spark, d), "customer_id", 0.2, 42, "y")
    return split.groupBy("y", "split").agg(F.count(F.lit(1)).alias("samples"))


@query(
    "split_covers_customers",
    with_(FO, "u AS (SELECT DISTINCT customer_id FROM fo)")
    + """SELECT customer_id, CASE WHEN row_number() OVER (ORDER BY substr(md5('7-' || customer_id), 1, 13))
 <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM u""",
)
def split_covers_customers(spark, d):
    people = star.fact_orders(spark, d).select("customer_id").distinct()
    return datasets.train_val_split(people, "customer_id", 0.2, 7)


_TRAIN, _TEST = ("1995-01-01", "1999-12-31"), ("2000-01-01", "2001-08-01")


def _period(name: str, days: tuple[str, str]) -> str:
    """customer features and churn over the orders of a period."""
    cte = CF.replace("FROM fw)", f"FROM {name}w)").replace("FROM ft ", f"FROM {name}t ").replace("ft AS", f"{name}t AS")
    for old in ("fb", "fc", "cf"):
        cte = cte.replace(f"{old} AS (", f"{name}{old} AS (").replace(f"FROM {old})", f"FROM {name}{old})")
    return (
        f"{name}w AS (SELECT * FROM oo WHERE order_timestamp >= TIMESTAMP '{days[0]}' AND order_timestamp < TIMESTAMP '{days[1]}' + INTERVAL 1 DAY),\n"
        + cte.replace("dense_rank() OVER (PARTITION BY customer_id ORDER BY order_timestamp) AS seq", "1 AS dummy")
    )


_ALL = "oo AS (SELECT *, dense_rank() OVER (PARTITION BY customer_id ORDER BY order_timestamp) AS seq FROM fw)"
_ANY = "bool_or(seq = 1)"


def _split(by: str = "0", seed: int = 42) -> str:
    """The split column in SQL: the smallest fifth by MD5 of seed and id is for validation."""
    return f"""CASE WHEN row_number() OVER (PARTITION BY {by} ORDER BY substr(md5('{seed}-' || customer_id), 1, 13))
 <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY {by})) THEN 'val' ELSE 'train' END"""


@query(
    "churn_dataset",
    with_(FO, FW, _ALL, _period("tr", _TRAIN), churn_sql("trcf", "tc"), _period("te", _TEST), churn_sql("tecf", "ec"))
    + f"""SELECT customer_id, CAST(is_churned AS INTEGER) AS y, {_split('is_churned')} AS split, recency_days, order_count, total_spend,
 orders_per_month, round(churn_risk_score, 9) AS churn_risk_score FROM tc
 UNION ALL SELECT customer_id, CAST(is_churned AS INTEGER), 'test', recency_days, order_count, total_spend, orders_per_month,
 round(churn_risk_score, 9) FROM ec""",
)
def churn_dataset(spark, d):
    out = datasets.churn_dataset(star.orders_for_features(spark, d), REF, _TRAIN, _TEST)
    return out.select(
        "customer_id", "y", "split", "recency_days", "order_count", "total_spend",
        "orders_per_month", F.round("churn_risk_score", 9).alias("churn_risk_score"),
    )


@query(
    "churn_dataset_metadata",
    with_(FO, FW, _ALL, _period("tr", _TRAIN), churn_sql("trcf", "tc"), _period("te", _TEST), churn_sql("tecf", "ec"),
          "n AS (SELECT is_churned, count(*) AS n FROM tc GROUP BY 1)")
    + """SELECT 'churn' AS target, CAST(sum(n - ceil(CAST(0.2 AS DOUBLE) * n)) AS BIGINT) AS train_samples,
 CAST(sum(ceil(CAST(0.2 AS DOUBLE) * n)) AS BIGINT) AS val_samples, (SELECT count(*) FROM ec) AS test_samples,
 round(sum(n - ceil(CAST(0.2 AS DOUBLE) * n)) FILTER (WHERE is_churned) / sum(n - ceil(CAST(0.2 AS DOUBLE) * n)), 9) AS target_mean FROM n""",
)
def churn_dataset_metadata(spark, d):
    out = datasets.churn_dataset(star.orders_for_features(spark, d), REF, _TRAIN, _TEST)
    return rounded(datasets.dataset_metadata(out, "churn").drop("target_std"), ["target_mean"], 9)


@query(
    "clv_dataset",
    with_(FO, FW, _ALL, _period("tr", _TRAIN), clv_features_sql("trcf", "tv"))
    + f"""SELECT customer_id, coalesce(projected_clv, 0.0) AS y, {_split()} AS split, recency_days, order_count, total_spend,
 revenue_per_day FROM tv""",
)
def clv_dataset(spark, d):
    out = datasets.clv_dataset(star.orders_for_features(spark, d), REF, _TRAIN)
    return out.select("customer_id", "y", "split", "recency_days", "order_count", "total_spend", "revenue_per_day")


@query(
    "clv_dataset_metadata",
    with_(FO, FW, _ALL, _period("tr", _TRAIN), clv_features_sql("trcf", "tv"))
    + """SELECT 'clv' AS target, CAST(count(*) - ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS train_samples,
 CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS val_samples, CAST(0 AS BIGINT) AS test_samples,
 round(avg(coalesce(projected_clv, 0.0)), 3) AS target_mean, round(stddev_pop(coalesce(projected_clv, 0.0)), 3) AS target_std FROM tv""",
)
def clv_dataset_metadata(spark, d):
    out = datasets.clv_dataset(star.orders_for_features(spark, d), REF, _TRAIN)
    return rounded(datasets.dataset_metadata(out, "clv"), ["target_mean", "target_std"], 3)


_PAIRS = with_(FO, FI, FIO, "x AS (SELECT customer_id, product_id, sum(quantity) AS value FROM fio GROUP BY 1, 2)")


@query("recommendation_interactions", _PAIRS + "SELECT customer_id, product_id, value FROM x")
def recommendation_interactions(spark, d):
    """The index triples mapped back to their ids."""
    parts = datasets.recommendation_dataset(star.items_with_orders(spark, d), star.dim_products(spark, d))
    named = parts["interactions"].join(parts["users"], "user_idx").join(parts["items"], "item_idx")
    return named.select("customer_id", "product_id", "value")


@query(
    "recommendation_index",
    _PAIRS + """SELECT 'user' AS side, count(DISTINCT customer_id) AS n, CAST(0 AS BIGINT) AS first_idx, count(DISTINCT customer_id) - 1 AS last_idx,
 count(DISTINCT customer_id) AS distinct_idx FROM x UNION ALL SELECT 'item', count(DISTINCT product_id), 0,
 count(DISTINCT product_id) - 1, count(DISTINCT product_id) FROM x""",
)
def recommendation_index(spark, d):
    parts = datasets.recommendation_dataset(star.items_with_orders(spark, d), star.dim_products(spark, d))
    shape = lambda df, side, idx: df.agg(
        F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"), F.min(idx).alias("first_idx"),
        F.max(idx).alias("last_idx"), F.count_distinct(idx).alias("distinct_idx"),
    )
    return shape(parts["users"], "user", "user_idx").unionByName(shape(parts["items"], "item", "item_idx"))


@query(
    "recommendation_metadata",
    _PAIRS + """SELECT count(*) AS n_interactions, count(DISTINCT customer_id) AS n_users, count(DISTINCT product_id) AS n_items,
 1 - CAST(count(*) AS DOUBLE) / (CAST(count(DISTINCT customer_id) AS DOUBLE) * count(DISTINCT product_id)) AS sparsity FROM x""",
)
def recommendation_metadata(spark, d):
    return datasets.recommendation_dataset(star.items_with_orders(spark, d), star.dim_products(spark, d))["metadata"]


@query(
    "dataset_round_trip",
    with_(FO, FW, _ALL, _period("tr", _TRAIN), clv_features_sql("trcf", "tv"))
    + "SELECT customer_id, coalesce(projected_clv, 0.0) AS y, total_spend FROM tv",
)
def dataset_round_trip(spark, d):
    """The value dataset written to the shared folder and read back."""
    rows = datasets.clv_dataset(star.orders_for_features(spark, d), REF, _TRAIN)
    path = datasets.save_dataset(rows, shared_dir(spark, "clv-dataset"), {"target": "clv"})
    back, metadata = datasets.load_dataset(spark, path)
    assert "total_spend" in metadata["feature_names"]
    return back.select("customer_id", "y", "total_spend")
