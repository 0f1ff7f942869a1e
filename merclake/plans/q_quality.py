"""Cleaning, data quality, anomaly and transformation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from merclake.operators import anomaly, cleaning as cl, enrichment as en, quality
from merclake.plans import etl, star
from merclake.plans.q_customers import rounded
from merclake.plans.registry import (
    CLV, FI, FIO, FO, FW, PV, RFM, SV, linear, nearest, query, total, with_,
)
from merclake.session import materialize

REF = star.REFERENCE_DATE

CO = """co AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'ORD-' || o_orderkey AS order_number, o_custkey AS customer_id,
 o_orderdate AS order_timestamp, lower(o_orderpriority) AS payment_method, o_totalprice AS total_amount, o_totalprice AS subtotal,
 CASE WHEN o_orderkey % 5 = 0 THEN 1.5 ELSE 0.0 END AS discount_amount FROM orders)"""
CO = CO.replace("THEN 1.5 ELSE 0.0 END", "THEN CAST(1.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END")


@query("clean_orders", with_(CO) + "SELECT * FROM co")
def clean_orders(spark, d):
    return cl.clean_orders(star.raw_orders(spark, d))


CC = """ck AS (SELECT c_custkey AS customer_id, c_name AS customer_key,
 CASE WHEN c_custkey % 10 <> 0 THEN 'user.' || c_custkey || '@example.com' END AS email, '15550' || c_custkey AS phone,
 'O''' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || '-Jane' AS first_name,
 upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS last_name, upper(n_name) AS country,
 CAST(CASE WHEN c_custkey % 3 > 0 THEN 4 ELSE 0 END AS BIGINT) AS total_orders, c_acctbal AS lifetime_value
 FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


@query("clean_customers", with_(CC) + "SELECT * FROM ck")
def clean_customers(spark, d):
    return cl.clean_customers(star.raw_customers(spark, d))


CP = """cp AS (SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS name, p_type AS category,
 p_retailprice AS unit_price, round_even(p_retailprice * 60, 0) / 100 AS cost_price,
 CASE WHEN p_partkey % 9 > 0 THEN p_size ELSE 0 END AS stock_quantity FROM part WHERE p_partkey % 50 <> 0)"""


@query("clean_products", with_(CP) + "SELECT * FROM cp")
def clean_products(spark, d):
    return cl.clean_products(star.raw_products(spark, d))


@query(
    "clean_generic",
    """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS order_id, 'ORD-' || o_orderkey AS order_number,
 lower(o_orderpriority) AS payment_method FROM orders""",
)
def clean_generic(spark, d):
    raw = star.raw_orders(spark, d).select("order_id", "order_number", "payment_method")
    return cl.clean_dataframe(raw, "generic")


@query(
    "standardize_dates",
    "SELECT o_orderkey AS id, o_orderdate AS placed FROM orders UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 7 = 0",
)
def standardize_dates(spark, d):
    raw = star.raw_orders(spark, d).select(F.col("order_id").cast("bigint").alias("id"), F.col("order_timestamp").alias("placed"))
    return cl.standardize_dates(raw, ["placed"])


@query(
    "cleaning_rules",
    """SELECT p_partkey AS product_id, upper(p_name) AS name, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS category,
 CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS unit_price FROM part""",
)
def cleaning_rules(spark, d):
    rules = cl.CleaningRules()
    rules.register("drop_cost", lambda df: df.select("product_id", "name", "category", "unit_price"))
    steps = [
        "drop_cost", "trim_strings", ("normalize_case", {"columns": ["name"], "case": "upper"}),
        ("normalize_case", {"columns": ["category"], "case": "title"}), ("normalize_currency", {"columns": ["unit_price"]}),
    ]
    return rules.apply(star.raw_products(spark, d), steps)


def _fences_sql(quantile) -> str:
    q1, q3 = quantile("fo", "total_amount", 0.25), quantile("fo", "total_amount", 0.75)
    return f"q AS (SELECT {q1} AS q1, {q3} AS q3), b AS (SELECT q1 - CAST(0.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(0.5 AS DOUBLE) * (q3 - q1) AS hi FROM q)"


_NARROW = 0.5  # totals are spread evenly, so wider fences would flag nothing


@query(
    "cleaning_stats",
    with_(FO, _fences_sql(nearest), "k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS n FROM orders)")
    + """SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n) FILTER (WHERE o_orderkey % 5 <> 0) AS BIGINT) AS nulls_filled,
 count(*) FILTER (WHERE n = 2) AS duplicates_removed,
 CAST(sum(n) + sum(n) FILTER (WHERE o_orderkey % 5 <> 0) AS BIGINT) AS format_corrections, count(*) AS rows_after_cleaning,
 (SELECT count(*) FROM fo, b WHERE total_amount < lo OR total_amount > hi) AS outliers_handled FROM k""",
)
def cleaning_stats(spark, d):
    raw = star.raw_orders(spark, d)
    cleaned = cl.detect_outliers(materialize(cl.clean_orders(raw)), "total_amount", "iqr", _NARROW)
    return cl.cleaning_stats(
        raw, cleaned, "order_number", {"discount_amount": 0.0}, ["total_amount"], ["order_timestamp"], "_is_outlier"
    )


@query(
    "outliers_iqr",
    with_(FO, _fences_sql(nearest)) + "SELECT order_id, total_amount, total_amount < lo OR total_amount > hi AS _is_outlier FROM fo, b",
)
def outliers_iqr(spark, d):
    return cl.detect_outliers(star.fact_orders(spark, d), "total_amount", "iqr", _NARROW).select(
        "order_id", "total_amount", "_is_outlier"
    )


@query(
    "outliers_zscore",
    with_(FO, "s AS (SELECT avg(total_amount) AS m, stddev_samp(total_amount) AS s FROM fo)")
    + "SELECT order_id, abs((total_amount - m) / s) > CAST(1.5 AS DOUBLE) AS _is_outlier FROM fo, s",
)
def outliers_zscore(spark, d):
    return cl.detect_outliers(star.fact_orders(spark, d), "total_amount", "zscore", 1.5).select("order_id", "_is_outlier")


@query(
    "outliers_clipped",
    with_(FO, _fences_sql(nearest)) + "SELECT order_id, least(greatest(total_amount, lo), hi) AS total_amount FROM fo, b",
)
def outliers_clipped(spark, d):
    return cl.handle_outliers(star.fact_orders(spark, d), "total_amount", "clip", threshold=_NARROW).select(
        "order_id", "total_amount"
    )


@query(
    "outliers_removed",
    with_(FO, _fences_sql(nearest)) + "SELECT order_id, total_amount FROM fo, b WHERE NOT (total_amount < lo OR total_amount > hi)",
)
def outliers_removed(spark, d):
    return cl.handle_outliers(star.fact_orders(spark, d), "total_amount", "remove", threshold=_NARROW).select(
        "order_id", "total_amount"
    )


@query(
    "outliers_replaced",
    with_(FO, _fences_sql(nearest), f"m AS (SELECT {linear('fo', 'total_amount', 0.5)} AS med)")
    + "SELECT order_id, CASE WHEN total_amount < lo OR total_amount > hi THEN med ELSE total_amount END AS total_amount FROM fo, b, m",
)
def outliers_replaced(spark, d):
    return cl.handle_outliers(star.fact_orders(spark, d), "total_amount", "replace", threshold=_NARROW).select(
        "order_id", "total_amount"
    )


@query(
    "clip_and_fill",
    """SELECT c_custkey AS customer_id, least(greatest(c_acctbal, 0.0), 5000.0) AS balance,
 CAST(coalesce(CASE WHEN c_custkey % 3 > 0 THEN 4 END, 0) AS BIGINT) AS total_orders FROM customer""",
)
def clip_and_fill(spark, d):
    raw = star.raw_customers(spark, d).select("customer_id", F.col("lifetime_value").alias("balance"), "total_orders")
    return cl.fill_numeric(cl.clip(raw, "balance", 0.0, 5000.0))


@query(
    "hash_pii",
    with_(CC) + """SELECT customer_id, sha256('ecommerce-salt' || email) AS email_hash,
 CASE WHEN length(email) > 4 THEN left(email, 2) || '***' || right(email, 2) WHEN email IS NOT NULL THEN '***' END AS email_masked,
 sha256('ecommerce-salt' || phone) AS phone_hash,
 CASE WHEN length(phone) > 4 THEN left(phone, 2) || '***' || right(phone, 2) ELSE '***' END AS phone_masked FROM ck""",
)
def hash_pii(spark, d):
    clean = cl.clean_customers(star.raw_customers(spark, d)).select("customer_id", "email", "phone")
    return en.hash_pii(clean, ["email", "phone"], drop_raw=True)


def _param(name: str) -> str:
    pattern = f"[?&]{name}=([^&#]*)"
    return f"CASE WHEN regexp_matches(url, '{pattern}') THEN regexp_extract(url, '{pattern}', 1) END AS {name}"


@query(
    "url_parameters",
    f"""SELECT page_id, {_param('utm_source')}, {_param('utm_medium')}, {_param('utm_campaign')},
 regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS referrer_domain FROM pages""",
)
def url_parameters(spark, d):
    out = en.url_parameters(star.table(spark, d, "pages"), "url", "url")
    return out.select("page_id", "utm_source", "utm_medium", "utm_campaign", "referrer_domain")


@query(
    "with_location",
    """SELECT c_custkey AS customer_id, c_nationkey AS location_id, n_name AS country, r_name AS region FROM customer
 JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def with_location(spark, d):
    people = star.dim_customers_base(spark, d).select("customer_id", "location_id")
    return en.with_location(people, star.dim_locations(spark, d))


# --- quality -----------------------------------------------------------------------

def check_rows(parts: list[tuple]) -> str:
    """SQL of check results: (name, severity, failing rows, rows, reason) of each, over a one-row table t."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, {failed} = 0 AS passed, '{sev}' AS severity, CAST({failed} AS BIGINT) AS failed_rows, {tot} AS total_rows,
 CASE WHEN {failed} = 0 THEN 'ok' ELSE CAST({failed} AS BIGINT) || ' of ' || {tot} || ' rows: {reason}' END AS message FROM t"""
        for name, sev, failed, tot, reason in parts
    )


ORDER_CHECKS = check_rows([
    ("not_null_order_id", "error", "(a - count_id)", "a", "order_id is missing"),
    ("not_null_customer_id", "error", "(a - count_cust)", "a", "customer_id is missing"),
    ("not_null_order_timestamp", "error", "(a - count_ts)", "a", "order_timestamp is missing"),
    ("unique_order_number", "error", "(a - dist)", "a", "order_number repeats another row''s"),
    ("range_total_amount", "error", "neg", "a", "total_amount lies outside 0 to inf"),
    ("range_item_count", "error", "noitems", "a", "item_count lies outside 0.0001 to inf"),
    ("range_discount_amount", "error", "negdisc", "a", "discount_amount lies outside 0 to inf"),
    ("enum_status", "error", "0", "a", ""),
])


def order_totals(rel: str) -> str:
    return f"""t AS (SELECT count(*) AS a, count(order_id) AS count_id, count(customer_id) AS count_cust,
 count(order_timestamp) AS count_ts, count(DISTINCT order_number) AS dist, count(*) FILTER (WHERE total_amount < 0) AS neg,
 count(*) FILTER (WHERE item_count < 0.0001) AS noitems, count(*) FILTER (WHERE discount_amount < 0) AS negdisc FROM {rel})"""


SUMMARY = """SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
 count(*) FILTER (WHERE NOT passed) AS failed_checks, CAST(0 AS BIGINT) AS warning_count,
 CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS status,
 count(*) FILTER (WHERE passed) * CAST(100 AS DOUBLE) / count(*) AS success_rate FROM r"""
_T = with_(FO, FW, order_totals("fw"))
_SHOWN = ["name", "passed", "severity", "failed_rows", "total_rows", "message"]


@query("validate_orders", _T + ORDER_CHECKS)
def validate_orders(spark, d):
    out = quality.orders_suite().run(star.fact_orders_wide(spark, d))
    return out.select(*_SHOWN)


@query("validate_orders_summary", _T + f", r AS ({ORDER_CHECKS}) {SUMMARY}")
def validate_orders_summary(spark, d):
    return etl.validate_data(star.fact_orders_wide(spark, d), "orders")


@query(
    "validate_customers",
    with_(CC, """t AS (SELECT count(*) AS a, count(*) - count(DISTINCT customer_key) AS dup, count(email) AS e,
 count(*) FILTER (WHERE lifetime_value < 0) AS neg FROM ck)""")
    + check_rows([
        ("not_null_customer_id", "error", "0", "a", ""), ("unique_customer_key", "error", "dup", "a", "customer_key repeats another row''s"),
        ("pattern_email_hash", "warning", "0", "e", ""), ("range_lifetime_value", "error", "neg", "a", "lifetime_value lies outside 0 to inf"),
        ("range_total_orders", "error", "0", "a", ""),
    ]),
)
def validate_customers(spark, d):
    frame = en.hash_pii(cl.clean_customers(star.raw_customers(spark, d)), ["email"], drop_raw=True)
    return quality.customers_suite().run(frame).select(*_SHOWN)


@query(
    "validate_products",
    with_("t AS (SELECT count(*) AS a, count(*) FILTER (WHERE p_retailprice < 0.0001) AS free FROM part)")
    + check_rows([
        ("not_null_product_id", "error", "0", "a", ""), ("not_null_name", "error", "0", "a", ""), ("unique_sku", "error", "0", "a", ""),
        ("range_unit_price", "error", "free", "a", "unit_price lies outside 0.0001 to inf"), ("range_stock_quantity", "error", "0", "a", ""),
    ]),
)
def validate_products(spark, d):
    return quality.products_suite().run(star.dim_products(spark, d)).select(*_SHOWN)


@query(
    "validate_custom_checks",
    with_(FO, FW, """t AS (SELECT count(*) AS a, (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')) AS orph,
 (SELECT count(*) FROM lineitem) AS li, count(*) FILTER (WHERE order_number !~ '^ORD-[0-9]*5') AS nofive FROM fw)""".replace("!~ '^ORD-[0-9]*5'", "NOT SIMILAR TO 'ORD-[0-9]*5[0-9]*'"))
    + """SELECT 'positive_total' AS name, true AS passed, CAST(0 AS BIGINT) AS failed_rows, a AS total_rows, 'ok' AS message FROM t
 UNION ALL SELECT 'too_dear', false, 0, a, 'the dearest order is above 1' FROM t
 UNION ALL SELECT 'no_such_column', false, 0, 0, 'cannot be computed' FROM t
 UNION ALL SELECT 'not_null_missing_one', false, 0, 0, 'no column missing_one' FROM t
 UNION ALL SELECT 'pattern_order_number', nofive = 0, nofive, a, nofive || ' of ' || a || ' rows: order_number does not fit the pattern' FROM t""",
)
def validate_custom_checks(spark, d):
    orders = star.fact_orders(spark, d)
    suite = (
        quality.Suite()
        .custom("positive_total", lambda df: F.sum("total_amount") > 0, "total is not positive")
        .custom("too_dear", lambda df: F.max("total_amount") <= 1, "the dearest order is above 1")
        .custom("no_such_column", lambda df: F.sum("nothing") > 0, "never")
        .not_null("missing_one")
        .pattern("order_number", "5")
    )
    # of an expression that cannot be built the reason is Spark's own text
    message = F.regexp_replace("message", "(?s)^(cannot be computed):.*", "$1").alias("message")
    return suite.run(orders).select("name", "passed", "failed_rows", "total_rows", message)


@query(
    "referential_integrity",
    """SELECT 'ref_integrity_l_orderkey' AS name, count(*) FILTER (WHERE o_orderkey IS NULL) = 0 AS passed,
 count(*) FILTER (WHERE o_orderkey IS NULL) AS failed_rows, count(*) AS total_rows,
 count(*) FILTER (WHERE o_orderkey IS NULL) || ' of ' || count(*) || ' rows: l_orderkey has no parent row' AS message
 FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = l_orderkey""",
)
def referential_integrity(spark, d):
    """Lines whose order is not among the finished ones."""
    finished = star.table(spark, d, "orders").where(F.col("o_orderstatus") == "F")
    out = quality.Suite().references("l_orderkey", finished, "o_orderkey").run(star.table(spark, d, "lineitem"))
    return out.select("name", "passed", "failed_rows", "total_rows", "message")


def _profile_sql(col: str, rel: str, numeric: bool) -> str:
    if numeric:
        stats = f"""CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, round(avg({col}), 6) AS mean,
 round(stddev_samp({col}), 4) AS std, {linear(rel, col, 0.25)} AS q1, {linear(rel, col, 0.5)} AS median, {linear(rel, col, 0.75)} AS q3"""
    else:
        stats = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("min", "max", "mean", "std", "q1", "median", "q3"))
    return f"""SELECT '{col}' AS column_name, count(*) AS row_count, count(*) - count({col}) AS null_count,
 count(DISTINCT {col}) AS distinct_count, {stats} FROM {rel}"""


@query(
    "profile_orders",
    with_(FO) + " UNION ALL ".join(
        _profile_sql(c, "fo", n) for c, n in
        (("order_id", True), ("customer_id", True), ("total_amount", True), ("status", False), ("payment_method", False))
    ),
)
def profile_orders(spark, d):
    wanted = ["order_id", "customer_id", "total_amount", "status", "payment_method"]
    return rounded(rounded(quality.profile(star.fact_orders(spark, d).select(*wanted), exact_distinct=True), ["mean"], 6), ["std"], 4)


# --- anomalies ---------------------------------------------------------------------

EV = "ev AS (SELECT 'order_revenue' AS metric_name, event_id AS idx, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)"


def _event_series(spark, d) -> DataFrame:
    """Event values by event id; error events have none."""
    e = star.table(spark, d, "events")
    valued = e.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return anomaly.series(valued, "event_id", {"order_revenue": "value"})


_BASE = f"""bs AS (SELECT avg(value) AS mean, stddev_pop(value) AS std, {linear('ev', 'value', 0.5)} AS median,
 {linear('ev', 'value', 0.25)} AS q1, {linear('ev', 'value', 0.75)} AS q3 FROM ev)"""
_ROUND = "metric_name, idx, anomaly_type, severity, value, round(expected_value, 6) AS expected_value, round(deviation, 6) AS deviation, threshold, method, rule_name"
_GRADE = lambda x, t: f"CASE WHEN {x} > {t} * 2 THEN 'critical' WHEN {x} > {t} * 1.5 THEN 'high' ELSE 'medium' END"
ZS = f"""zs AS (SELECT metric_name, idx, CASE WHEN value > mean THEN 'spike' ELSE 'drop' END AS anomaly_type,
 {_GRADE('abs((value - mean) / std)', '2.0')} AS severity, value, mean AS expected_value, abs((value - mean) / std) AS deviation,
 CAST(2 AS DOUBLE) AS threshold, 'z-score' AS method, CAST(NULL AS VARCHAR) AS rule_name FROM ev, bs WHERE abs((value - mean) / std) > 2.0)"""
IQ = """iq AS (SELECT metric_name, idx, 'outlier' AS anomaly_type, 'medium' AS severity, value, (q1 + q3) / 2 AS expected_value,
 CASE WHEN value > q3 + 1.5 * (q3 - q1) THEN (value - (q3 + 1.5 * (q3 - q1))) / (q3 - q1) ELSE (q1 - 1.5 * (q3 - q1) - value) / (q3 - q1) END AS deviation,
 CAST(1.5 AS DOUBLE) AS threshold, 'iqr' AS method, CAST(NULL AS VARCHAR) AS rule_name FROM ev, bs WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))"""
PC = f"""pw AS (SELECT *, lag(value) OVER (ORDER BY idx) AS prev FROM ev), px AS (SELECT *, (value - prev) / abs(prev) * 100 AS pct FROM pw WHERE prev <> 0),
pc AS (SELECT metric_name, idx, CASE WHEN pct > 0 THEN 'spike' ELSE 'drop' END AS anomaly_type, {_GRADE('abs(pct)', '50.0')} AS severity,
 value, prev AS expected_value, pct AS deviation, CAST(50 AS DOUBLE) AS threshold, 'pct_change' AS method, CAST(NULL AS VARCHAR) AS rule_name FROM px WHERE abs(pct) > 50)"""
MI = """mi AS (SELECT metric_name, CAST(NULL AS BIGINT) AS idx, 'missing' AS anomaly_type,
 CASE WHEN p > 50 THEN 'critical' WHEN p > 20 THEN 'high' ELSE 'medium' END AS severity, n AS value, CAST(0 AS DOUBLE) AS expected_value,
 p AS deviation, CAST(5 AS DOUBLE) AS threshold, 'missing' AS method, CAST(NULL AS VARCHAR) AS rule_name FROM (SELECT metric_name, CAST(count(*) - count(value) AS DOUBLE) AS n,
 CAST(count(*) - count(value) AS DOUBLE) / count(*) * 100 AS p FROM ev GROUP BY 1) WHERE p > 5)"""
RU = """ru AS (SELECT metric_name, idx, 'pattern' AS anomaly_type, CASE WHEN value < 1 THEN 'critical' ELSE 'high' END AS severity, value,
 CAST(0 AS DOUBLE) AS expected_value, CAST(0 AS DOUBLE) AS deviation, CAST(0 AS DOUBLE) AS threshold, 'rules' AS method,
 CASE WHEN value < 1 THEN 'tiny' ELSE 'small' END AS rule_name FROM ev WHERE value < 2)"""
_OUT = ["metric_name", "idx", "anomaly_type", "severity", "value", "expected_value", "deviation", "threshold", "method", "rule_name"]
_RULES = [
    anomaly.Rule("tiny", lambda v: v < 1, "Tiny value: {value}", "critical"),
    anomaly.Rule("small", lambda v: v < 2, "Small value", "high"),
]


def _shown(found: DataFrame) -> DataFrame:
    return rounded(found.select(*_OUT), ["expected_value", "deviation"])


@query(
    "anomaly_baseline",
    with_(EV, _BASE) + "SELECT 'order_revenue' AS metric_name, round(mean, 6) AS mean, round(std, 6) AS std, median, q1, q3 FROM bs",
)
def anomaly_baseline(spark, d):
    return rounded(anomaly.baseline(_event_series(spark, d)), ["mean", "std"])


@query("anomaly_zscore", with_(EV, _BASE, ZS) + f"SELECT {_ROUND} FROM zs")
def anomaly_zscore(spark, d):
    return _shown(anomaly.zscore(_event_series(spark, d), 2.0))


@query("anomaly_iqr", with_(EV, _BASE, IQ) + f"SELECT {_ROUND} FROM iq")
def anomaly_iqr(spark, d):
    return _shown(anomaly.iqr(_event_series(spark, d)))


@query("anomaly_pct_change", with_(EV, PC) + f"SELECT {_ROUND} FROM pc")
def anomaly_pct_change(spark, d):
    return _shown(anomaly.pct_change(_event_series(spark, d)))


@query("anomaly_missing", with_(EV, MI) + f"SELECT {_ROUND} FROM mi")
def anomaly_missing(spark, d):
    return _shown(anomaly.missing(_event_series(spark, d)))


@query(
    "anomaly_rules",
    with_(EV) + """SELECT metric_name, idx, 'tiny' AS rule_name, 'critical' AS severity, value, true AS named FROM ev WHERE value < 1
 UNION ALL SELECT metric_name, idx, 'small', 'high', value, true FROM ev WHERE value < 2""",
)
def anomaly_rules(spark, d):
    found = anomaly.rules(_event_series(spark, d), _RULES)
    text = F.when(F.col("rule_name") == "tiny", F.concat(F.lit("Tiny value: "), F.col("value").cast("string"))).otherwise("Small value")
    return found.select("metric_name", "idx", "rule_name", "severity", "value", (F.col("message") == text).alias("named"))


@query(
    "anomaly_mad",
    with_(EV, f"""c AS (SELECT {linear('ev', 'value', 0.5)} AS med), o AS (SELECT ev.*, med, abs(value - med) AS off FROM ev, c),
 s AS (SELECT {linear('o', 'off', 0.5)} * CAST(1.4826 AS DOUBLE) AS scale)""")
    + f"""SELECT metric_name, idx, value, med AS expected_value, round(off / scale, 6) AS deviation, {_GRADE('off / scale', '3.5')} AS severity
 FROM o, s WHERE off / scale > 3.5""",
)
def anomaly_mad(spark, d):
    out = anomaly.mad(_event_series(spark, d)).select("metric_name", "idx", "value", "expected_value", "deviation", "severity")
    return rounded(out, ["deviation"])


_ALLM = with_(EV, _BASE, ZS, IQ, PC, MI, RU, """al AS (SELECT *, 1 AS m FROM zs UNION ALL SELECT *, 2 FROM iq UNION ALL SELECT *, 3 FROM pc
 UNION ALL SELECT *, 4 FROM mi UNION ALL SELECT *, 5 FROM ru),
dt AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY metric_name, anomaly_type, idx ORDER BY m) = 1)""")


def _detected(spark, d) -> DataFrame:
    return anomaly.detect(_event_series(spark, d), _RULES, z_threshold=2.0)


@query("anomaly_detect", _ALLM + f"SELECT {_ROUND} FROM dt")
def anomaly_detect(spark, d):
    return _shown(_detected(spark, d))


@query(
    "anomaly_report",
    _ALLM + """SELECT 1 AS metrics_checked, count(*) AS anomalies_found, count(*) FILTER (WHERE severity IN ('critical', 'high')) AS critical_count,
 count(*) FILTER (WHERE severity IN ('critical', 'high')) > 0 AS has_critical_anomalies FROM dt""",
)
def anomaly_report(spark, d):
    return anomaly.report(_detected(spark, d), 1)


@query(
    "anomaly_alerts",
    _ALLM + """SELECT 'anomalies found' AS alert_type, severity, metric_name, anomaly_type, idx FROM dt
 ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 ELSE 2 END, metric_name, anomaly_type, idx NULLS FIRST LIMIT 10""",
)
def anomaly_alerts(spark, d):
    return anomaly.alerts(_detected(spark, d)).drop("message")


OS = """ev AS (SELECT 'order_revenue' AS metric_name, order_id AS idx, total_amount AS value FROM fw
 UNION ALL SELECT 'items_per_order', order_id, CAST(item_count AS DOUBLE) FROM fw)"""
ORDER_FINDINGS = f"""ob AS (SELECT metric_name, avg(value) AS mean, nullif(stddev_pop(value), 0) AS std, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
 FROM ev GROUP BY 1), ej AS (SELECT * FROM ev JOIN ob USING (metric_name)),
oz AS (SELECT metric_name, idx, CASE WHEN value > mean THEN 'spike' ELSE 'drop' END AS t, {_GRADE('abs((value - mean) / std)', '3.0')} AS severity, value, 1 AS m
 FROM ej WHERE abs((value - mean) / std) > 3),
oi AS (SELECT metric_name, idx, 'outlier', 'medium', value, 2 FROM ej WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)),
op AS (SELECT *, lag(value) OVER (PARTITION BY metric_name ORDER BY idx) AS prev FROM ev),
oc AS (SELECT *, (value - prev) / abs(prev) * 100 AS pct FROM op WHERE prev <> 0),
oh AS (SELECT metric_name, idx, CASE WHEN pct > 0 THEN 'spike' ELSE 'drop' END, {_GRADE('abs(pct)', '50.0')}, value, 3 FROM oc WHERE abs(pct) > 50),
orl AS (SELECT metric_name, idx, 'pattern', CASE WHEN value < 0 THEN 'critical' ELSE 'high' END, value, 5 FROM ev WHERE value <= 0),
oa AS (SELECT * FROM oz UNION ALL SELECT * FROM oi UNION ALL SELECT * FROM oh UNION ALL SELECT * FROM orl),
od AS (SELECT * FROM oa QUALIFY row_number() OVER (PARTITION BY metric_name, t, idx ORDER BY m) = 1)"""


@query(
    "order_anomalies",
    with_(FO, FW, OS, ORDER_FINDINGS) + "SELECT metric_name, idx, t AS anomaly_type, severity, value FROM od",
)
def order_anomalies(spark, d):
    # the join with the lines is computed once; the detector reads its input several times
    facts = materialize(star.fact_orders_wide(spark, d).select("order_id", "total_amount", "item_count"))
    found = anomaly.detect_order_anomalies(facts)
    return found.select("metric_name", "idx", "anomaly_type", "severity", "value")


# --- transformations ---------------------------------------------------------------

@query(
    "transform_orders",
    with_(CO, "q AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY customer_id ORDER BY order_timestamp) AS INTEGER) AS customer_order_sequence FROM co)")
    + """SELECT *, CAST(isodow(order_timestamp) AS INTEGER) AS order_day_of_week, CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
 CAST(month(order_timestamp) AS INTEGER) AS order_month, CAST(quarter(order_timestamp) AS INTEGER) AS order_quarter,
 isodow(order_timestamp) >= 6 AS is_weekend_order, customer_order_sequence = 1 AS is_first_order,
 subtotal - discount_amount AS net_amount, CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key FROM q""",
)
def transform_orders(spark, d):
    return etl.orders_frame(star.raw_orders(spark, d))


@query(
    "transform_customers",
    with_(FO, RFM, CLV, CC) + """SELECT customer_id, customer_key, country, sha256('ecommerce-salt' || email) AS email_hash,
 sha256('ecommerce-salt' || first_name) AS first_name_hash, left(first_name, 2) || '***' || right(first_name, 2) AS first_name_masked,
 rfm_recency_score, rfm_frequency_score, rfm_monetary_score, rfm_combined_score, customer_segment, clv.total_orders, total_revenue,
 clv.lifetime_value, strftime(first_order_date, '%Y-%m') AS acquisition_cohort
 FROM ck LEFT JOIN rfm USING (customer_id) LEFT JOIN clv USING (customer_id)""",
)
def transform_customers(spark, d):
    out = etl.customers_frame(star.raw_customers(spark, d), star.fact_orders(spark, d), REF)
    return out.select(
        "customer_id", "customer_key", "country", "email_hash", "first_name_hash", "first_name_masked", "rfm_recency_score",
        "rfm_frequency_score", "rfm_monetary_score", "rfm_combined_score", "customer_segment", "total_orders",
        "total_revenue", "lifetime_value", "acquisition_cohort",
    )


@query(
    "transform_products",
    with_(FO, FI, FIO, CP, f"""r AS (SELECT greatest((epoch_us(max(order_timestamp)) - epoch_us(min(order_timestamp))) / 1e6 / CAST(86400 AS DOUBLE), 1.0) AS days FROM fio),
s AS (SELECT product_id, sum(quantity) AS u, {total('line_total', 4)} AS rv, count(*) AS n FROM fio GROUP BY 1)""")
    + """SELECT product_id, sku, name, unit_price, cost_price, stock_quantity, coalesce(u, 0) AS total_units_sold,
 coalesce(rv, 0) AS total_product_revenue, coalesce(n, 0) AS order_count, u / days AS sales_velocity_daily,
 (unit_price - cost_price) / unit_price * 100 AS margin_percent FROM cp LEFT JOIN s USING (product_id), r""",
)
def transform_products(spark, d):
    out = etl.products_frame(star.raw_products(spark, d), star.items_with_orders(spark, d))
    return out.drop("avg_selling_price", "category")


@query(
    "transform_clickstream",
    with_(PV, SV, "m AS (SELECT session_id, count(*) AS n, min(event_timestamp) AS a, max(event_timestamp) AS b FROM sv GROUP BY 1)")
    + """SELECT page_view_id, visitor_id, event_type, date_key, session_id, n AS pages_per_session,
 (epoch_us(b) - epoch_us(a)) / CAST(1000000 AS DOUBLE) AS session_duration_seconds FROM sv JOIN m USING (session_id)""",
)
def transform_clickstream(spark, d):
    views = star.session_views(spark, d)
    untidy = views.withColumn("event_type", F.concat(F.lit(" "), "event_type", F.lit("\t"))).drop("date_key", "session_start")
    twice = untidy.unionByName(untidy.where(F.pmod("page_view_id", F.lit(4)) == 0))
    return etl.clickstream_frame(twice).select(
        "page_view_id", "visitor_id", "event_type", "date_key", "session_id", "pages_per_session", "session_duration_seconds"
    )
