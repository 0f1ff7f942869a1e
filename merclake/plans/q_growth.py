"""Queries that answer from merged or carried state: sketches, drift, frequent pairs, values as of a time, attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from merclake.operators import anomaly, datasets, drift, search, sketches
from merclake.plans import star
from merclake.plans.registry import FO, PV, query, total, with_
from merclake.session import materialize, shared_dir
from merclake.sources import clustered
from merclake.sources.readers import read_event_files
from merclake.streaming import attribution, windows as win

# --- sketches ----------------------------------------------------------------------

RANGES = [("1995-01-01", "1995-01-31"), ("1996-03-04", "1996-03-04"), ("1997-01-01", "1997-12-31"), ("1995-01-01", "2001-08-01"), ("2010-01-01", "2010-01-31")]


@query(
    "customers_of_ranges",
    with_(FO) + " UNION ALL ".join(
        f"""SELECT '{a}' AS first_day, count(*) AS orders, {total('total_amount')} AS revenue, count(DISTINCT customer_id) AS customers, true AS is_close
 FROM fo WHERE order_timestamp >= TIMESTAMP '{a}' AND order_timestamp < TIMESTAMP '{b}' + INTERVAL 1 DAY""" for a, b in RANGES
    ),
)
def customers_of_ranges(spark, d):
    """Ranges of days answered from the stored daily rows; the estimate of the customers is within its stated error of the
    exact count, which is shown."""
    path, orders = shared_dir(spark, "daily"), star.fact_orders(spark, d)
    sketches.daily_customer_sketches(orders).write.parquet(path)
    daily, rows = spark.read.parquet(path), []
    for a, b in RANGES:
        exact = sketches.exact_sales_between(orders, a, b).select("customers").scalar()
        answered = sketches.sales_between(daily, a, b).withColumn("exact", exact)
        close = F.abs(F.col("customers") - F.col("exact")) <= F.greatest(F.lit(0.5), sketches.DISTINCT_ERROR * F.col("exact"))
        rows.append(answered.select(F.lit(a).alias("first_day"), "orders", "revenue", F.col("exact").alias("customers"), close.alias("is_close")))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


_SHARES = [0.05, 0.25, 0.5, 0.75, 0.99]
_PROFILED = ["total_amount", "customer_id"]


def _column_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, CAST(min({c}) AS DOUBLE) AS low,
 CAST(max({c}) AS DOUBLE) AS high, true AS is_close FROM m"""


@query(
    "profile_from_sketches",
    with_(FO, "m AS (SELECT CASE WHEN order_id % 9 > 0 THEN total_amount END AS total_amount, customer_id FROM fo)") + " UNION ALL ".join(map(_column_sql, _PROFILED)),
)
def profile_from_sketches(spark, d):
    """Sketches of all months but the last are stored, those of the last are added; the quantiles over all months are
    within their stated rank error."""
    path = shared_dir(spark, "sketches")
    orders = star.fact_orders(spark, d)
    orders = orders.withColumn("total_amount", F.when(F.pmod("order_id", F.lit(9)) > 0, F.col("total_amount")))
    month = F.floor(F.col("order_date_key") / 100).cast("int")
    last = F.col("order_date_key") >= 20010801
    for part in (~last, last):
        sketches.column_sketches(orders.where(part), _PROFILED, month).write.mode("append").parquet(path)
    profile = materialize(sketches.profile_of(spark.read.parquet(path), _SHARES))
    out = None
    for c in _PROFILED:
        mine = profile.where(F.col("column") == c)
        close = sketches.rank_is_close(orders, c, _SHARES, mine.first()["quantiles"])
        row = mine.select("column", "rows", "missing", "low", "high", close.scalar().alias("is_close"))
        out = row if out is None else out.unionByName(row)
    return out


# --- drift -------------------------------------------------------------------------

_TARGET, _UNIT = 4_500_000.0, 900_000.0


def _daily_series(spark, d) -> DataFrame:
    daily = star.fact_orders(spark, d).groupBy("order_date_key").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.rint(F.col("total_amount")).cast("bigint")).alias("revenue"))
    return anomaly.series(daily, "order_date_key", {"orders": "orders", "revenue": "revenue"})


def _limits(spark) -> DataFrame:
    return spark.createDataFrame([("orders", 6.0, 2.5), ("revenue", _TARGET / 5, _UNIT / 2)], "metric_name string, target double, unit double")


_CUSUM = f"""d AS (SELECT CAST(CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS BIGINT) AS idx, CAST(count(*) AS DOUBLE) AS o, CAST(sum(CAST(round_even(o_totalprice, 0) AS BIGINT)) AS DOUBLE) AS r
 FROM orders GROUP BY 1),
s AS (SELECT 'orders' AS metric_name, idx, o AS value, (o - 6.0::DOUBLE) / 2.5::DOUBLE AS z FROM d UNION ALL SELECT 'revenue', idx, r, (r - {_TARGET / 5}::DOUBLE) / {_UNIT / 2}::DOUBLE FROM d),
i AS (SELECT *, CAST(round_even((z - 0.5::DOUBLE) * 10000::DOUBLE, 0) AS BIGINT) AS u, CAST(round_even((-z - 0.5::DOUBLE) * 10000::DOUBLE, 0) AS BIGINT) AS w FROM s),
p AS (SELECT *, sum(u) OVER t AS pu, sum(w) OVER t AS pw FROM i WINDOW t AS (PARTITION BY metric_name ORDER BY idx)),
q AS (SELECT *, CAST(pu - least(0, min(pu) OVER t) AS DOUBLE) / 10000 AS above, CAST(pw - least(0, min(pw) OVER t) AS DOUBLE) / 10000 AS below FROM p WINDOW t AS (PARTITION BY metric_name ORDER BY idx)),
c AS (SELECT metric_name, idx, value, above, below, CASE WHEN above > 5 AND above >= below THEN 'up' WHEN below > 5 THEN 'down' END AS drift FROM q)"""


@query("metric_drift", with_(_CUSUM) + "SELECT * FROM c")
def metric_drift(spark, d):
    return drift.cusum(_daily_series(spark, d), _limits(spark))


@query(
    "metric_drift_periods",
    with_(_CUSUM) + "SELECT metric_name, drift, min(idx) AS first_idx, max(idx) AS last_idx, count(*) AS points FROM c WHERE drift IS NOT NULL GROUP BY 1, 2",
)
def metric_drift_periods(spark, d):
    return drift.drift_periods(drift.cusum(_daily_series(spark, d), _limits(spark)))


_LINES = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax"}


@query(
    "metric_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, count(*) AS points, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for i, a in enumerate(_LINES) for b in list(_LINES)[i + 1 :]
    ),
)
def metric_correlations(spark, d):
    return drift.correlations(star.table(spark, d, "lineitem"), list(_LINES)).withColumn("correlation", F.round("correlation", 6))


# --- baskets and versions ----------------------------------------------------------

@query(
    "frequent_pairs",
    """WITH l AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem), c AS (SELECT p, count(*) AS n FROM l GROUP BY 1),
 f AS (SELECT a.p AS product_a, b.p AS product_b, count(*) AS orders FROM l a JOIN l b ON a.o = b.o AND a.p < b.p GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT product_a, product_b, orders, CAST(orders AS DOUBLE) / ca.n AS confidence,
 CAST(orders AS DOUBLE) * (SELECT count(DISTINCT o) FROM l) / (CAST(ca.n AS DOUBLE) * cb.n) AS lift
 FROM f JOIN c ca ON ca.p = product_a JOIN c cb ON cb.p = product_b""",
)
def frequent_pairs(spark, d):
    return datasets.frequent_pairs(star.fact_order_items(spark, d), 2)


_VERSIONS = """v AS (SELECT c_custkey AS k, c_mktsegment AS segment, TIMESTAMP '1995-01-01' AS effective_from,
 CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1998-01-01' END AS effective_to FROM customer
 UNION ALL SELECT c_custkey, 'LOYAL', TIMESTAMP '1998-01-01', TIMESTAMP '2000-06-01' FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT c_custkey, 'REGULAR', TIMESTAMP '2000-07-01', NULL FROM customer WHERE c_custkey % 3 = 0)"""


@query(
    "orders_as_of",
    with_(FO, _VERSIONS) + """SELECT order_id, customer_id, order_timestamp, total_amount,
 CASE WHEN effective_to IS NULL OR effective_to > order_timestamp THEN segment END AS segment
 FROM fo ASOF LEFT JOIN v ON v.k = fo.customer_id AND v.effective_from <= fo.order_timestamp""",
)
def orders_as_of(spark, d):
    """Orders with the segment that their customer had on the day, from the versions that SCD2 keeps: every third
    customer changed in 1998 and, after a gap, in 2000."""
    c = star.table(spark, d, "customer")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    changed = F.pmod("c_custkey", F.lit(3)) == 0
    version = lambda rows, segment, start, end: rows.select(F.col("c_custkey").alias("k"), segment.alias("segment"), at(start).alias("effective_from"), end.alias("effective_to"))
    versions = (
        version(c, F.col("c_mktsegment"), "1995-01-01", F.when(changed, at("1998-01-01")))
        .unionByName(version(c.where(changed), F.lit("LOYAL"), "1998-01-01", at("2000-06-01")))
        .unionByName(version(c.where(changed), F.lit("REGULAR"), "2000-07-01", F.lit(None).cast("timestamp_ntz")))
    )
    orders = star.fact_orders(spark, d).select("order_id", "customer_id", "order_timestamp", "total_amount")
    return win.as_of(orders, versions, {"customer_id": "k"}, "order_timestamp", "effective_from", "order_id", until="effective_to")


# --- search and clustering ---------------------------------------------------------

_PROD = "product_id, sku, name, brand, category, unit_price, stock_quantity"


@query(
    "product_search_index",
    f"""WITH p AS (SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS name, p_brand AS brand, p_type AS category, p_retailprice AS unit_price,
 p_size AS stock_quantity FROM part), q(text) AS (VALUES ('RING'), ('part 12'), ('_'), ('no such name'), ('9'))
SELECT text, p.* FROM p JOIN q ON contains(lower(name), lower(text))""",
)
def product_search_index(spark, d):
    """Searches through the stored index, among them one with a wildcard sign, one without a hit and one of a single sign."""
    path = shared_dir(spark, "names")
    search.write_name_index(star.dim_products(spark, d).select(*_PROD.split(", ")), path, "product_id", "name", parts=16)
    out = None
    for text in ("RING", "part 12", "_", "no such name", "9"):
        hits = search.search_names(spark, path, text).select(F.lit(text).alias("text"), *_PROD.split(", "))
        out = hits if out is None else out.unionByName(hits)
    return out


@query(
    "orders_clustered",
    with_(FO) + """SELECT 'amount' AS asked, order_id, total_amount FROM fo WHERE total_amount >= 400000
 UNION ALL SELECT 'customer', order_id, total_amount FROM fo WHERE customer_id BETWEEN 10 AND 14
 UNION ALL SELECT 'both', order_id, total_amount FROM fo WHERE order_timestamp BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-02-01' AND customer_id <= 100""",
)
def orders_clustered(spark, d):
    """Filters on any of three columns of orders stored in Z-order."""
    path = shared_dir(spark, "clustered")
    orders = star.fact_orders(spark, d).select("order_id", "customer_id", "order_timestamp", "total_amount")
    clustered.write_clustered(orders, path, ["customer_id", "order_timestamp", "total_amount"], files=16)
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    asked = {
        "amount": {"total_amount": (400000.0, None)}, "customer": {"customer_id": (10, 14)},
        "both": {"order_timestamp": (day("1996-01-01"), day("1996-02-01")), "customer_id": (None, 100)},
    }
    parts = [clustered.read_between(spark, path, bounds).select(F.lit(name).alias("asked"), "order_id", "total_amount") for name, bounds in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- attribution -------------------------------------------------------------------

_BOUNDED = """b AS (SELECT event_id AS order_id, user_id AS customer_id, ts AS order_timestamp, value AS total_amount,
 (SELECT arg_max(t.event_type, (t.ts, t.event_type)) FROM events t WHERE t.user_id = e.user_id AND t.event_type IN ('view', 'click')
  AND t.ts <= e.ts AND t.ts >= e.ts - INTERVAL 3 DAY) AS attributed_source FROM events e WHERE event_type = 'purchase'),
w AS (SELECT date_trunc('millisecond', least(max(ts) FILTER (WHERE event_type = 'purchase'), max(ts) FILTER (WHERE event_type IN ('view', 'click')))
 - INTERVAL 10 MINUTE) - INTERVAL 3 DAY AS closed FROM events)"""
_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _purchases(rows: DataFrame) -> DataFrame:
    return rows.where("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"), F.col("ts").alias("order_timestamp"), F.col("value").alias("total_amount")
    )


def _touches(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("event_type").isin("view", "click")).select(F.col("user_id").alias("customer_id"), F.col("ts").alias("event_timestamp"), "event_type")


_OPTIONS = {"within": "3 days", "source": "event_type"}


def _attributed(spark, d) -> DataFrame:
    root = shared_dir(spark, "attribution")
    stream = lambda: read_event_files(spark, d, _EVENTS, "events.parquet")
    found = attribution.stream_last_touch(_purchases(stream()), _touches(stream()), **_OPTIONS)
    (
        found.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    rows = spark.read.schema(found.schema).parquet(f"{root}/rows")
    return rows.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


@query("stream_last_touch", with_(_BOUNDED) + "SELECT b.* FROM b, w WHERE order_timestamp <= closed")
def stream_last_touch(spark, d):
    """The orders whose touches are complete when the files end."""
    return _attributed(spark, d)


@query("stream_last_touch_and_rest", with_(_BOUNDED) + "SELECT * FROM b")
def stream_last_touch_and_rest(spark, d):
    """With the orders that the stream has not emitted, attributed as a batch."""
    done, rows = _attributed(spark, d), star.table(spark, d, "events")
    rest = attribution.attribute_rest(_purchases(rows), _touches(rows), done, **_OPTIONS)
    return done.unionByName(rest)
