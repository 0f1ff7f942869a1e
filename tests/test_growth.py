"""Sketches, drift, frequent pairs, values as of a time, and attribution on a stream."""

import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from merclake.operators import datasets, drift, sketches
from merclake.streaming import attribution, windows as win

T0 = datetime(2025, 1, 1)


def test_days_merge_to_ranges(spark):
    """Customers of overlapping days: the estimate is within its error, orders and revenue are exact."""
    orders = spark.range(60_000).select(
        (F.col("id") % 7000 + F.col("id") % 11 * 500).alias("customer_id"), (F.col("id") % 30 + 20250101).cast("int").alias("order_date_key"), F.lit(0.1).alias("total_amount"),
    )
    daily = sketches.daily_customer_sketches(orders)
    got = sketches.sales_between(daily, "2025-01-03", "2025-01-20").first()
    rows = orders.where("order_date_key between 20250103 and 20250120")
    exact = rows.select("customer_id").distinct().count()
    assert got.orders == rows.count() and got.revenue == pytest.approx(got.orders / 10, abs=1e-9)
    assert abs(got.customers - exact) <= sketches.DISTINCT_ERROR * exact
    late = sketches.daily_customer_sketches(orders.where("order_date_key = 20250104").withColumn("customer_id", F.col("customer_id") + 10**6))
    more = sketches.sales_between(daily.unionByName(late), "2025-01-04", "2025-01-04").first()  # a late part of a day merges too
    assert abs(more.customers - 2 * orders.where("order_date_key = 20250104").select("customer_id").distinct().count()) <= 0.025 * more.customers
    assert tuple(sketches.sales_between(daily, "2030-01-01", "2030-01-02").first()) == (0, None, 0)


def test_profile_grows_by_parts(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 5).alias("day"), F.when(F.col("id") % 4 > 0, F.sqrt("id")).alias("x"), F.lit(7).alias("same"), F.lit(float("nan")).alias("none"),
    )
    parts = sketches.column_sketches(df.where("day < 4"), ["x", "same", "none"], "day").unionByName(sketches.column_sketches(df.where("day = 4"), ["x", "same", "none"], "day"))
    got = {r["column"]: r for r in sketches.profile_of(parts, [0.1, 0.5, 0.9]).collect()}
    assert (got["x"].rows, got["x"].missing, got["x"].low, got["x"].high) == (40_000, 10_000, 1.0, pytest.approx(39_999**0.5))
    assert sketches.rank_is_close(df, "x", [0.1, 0.5, 0.9], got["x"].quantiles).first()[0]
    assert not sketches.rank_is_close(df, "x", [0.5], got["x"].quantiles[:1]).first()[0]
    assert got["same"].quantiles == [7.0] * 3 and sketches.rank_is_close(df, "same", [0.1, 0.5, 0.9], [7.0] * 3).first()[0]
    assert got["none"].missing == 40_000 and got["none"].quantiles is None


def test_cusum_equals_the_loop(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for metric in ("a", "b"):
        up = down = 0.0
        for i in range(300):
            x = None if i % 17 == 0 else round(rng.gauss(10 + (3 if metric == "a" and 120 < i < 180 else 0), 2), 3)
            rows.append((metric, i * 3, x))
            if x is not None:
                z = (x - 10.0) / 2.0
                up, down = max(0, up + round((z - 0.5) * 1e4)), max(0, down + round((-z - 0.5) * 1e4))
            want[metric, i * 3] = (up / 1e4, down / 1e4)
    df = spark.createDataFrame(rows, "metric_name string, idx long, value double").repartition(7)
    limits = spark.createDataFrame([("a", 10.0, 2.0), ("b", 10.0, 2.0)], "metric_name string, target double, unit double")
    charted = drift.cusum(df, limits).cache()
    got = {(r.metric_name, r.idx): (r.above, r.below) for r in charted.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-3) for k in want)
    periods = {(r.metric_name, r.drift): r for r in drift.drift_periods(charted).collect()}
    assert ("a", "up") in periods and 120 * 3 < periods["a", "up"].first_idx < 180 * 3
    assert drift.cusum(df.where("false"), limits).count() == 0


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.1, 5.0), (None, 1.0, 5.0), (4.0, float("nan"), 5.0)], "a double, b double, c double")
    got = {(r.metric_a, r.metric_b): (r.points, r.correlation) for r in drift.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (3, pytest.approx(0.99992, abs=1e-4)) and got["a", "c"] == (4, None) and got["b", "c"] == (4, None)


def test_frequent_pairs(spark):
    rng = random.Random(2)
    baskets = {o: rng.choices(range(12), weights=range(12, 0, -1), k=rng.randint(1, 6)) for o in range(200)}
    baskets[999] = list(range(12)) * 2
    items = spark.createDataFrame([(o, p) for o, b in baskets.items() for p in b], "order_id long, product_id long")
    n, pairs = Counter(), Counter()
    for b in baskets.values():
        n.update(set(b))
        pairs.update(combinations(sorted(set(b)), 2))
    for least in (1, 5, 30):
        got = {(r.product_a, r.product_b): (r.orders, r.confidence, r.lift) for r in datasets.frequent_pairs(items, least).collect()}
        want = {(a, b): (k, k / n[a], k * len(baskets) / (n[a] * n[b])) for (a, b), k in pairs.items() if k >= least}
        assert got == {k: (v[0], pytest.approx(v[1]), pytest.approx(v[2])) for k, v in want.items()}


def test_as_of(spark):
    at = lambda h: T0 + timedelta(hours=h)
    facts = spark.createDataFrame([(1, "a", at(0)), (2, "a", at(5)), (3, "a", at(9)), (4, "b", at(9)), (5, None, at(9)), (6, "a", at(30))], "id int, k string, t timestamp_ntz")
    versions = spark.createDataFrame(
        [("a", at(1), at(6), "x", 1), ("a", at(6), at(20), "y", 2), ("a", at(30), None, "z", 3), ("b", at(10), None, "w", 4), (None, at(0), None, "n", 5)],
        "key string, since timestamp_ntz, till timestamp_ntz, name string, no int",
    )
    got = {r.id: (r.name, r.no) for r in win.as_of(facts, versions, {"k": "key"}, "t", "since", "id", until="till").collect()}
    assert got == {1: (None, None), 2: ("x", 1), 3: ("y", 2), 4: (None, None), 5: (None, None), 6: ("z", 3)}
    got = {r.id: r.name for r in win.as_of(facts.where("id = 6"), versions.drop("till").where("no < 3"), {"k": "key"}, "t", "since", "id").collect()}
    assert got == {6: "y"}


def test_busy_units_are_spread(spark):
    """One visitor with nearly all rows of one hour: no task of the windows gets them all."""
    rows = spark.range(20_000).select(
        F.col("id").alias("page_view_id"), F.lit(None).cast("string").alias("visitor_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") / 10)).cast("timestamp_ntz").alias("event_timestamp"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range
    try:
        spread = win.ranged(rows, ["visitor_id", "event_timestamp", "page_view_id"]).groupBy("_range").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 2 and max(r["count"] for r in spread) < 12_000
    assert win.sessionize(rows).select("session_id").distinct().count() == 1


def test_stream_attribution_and_its_rest(spark, tmp_path):
    """Orders and touches in files out of order, some hours late: stream and rest together give every order once, and
    each as a batch over all rows would."""
    rng = random.Random(5)
    order_kind, touch_kind = "order_id long, customer_id string, order_timestamp timestamp, total_amount double", "customer_id string, event_timestamp timestamp, utm_source string"
    orders = [(i, rng.choice("abc"), T0 + timedelta(minutes=rng.randint(0, 20_000)), 1.0) for i in range(150)] + [(900, None, T0, 1.0)]
    touches = [(rng.choice("abd"), T0 + timedelta(minutes=rng.randint(0, 20_000)), rng.choice(["mail", "ads", None])) for _ in range(150)]
    orders.sort(key=lambda r: r[2])
    touches.sort(key=lambda r: r[1])
    late, on_time = orders[5:8], orders[:5] + orders[8:]
    for i, part in enumerate((on_time[:70], on_time[70:], late)):
        spark.createDataFrame(part, order_kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders")
    for part in (touches[:70], touches[70:]):
        spark.createDataFrame(part, touch_kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/touches")
    read = lambda name, kind: spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    stream = attribution.stream_last_touch(read("orders", order_kind), read("touches", touch_kind), within="2 days", lateness="30 minutes")
    (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination())
    done = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    all_orders, all_touches = spark.read.parquet(f"{tmp_path}/orders"), spark.read.parquet(f"{tmp_path}/touches")
    rest = attribution.attribute_rest(all_orders, all_touches, done, within="2 days")
    got = Counter((r.order_id, r.attributed_source) for r in done.unionByName(rest).collect())
    want = Counter()
    for i, customer, at, _ in orders:
        near = [(t, s) for u, t, s in touches if u == customer and u is not None and s and at - timedelta(days=2) <= t <= at]
        want[i, max(near)[1] if near else None] += 1
    assert got == want
    assert done.count() > 50 and {r[0] for r in late} <= {r.order_id for r in rest.collect()}
