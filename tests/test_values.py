"""Hand-computed customer values, features and training sets."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from merclake.functions.columns import moment
from merclake.operators import datasets, enrichment as en, features as ft, lookups, sales
from merclake.operators.cleaning import clean_orders


def placed(spark, rows):
    """rows of (customer, day, amount)"""
    data = [(i, c, d, float(a)) for i, (c, d, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "order_id bigint, customer_id string, day string, total_amount double")
    return df.withColumn("order_timestamp", F.col("day").cast("timestamp_ntz")).drop("day")


@pytest.fixture()
def five(spark):
    """Customer k has k orders of k * 10 each, the last k days before the reference date."""
    rows = []
    for k in range(1, 6):
        for j in range(k):
            rows.append((f"c{k}", f"2025-01-{31 - k - j:02d}", 10 * k))
    return placed(spark, rows)


def test_rfm(five):
    out = {r.customer_id: r for r in en.rfm_scores(five, "2025-01-31").collect()}
    assert [out[f"c{k}"].recency_days for k in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [out[f"c{k}"].frequency for k in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [out[f"c{k}"].monetary for k in range(1, 6)] == [10, 40, 90, 160, 250]
    # nearest quantiles of 1..5 at .2/.4/.6/.8 are 2, 3, 3, 4 (ranks 1.3, 2.1, 2.9, 3.7 floored)
    assert [out[f"c{k}"].rfm_recency_score for k in range(1, 6)] == [5, 5, 4, 2, 1]
    assert [out[f"c{k}"].rfm_frequency_score for k in range(1, 6)] == [1, 2, 4, 5, 5]
    assert out["c5"].rfm_combined_score == 11 and out["c5"].customer_segment == "loyal"
    assert out["c1"].customer_segment == "potential"


def test_lifetime_value(spark):
    df = placed(spark, [("a", "2024-01-01", 100), ("a", "2024-12-31", 300), ("b", "2024-06-01", 50)])
    out = {r.customer_id: r for r in en.customer_lifetime_value(df, "2025-01-31").collect()}
    assert out["a"].customer_lifespan_days == 365 and out["a"].purchase_frequency_yearly == 2.0
    assert out["a"].projected_annual_value == 400.0 and out["a"].lifetime_value == 400.0
    assert out["b"].purchase_frequency_yearly == 1.0 and out["b"].projected_annual_value == 50.0


def test_cohorts(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2024-01-01",), ("2024-12-31",)], "d string")
    df = df.select(F.col("d").cast("timestamp_ntz").alias("first_order_date"))
    label = lambda g: [r.acquisition_cohort for r in en.add_cohorts(df, granularity=g).collect()]
    assert label("month") == ["2023-01", "2024-01", "2024-12"]
    assert label("quarter") == ["2023-Q1", "2024-Q1", "2024-Q4"]
    assert label("week") == [date(2023, 1, 1).strftime("%Y-W%W"), date(2024, 1, 1).strftime("%Y-W%W"), date(2024, 12, 31).strftime("%Y-W%W")]


def featured(df):
    return df.withColumns({"item_count": F.lit(2), "has_promo_code": F.col("total_amount") > 100, "is_first_order": F.lit(False)})


def test_customer_features_and_churn(spark):
    rows = [("a", "2024-12-01", 100), ("a", "2024-12-31", 300), ("b", "2024-01-01", 50)]
    out = ft.customer_features(featured(placed(spark, rows)), "2025-01-30")
    a = out.where("customer_id = 'a'").first()
    assert (a.recency_days, a.order_count, a.total_spend, a.avg_order_value) == (30, 2, 400.0, 200.0)
    assert (a.tenure_days, a.lifespan_days, a.orders_per_month, a.avg_days_between_orders) == (60, 30, 2.0, 30.0)
    assert (a.promo_usage_rate, a.total_items) == (0.5, 4)
    b = out.where("customer_id = 'b'").first()
    assert b.std_order_value is None and b.avg_days_between_orders is None and b.orders_per_month == 1.0
    churn = {r.customer_id: r for r in ft.churn_outlook(ft.churn_features(out)).collect()}
    assert churn["a"].churn_risk_score == pytest.approx(30 / 90 * 0.5) and not churn["a"].is_churned
    assert churn["b"].churn_risk_score == pytest.approx(2 * 0.5 + 0.5 * 0.3 + (1 - 50 / 400) * 0.2)
    assert churn["b"].is_churned and churn["b"].churn_probability == 1.0
    assert churn["a"].predicted_next_purchase_date == date(2025, 1, 30)
    clv = {r.customer_id: r for r in ft.clv_features(out).collect()}
    assert clv["a"].projected_clv == 200.0 * 2 * 12 and clv["a"].clv_quartile == 4
    assert "first_order_date" not in ft.ml_dataset(featured(placed(spark, rows)), "2025-01-30", "clv").columns
    with pytest.raises(ValueError):
        ft.ml_dataset(featured(placed(spark, rows)), "2025-01-30", "weather")


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1003).select(F.col("id").alias("customer_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = datasets.train_val_split(df, "customer_id", 0.2, 42, "y")
    two = datasets.train_val_split(df.repartition(9), "customer_id", 0.2, 42, "y")
    sizes = {(r.y, r.split): r["count"] for r in one.groupBy("y", "split").count().collect()}
    assert sizes == {(0, "val"): 181, (0, "train"): 721, (1, "val"): 21, (1, "train"): 80}
    assert one.exceptAll(two).count() == 0
    other = datasets.train_val_split(df, "customer_id", 0.2, 43, "y")
    assert one.exceptAll(other).count() > 0


def test_select_features(spark):
    df = spark.createDataFrame([("c", 1, 2.0, True, "x")], "customer_id string, n bigint, v double, b boolean, s string")
    assert datasets.select_features(df) == ["n", "v"]
    assert datasets.select_features(df, exclude=["v"], booleans=True) == ["n", "b"]
    assert datasets.select_features(df, include=["s"]) == ["s"]


def test_baskets(spark):
    rows = [("big", p) for p in range(25)] + [("big", 3)] * 12 + [("small", 2), ("small", 1), ("small", 2)]
    items = spark.createDataFrame(rows, "order_id string, product_id bigint")
    out = {(r.order_id, r.product_id): r.times for r in datasets.order_baskets(items).collect()}
    assert out == {key: rows.count(key) for key in rows}


def test_co_purchase(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, "c")]
    items = spark.createDataFrame(rows, "order_id int, product_id string")
    out = {(r.product_id, r.other_id): r.orders for r in datasets.co_purchased_with(items, ["a"]).collect()}
    assert out == {("a", "b"): 2, ("a", "c"): 1}


def test_overview_growth(spark):
    df = placed(spark, [("a", "2025-01-01", 100), ("a", "2025-01-05", 150), ("b", "2025-01-06", 150)])
    r = sales.sales_overview(df, "2025-01-05", "2025-01-08").first()
    assert (r.total_revenue, r.total_orders, r.avg_order_value, r.total_customers) == (300.0, 2, 150.0, 2)
    assert (r.revenue_growth, r.orders_growth) == (200.0, 100.0)
    empty = sales.sales_overview(df, "2030-01-01", "2030-01-02").first()
    assert (empty.total_revenue, empty.total_orders, empty.revenue_growth) == (0.0, 0, None)


def test_pages(spark):
    df = spark.range(95).select(F.col("id"), (F.col("id") % 7).alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    got, last = [], None
    while True:
        rows = lookups.page_after(df, "v", "id", last, 20).collect()
        if not rows:
            break
        got += [r.id for r in rows]
        last = (rows[-1].v, rows[-1].id)
    paged = [r.id for p in range(1, 6) for r in lookups.page(df, order, p, 20).collect()]
    assert got == paged == [r.id for r in df.orderBy(*order).collect()]
    assert lookups.page_info(df, 1, 20).first().total_pages == 5


def test_filters(products):
    found = lambda **kw: sorted(r.product_id for r in lookups.find_products(products, **kw).collect())
    assert found(search="LAMP") == [9001] and found(search="e") == [9001, 9002]  # 9003 is not on sale
    assert found(search="%") == []
    assert found(max_price=0.0) == []
    assert found(category="sport", min_price=119.0) == [9002] and found(category="sport", min_price=119.01) == []


def test_attribution_and_clean_orders_chain(spark, orders):
    from merclake.plans import etl

    frame = etl.orders_frame(orders)
    assert {"order_date_key", "customer_order_sequence"} <= set(frame.columns) and "net_amount" not in frame.columns
    assert [r.order_date_key for r in frame.orderBy("order_id").collect()] == [20240229, 20240309, 20240310]
    assert clean_orders(orders).where(F.col("order_timestamp") >= moment(datetime(2024, 3, 9))).count() == 2
