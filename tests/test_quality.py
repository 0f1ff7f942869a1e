import pytest
from pyspark.sql import functions as F

from merclake.operators import anomaly, quality
from merclake.operators.quality import Suite


def only(suite, df):
    return suite.run(df).collect()[0]


@pytest.mark.parametrize(
    "values, passed, failed", [(["x", "", "0", "y"], True, 0), ([None, "x", None, ""], False, 2)],
)
def test_not_null(spark, values, passed, failed):
    r = only(Suite().not_null("code"), spark.createDataFrame([(v,) for v in values], "code string"))
    assert (r.passed, r.failed_rows, r.total_rows) == (passed, failed, 4)


@pytest.mark.parametrize("values, failed", [([8, 6, 4, 2], 0), ([5, 5, 5, 9, 9], 3), ([None, None, None, 4], 2), ([None, 4], 0)])
def test_unique(spark, values, failed):
    assert only(Suite().unique("id"), spark.createDataFrame([(v,) for v in values], "id int")).failed_rows == failed


def test_range(spark):
    df = spark.createDataFrame([(0.0,), (-0.25,), (12.5,), (12.51,), (7.0,), (None,), (float("nan"),), (99.0,)], "weight double")
    r = only(Suite().in_range("weight", 0, 12.5), df)
    assert (r.passed, r.failed_rows, r.total_rows) == (False, 3, 8) and "3" in r.message and "12.5" in r.message
    assert only(Suite().positive("weight", allow_zero=False), df).failed_rows == 2
    assert only(Suite().positive("weight"), df).failed_rows == 1


def test_enum_and_pattern(spark):
    df = spark.createDataFrame([("S", "AB-12"), ("M", "ab-12"), ("XXL", "AB-1"), (None, None), ("L", "AB-123")], "size string, code string")
    r = only(Suite().one_of("size", ["S", "M", "L", "XL"]), df)
    assert (r.passed, r.failed_rows) == (False, 1)
    r = only(Suite().pattern("code", "^[A-Z]{2}-[0-9]{2}$"), df)
    assert (r.passed, r.failed_rows, r.total_rows) == (False, 3, 4)


def test_custom_missing_and_broken(spark):
    df = spark.createDataFrame([(3, 0.5), (4, 0.25)], "n int, share double")
    suite = (
        Suite().custom("whole", lambda d: F.sum("share") <= 1, "shares add up to more than one").custom("bad", lambda d: F.sum("nope") < 1, "never")
        .custom("least", lambda d: F.min("n") > 3, "too few").not_null("absent")
    )
    rows = {r.name: r for r in suite.run(df).collect()}
    assert rows["whole"].passed and not rows["least"].passed and not rows["bad"].passed and not rows["not_null_absent"].passed
    assert "absent" in rows["not_null_absent"].message


def test_references(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    r = only(Suite().references("k", parent, "id"), child)
    assert (r.passed, r.failed_rows, r.total_rows) == (False, 1, 4)


def test_status(spark, orders):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    status = lambda s: s.summary(s.run(df)).first().status
    assert status(Suite().not_null("id")) == "failed"
    assert status(Suite().not_null("id", "warning")) == "partial"
    assert status(Suite(strict=True).not_null("id", "warning")) == "failed"
    empty = Suite()
    assert empty.summary(empty.run(df)).first().success_rate == 100.0
    suite = quality.orders_suite()
    known = orders.where("customer_id IS NOT NULL")
    summary = suite.summary(suite.run(known)).first()
    assert summary.total_checks == 8 and summary.status == "passed"
    assert suite.summary(suite.run(orders)).first().status != "passed"  # the guest order


def test_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (4.0, None), (None, "b")], "v double, s string")
    rows = {r.column_name: r for r in quality.profile(df, exact_distinct=True).collect()}
    assert (rows["v"].null_count, rows["v"].distinct_count, rows["v"].median) == (1, 3, 2.0)
    assert (rows["s"].null_count, rows["s"].distinct_count, rows["s"].mean) == (1, 2, None)


def metric(spark, values, name="m"):
    return spark.createDataFrame([(name, i, None if v is None else float(v)) for i, v in enumerate(values)], "metric_name string, idx bigint, value double")


def test_zscore(spark):
    values = [40, 42, 41, 43, 39, 41, 40, 42, -30, 41]
    found = anomaly.zscore(metric(spark, values), 2.0).collect()
    assert [(r.value, r.anomaly_type, r.idx) for r in found] == [(-30.0, "drop", 8)]
    assert "-30.00" in found[0].message and found[0].metric_name == "m"


def test_iqr_pct_missing_rules(spark):
    assert [r.value for r in anomaly.iqr(metric(spark, [7, 8, 8, 9, 9, 10, 10, 11, -40, 11])).collect()] == [-40.0]
    changes = anomaly.pct_change(metric(spark, [50, 60, 0, 30, 31, 10, 12])).orderBy("idx").collect()
    assert [(r.idx, r.anomaly_type) for r in changes] == [(2, "drop"), (5, "drop")]  # none after 0
    nan = float("nan")
    gaps = anomaly.missing(metric(spark, [nan, 4, None, 5, 6, 7, nan, 8])).collect()
    assert [(r.anomaly_type, r.severity, r.value, r.deviation) for r in gaps] == [("missing", "high", 3.0, 37.5)]
    rule = anomaly.Rule("odd", lambda v: v % 2 == 1, "Odd: {value}", "critical")
    hits = anomaly.detect(metric(spark, [4, 6, 4, 9, 6, 4]), [rule], methods=["rules"])
    assert [(r.message, r.idx) for r in hits.collect()] == [("Odd: 9.0", 3)]
    assert anomaly.report(hits, 1).first().has_critical_anomalies


def test_stable_series_and_zero_spread(spark):
    assert anomaly.zscore(metric(spark, [6.0, 6.5, 5.5, 6.25, 5.75, 6.0, 6.1]), 3.0).count() == 0
    flat = metric(spark, [0] * 9)
    assert anomaly.detect(flat).count() == 0
    assert anomaly.alerts(anomaly.detect(flat)).count() == 0


def test_sparse_indices(spark):
    """Ids far apart are neighbours all the same, in any number of ranges."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = [3, 10**6, 10**9, 10**9 + 1, 5 * 10**12, 9 * 10**15, -(10**10), 0]
        values = {i: (100.0 if i < 10**9 else 300.0) for i in ids}
        rows = [(m, i, v) for m in ("a", "b") for i, v in values.items()]
        s = spark.createDataFrame(rows, "metric_name string, idx bigint, value double")
        assert sorted((r.metric_name, r.idx) for r in anomaly.pct_change(s).collect()) == [("a", 10**9), ("b", 10**9)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_detect_keeps_first_method(spark):
    found = anomaly.detect(metric(spark, [10] * 30 + [100] + [10] * 5)).where("idx = 30").collect()
    kinds = sorted((r.anomaly_type, r.method) for r in found)
    assert kinds == [("spike", "z-score")]  # the change at the same index is the same finding


def test_all_missing_metric(spark):
    rule = anomaly.Rule("any", lambda v: v.isNull(), "none")
    found = anomaly.detect(metric(spark, [None, None]), [rule]).collect()
    assert sorted(r.anomaly_type for r in found) == ["missing", "pattern", "pattern"]


def test_mad(spark):
    assert [r.value for r in anomaly.mad(metric(spark, [15, 16, 14, 15, 15, 17, 13, 90, 16])).collect()] == [90.0]
