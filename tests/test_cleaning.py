from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merclake.operators import cleaning as cl
from merclake.operators.enrichment import hash_pii, order_time_features, url_parameters


def column(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]


def test_trim(spark):
    """Tabs and line breaks count as blanks; inner blanks and other columns stay."""
    df = spark.createDataFrame([(1, "\n a  b\t", " x "), (2, "", "y"), (3, None, "  ")], "i int, note string, code string")
    assert column(cl.trim_strings(df), "note", "i") == ["a  b", "", None]
    assert column(cl.trim_strings(df), "code", "i") == ["x", "y", ""]
    assert column(cl.trim_strings(df, ["code"]), "note", "i") == ["\n a  b\t", "", None]


def test_duplicates_keep_first_by_order(spark):
    rows = [("k7", 3, "late"), ("k7", 1, "early"), ("k2", 5, "only"), (None, 9, "u"), (None, 8, "v"), ("k7", 2, "mid")]
    df = spark.createDataFrame(rows, "k string, seq int, what string")
    first = {(r.k, r.what) for r in cl.remove_duplicates(df, ["k"], [F.col("seq")]).collect()}
    assert first == {("k7", "early"), ("k2", "only"), (None, "v")}
    newest = {(r.k, r.what) for r in cl.remove_duplicates(df, ["k"], [-F.col("seq")]).collect()}
    assert newest == {("k7", "late"), ("k2", "only"), (None, "u")}
    assert cl.remove_duplicates(df.unionByName(df).unionByName(df)).count() == 6


def test_fill_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 7.5, None), (3, None, None)], "i int, rate double, tag string")
    out = cl.fill_nulls(df, {"rate": -1.0, "tag": "none", "absent": 1})
    assert column(out, "rate", "i") == [-1.0, 7.5, -1.0] and column(out, "tag", "i") == ["a", "none", "none"]


def test_title_case(spark):
    df = spark.createDataFrame([("o'BRIEN mary-jane",), ("éMILE 2nd",)], "n string")
    assert column(cl.normalize_case(df, ["n"], "title"), "n") == ["O'Brien Mary-Jane", "Émile 2nd"]
    with pytest.raises(ValueError):
        cl.normalize_case(df, ["n"], "camel")


def test_dates_of_all_formats(spark):
    texts = ["2025-01-02 03:04:05", "2025-01-02", "01/02/2025", "02-01-2025", "2025-01-02T03:04:05", "2025-01-02 03:04:05.25", "junk", None, "2025-13-02"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    day, second = datetime(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5)
    expected = [second, day, day, day, second, second.replace(microsecond=250000), None, None, None]
    assert column(cl.standardize_dates(df, ["d"]), "d", "i") == expected
    assert column(cl.standardize_dates(df, ["d"], ["MM/dd/yyyy"]), "d", "i")[2] == day


def test_currency_email_phone(spark):
    df = spark.createDataFrame(
        [("$1,234.50", " A@B.Com ", "+1 (555) 010-9"), ("€ 7", "no mail", "none"), ("n/a", None, None)],
        "amount string, email string, phone string",
    )
    assert column(cl.normalize_currency(df, ["amount"]), "amount") == [1234.5, 7.0, None]
    assert column(cl.clean_email(df), "email") == ["a@b.com", None, None]
    assert column(cl.clean_phone(df), "phone") == ["15550109", "", None]


def test_amounts_by_shape(spark):
    texts = ["12", "-0.5", ".5", "5.", "1e3", "1.5d", "2f", "NaN", "Infinity", "-inf", "0x10", "1 2", "", "1.2.3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    assert column(cl.normalize_currency(df, ["a"]), "a", "i") == [12.0, -0.5, 0.5, 5.0, 1000.0] + [None] * 9


def test_clean_orders(orders):
    refund = orders.limit(1).withColumn("order_number", F.lit("N-599")).withColumn("total_amount", F.lit(-0.01))
    out = cl.clean_orders(orders.unionByName(orders).unionByName(refund))
    assert sorted(column(out, "order_number")) == ["N-501", "N-502", "N-503"]
    assert set(orders.columns) <= set(out.columns) and dict(out.dtypes)["order_timestamp"] == "timestamp_ntz"


@pytest.mark.parametrize("kind", ["orders", "customers", "products", "generic"])
def test_clean_by_type(kind, orders, customers, products):
    frame = {"orders": orders, "customers": customers, "products": products, "generic": orders}[kind]
    assert cl.clean_dataframe(frame, kind).count() == 3


def test_time_features(orders):
    guest = orders.where("customer_id IS NULL").withColumn("order_id", F.lit(504).cast("bigint")).withColumn("order_timestamp", F.lit("2024-03-11 08:00:00"))
    out = order_time_features(cl.standardize_dates(orders.unionByName(guest), ["order_timestamp"])).orderBy("order_id").collect()
    assert [r.order_day_of_week for r in out] == [4, 6, 7, 1]  # Thursday, Saturday, Sunday, Monday
    assert [r.customer_order_sequence for r in out] == [1, 2, 1, 2]  # guests are ranked together
    assert [r.is_first_order for r in out] == [True, False, True, False]
    assert [(r.order_hour, r.order_month, r.order_quarter) for r in out] == [(23, 2, 1), (0, 3, 1), (12, 3, 1), (8, 3, 1)]
    assert [r.is_weekend_order for r in out] == [False, True, True, False]


def test_weekend_of_friday(spark):
    df = spark.createDataFrame([("2025-01-03 00:00:00",)], "order_timestamp string")
    df = cl.standardize_dates(df, ["order_timestamp"])
    assert not order_time_features(df).first().is_weekend_order
    assert order_time_features(df, legacy_weekend=True).first().is_weekend_order


def test_outliers(spark):
    values = [20.0, 21.0, 21.5, 22.0, 22.0, 23.0, 24.0, -60.0, 95.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert sorted(column(cl.detect_outliers(df, "v").where("_is_outlier"), "v")) == [-60.0, 95.0]
    clipped = column(cl.handle_outliers(df, "v", "clip", interpolation="linear"), "v")
    assert min(v for v in clipped if v is not None) == 21.0 - 1.5 * 2.0 and max(v for v in clipped if v is not None) == 23.0 + 1.5 * 2.0
    assert clipped.count(None) == 1
    assert max(v for v in column(cl.handle_outliers(df, "v", "clip", lower=0, upper=9), "v") if v is not None) == 9.0
    assert sorted(column(cl.handle_outliers(df.na.drop(), "v", "remove"), "v")) == sorted(values)[1:-1]
    assert column(cl.handle_outliers(df, "v", "replace"), "v").count(22.0) == 4  # the median, twice
    assert column(cl.handle_outliers(df, "v", "replace", replacement_value=-1.0), "v").count(-1.0) == 2
    assert column(cl.detect_outliers(df, "v", "zscore", 2.0).where("_is_outlier"), "v") == [-60.0]
    empty = df.where("v IS NULL")
    assert column(cl.handle_outliers(empty, "v", "replace"), "v") == [None]


def test_hash_pii(spark):
    df = spark.createDataFrame([("ines.prado@post.example",), ("abcd",), ("",), (None,)], "email string")
    out = hash_pii(df, ["email", "absent"], salt="s").collect()
    assert [r.email_masked for r in out] == ["in***le", "***", "***", None]
    assert [r.email_hash is None for r in out] == [False, False, True, True]
    assert hash_pii(df, ["email"], drop_raw=True).columns == ["email_hash", "email_masked"]


def test_url_parameters(spark):
    df = spark.createDataFrame([("https://a.b/c?utm_source=x&utm_medium=y#f", "http://ref.org/z")], "page_url string, r string")
    row = url_parameters(df, referrer_col="r").first()
    assert (row.utm_source, row.utm_medium, row.utm_campaign, row.referrer_domain) == ("x", "y", None, "ref.org")


def test_custom_rule(spark):
    rules = cl.CleaningRules()
    rules.register("positive", lambda df: df.where("v > 0"))
    df = spark.createDataFrame([(-1,), (1,)], "v int")
    assert rules.apply(df, ["positive"]).count() == 1
