"""Rank search and row-to-row helpers against brute force, skewed keys included."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from merclake.functions import sequence as sq
from merclake.functions.columns import exact_sum, hour_bucket, wide_sum
from merclake.functions.ranks import exact_quantiles, smallest_share

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def nearest(values, p):
    return sorted(values)[int(np.floor(p * (len(values) - 1) + 0.5))]


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [1.0, 1.0, 1.0, 2.0], [-3.5, 0.0, 0.0, 2.5, 1e300, -1e300], list(np.linspace(48.1, 48.1001, 500)),
        [7.0] * 400 + list(np.random.default_rng(1).lognormal(3, 2, 600)), [1e-310, 5e-324, 0.0, -5e-324],
    ],
)
def test_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    row = exact_quantiles(df, "v", PROBS).first()
    assert row.n == len(values)
    assert row.q == pytest.approx(list(np.percentile(values, [100 * p for p in PROBS])), rel=1e-12, abs=1e-300)
    assert exact_quantiles(df, "v", PROBS, interpolation="nearest").first().q == [nearest(values, p) for p in PROBS]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=60))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, "v", [0.3, 0.8], interpolation="nearest").first().q == [nearest(values, 0.3), nearest(values, 0.8)]


def test_quantiles_by_group(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000, p=[0.9, 0.09, 0.01]), "v": np.round(rng.normal(0, 50, 3000), 1)})
    out = exact_quantiles(spark.createDataFrame(pdf), "v", [0.25, 0.75], by=["g"], few_groups=True)
    for r in out.collect():
        assert r.q == pytest.approx(list(np.percentile(pdf.v[pdf.g == r.g], [25, 75])))


def test_smallest_share(spark):
    df = spark.range(1000).select("id", F.xxhash64("id").cast("double").alias("u"))
    cut = smallest_share(df, "u", 0.2, []).first()
    assert df.where(F.col("u") <= cut.cut).count() == 200


@pytest.fixture(scope="module")
def visits(spark):
    """One visitor holds most rows; many rows share a time."""
    rng = np.random.default_rng(3)
    n = 4000
    pdf = pd.DataFrame({
        "who": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n)),
        "at": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 5 * 86400, n), unit="s"),
        "id": np.arange(n),
    })
    pdf["mark"] = np.where(rng.random(n) < 0.3, pdf.id.astype(str), None)
    return pdf.sort_values(["who", "at", "id"]).reset_index(drop=True)


def test_previous(spark, visits):
    df = spark.createDataFrame(visits).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sq.with_previous(df, ["who"], ["at", "id"], {"before": "id"}, hour_bucket("at")).toPandas()
    want = visits.assign(before=visits.groupby("who").id.shift(1))
    both = got.merge(want, on="id")
    assert len(both) == len(visits) and (both.before_x.fillna(-1) == both.before_y.fillna(-1)).all()


def test_running_last(spark, visits):
    df = spark.createDataFrame(visits).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sq.with_running_last(df, ["who"], ["at", "id"], "mark", "seen", hour_bucket("at")).toPandas()
    want = visits.assign(seen=visits.groupby("who").mark.ffill())
    both = got.merge(want, on="id")
    assert (both.seen_x.fillna("-") == both.seen_y.fillna("-")).all()


def test_run_start(spark, visits):
    pdf = visits.assign(at=visits["at"].dt.floor("10min"))  # many ties
    df = spark.createDataFrame(pdf).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sq.with_run_start(df, ["who"], ["at", "id"], "at", F.expr("INTERVAL 30 MINUTES"), "start", hour_bucket("at")).toPandas()
    gap = pdf.groupby("who")["at"].diff()
    opened = pdf["at"].where(gap.isna() | (gap > pd.Timedelta(minutes=30)))
    want = pdf.assign(start=opened.groupby(pdf.who).ffill())
    both = got.merge(want, on="id")
    assert len(both) == len(pdf) and (both.start_x == both.start_y).all()


def test_dense_rank(spark, visits):
    pdf = visits.assign(at=visits["at"].dt.floor("6h"))
    df = spark.createDataFrame(pdf).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sq.with_dense_rank(df, ["who"], "at", "r", hour_bucket("at")).toPandas()
    want = pdf.assign(r=pdf.groupby("who")["at"].rank("dense").astype(int))
    both = got.merge(want, on="id")
    assert (both.r_x == both.r_y).all()


def test_null_keys_and_times(spark):
    """Rows without a key are one group; rows without a time come first."""
    day, later = datetime(2024, 1, 1), datetime(2024, 1, 2, 6)
    rows = [(1, None, day), (2, None, later), (3, None, later), (4, "k", None), (5, "k", day), (6, None, None)]
    df = spark.createDataFrame(rows, "id long, who string, at timestamp_ntz")
    by = lambda out, c: {r["id"]: r[c] for r in out.collect()}
    assert by(sq.with_previous(df, ["who"], ["at", "id"], {"b": "id"}, hour_bucket("at")), "b") == {1: 6, 2: 1, 3: 2, 4: None, 5: 4, 6: None}
    assert by(sq.with_dense_rank(df, ["who"], "at", "r", hour_bucket("at")), "r") == {1: 1, 2: 2, 3: 2, 4: None, 5: 1, 6: None}
    assert by(sq.with_running_last(df, ["who"], ["at", "id"], "id", "l", hour_bucket("at")), "l") == {i: i for i in range(1, 7)}
    assert by(sq.with_position(df, ["at", "id"], "n"), "n") == {4: 0, 6: 1, 1: 2, 5: 3, 2: 4, 3: 5}


def test_position(spark, visits):
    df = spark.createDataFrame(visits).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sq.with_position(df, ["at", "id"], "n").toPandas().sort_values("n")
    want = visits.sort_values(["at", "id"])
    assert list(got.id) == list(want.id) and list(got.n) == list(range(len(visits)))


def test_dense_index(spark):
    df = spark.createDataFrame([(f"k{i * 7}",) for i in range(3000)], "k string")
    got = sq.with_dense_index(df, "k", "idx", buckets=16).toPandas()
    assert sorted(got.idx) == list(range(3000))


def test_first_per_key_is_repeatable(spark):
    rows = [(1, "b", 2.0), (1, "a", 1.0), (None, "x", 0.0), (None, "y", 0.0), (2, "c", None)]
    df = spark.createDataFrame(rows, "k int, v string, x double")
    first = {(r.k, r.v) for r in sq.first_per_key(df, ["k"], [F.col("x")]).collect()}
    again = {(r.k, r.v) for r in sq.first_per_key(df.repartition(7), ["k"], [F.col("x")]).collect()}
    assert first == again and {(1, "a"), (2, "c")} <= first and len(first) == 3


def test_sums_beyond_bigint(spark):
    big = 2**62 - 3
    df = spark.createDataFrame([(big,), (big,), (big,), (-7,), (None,)], "v bigint")
    assert int(df.agg(wide_sum(F.col("v")).alias("s")).first().s) == 3 * big - 7
    cents = spark.createDataFrame([(0.1,)] * 10 + [(-0.3,)], "v double")
    assert cents.agg(exact_sum("v").alias("s")).first().s == 0.7
    assert cents.where("v > 5").agg(exact_sum("v").alias("s")).first().s is None
