"""cleaning without needless regular expressions and strips, over all tasks, with the results of before."""

from pyspark.sql import functions as F

from merclake.operators import cleaning as c
from merclake.plans import etl

plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()


def test_same_results(spark):
    texts = ["", " ", "a", " a", "a\t", " b c　", "$1,200.50", " €5 ", "1.5f", "NaN", "$", "01/02/2024", "01-02-2024", "01-02-2024\n",
             "2024-02-01", "2024-02-01T03:04:05", "2024-02-01 03:04:05.5", "ab/", "1-/", "13/13/2024", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    stripped = df.select("i", F.btrim("t", F.lit(c.WHITE_SPACE)).alias("t")).collect()
    assert sorted(c.trim_strings(df).collect()) == sorted(stripped)
    amount = F.trim(F.regexp_replace("t", c.CURRENCY_SIGNS, ""))
    old = F.when(amount.rlike(c.AMOUNT), amount.try_cast("double"))
    assert df.where(~c.to_amount(F.col("t")).eqNullSafe(old)).count() == 0
    iso = F.regexp_replace(F.regexp_replace("t", r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2"), r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1")
    shape = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d{1,6})?|T\d{2}:\d{2}:\d{2})?$"
    assert df.where(~c.parse_timestamp(F.col("t")).eqNullSafe(F.when(iso.rlike(shape), iso.try_cast("timestamp_ntz")))).count() == 0


def test_plans(spark):
    df = spark.createDataFrame([("1", "$5")], "sku string, unit_price string")
    assert "regexp_replace" not in plan_of(c.normalize_currency(df, ["unit_price"]).where("unit_price > 0"))
    assert "RebalancePartitions" in plan_of(etl._spread(df))
