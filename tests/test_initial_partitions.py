"""F4, F7, F8: shuffles of tables begin with many partitions, those of texts with the session's own."""

import __spark_entry__ as entry
from merclake.session import INITIAL


def plan(spark, sf_dir):
    return spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_of_tables_and_texts(spark):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert ", 200)" in entry._on_tables(plan)(spark, "")
        assert f", {own})" in entry._on_texts(plan)(spark, "")
    finally:
        spark.conf.unset(INITIAL)
