"""Types of text columns: found from all rows, without casts that the first rows have ruled out."""

from pyspark.sql import functions as F

from merclake.sources import readers


def test_ruled_out_by_the_first_rows(spark, monkeypatch):
    """every text was cast to every type, at the price of an exception each."""
    asked, plain = [], readers._fitting
    monkeypatch.setattr(readers, "_fitting", lambda df, kinds: asked.append(kinds) or plain(df, kinds))
    rows = spark.range(0, 1000, 1, 1).select(
        F.concat(F.lit("N-"), "id").alias("name"), F.col("id").cast("string").alias("n"),
        F.when(F.col("id") < 999, F.col("id").cast("string")).otherwise("late").alias("odd"),
        F.when(F.col("id") < 999, F.col("id").cast("string")).otherwise("1.5").alias("late_point"),
        F.lit(None).cast("string").alias("none"), F.when(F.col("id") == 999, "true").alias("last"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in readers.infer_types(rows).fields}
    assert kinds == {"name": "string", "n": "bigint", "odd": "string", "late_point": "double", "none": "string", "last": "boolean"}
    assert asked[-1]["name"] == [] and "timestamp_ntz" not in asked[-1]["n"]
