"""Rates of host endings, however many there are."""

from pyspark.sql import functions as F

from merclake.llm import urls


def test_no_ending_is_dropped(spark):
    """Only the ending tells bad hosts; those of the last names would fall to any limit on the number of endings."""
    n = 10_400
    ids = spark.range(2 * n).select((F.col("id") % n + 10_000).alias("k"), F.col("id").alias("page_id"))
    pages = ids.select("page_id", F.concat(F.lit("http://www.e"), "k", F.lit(".tld/")).alias("url"), (F.crc32(F.col("k").cast("string").cast("binary")) % 10 < 3).alias("bad"))
    got = urls.judge(pages.select("page_id", "url"), pages.select("url", "bad"), rules={}).join(pages, "page_id")
    assert got.count() == 2 * n
    assert got.where((F.col("verdict") == "block") != F.col("bad")).count() == 0


def test_rates_of_known_and_unknown_endings(spark):
    labelled = spark.createDataFrame([("http://a.b.com/", True), ("http://c.b.com/", False), ("http://d.com", False), ("http://com", True), ("http://x.", False)], "url string, bad boolean")
    trained = urls.Filter(labelled, smooth=0.0)
    frame = spark.createDataFrame([("z.b.com",), ("new.com",), ("com",), ("q.zz",), ("",)], "host string")
    got = {r["host"]: (r["top_rate"], r["ending_rate"]) for r in trained.rated(frame).collect()}
    rate = 2.5 / 6
    assert got == {"z.b.com": (0.5, 0.5), "new.com": (0.5, rate), "com": (0.5, 0.5), "q.zz": (rate, rate), "": (0.0, 0.0)}
