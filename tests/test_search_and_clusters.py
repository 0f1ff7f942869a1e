"""Name search by trigrams and tables clustered by several columns: the same rows, from fewer files."""

import random

import pytest
from pyspark.sql import functions as F

from merclake.operators import search
from merclake.sources import clustered


def files_of(df):
    return len(df.inputFiles())


def test_search(spark, tmp_path):
    rng = random.Random(4)
    words = ["Läufer", "ring", "RINGER", "string", "spring 50%", "a_b", "drill", "grind", "ri ng", "İstanbul"]
    rows = [(i, " ".join(rng.sample(words, 3))) for i in range(300)] + [(900, None), (901, ""), (902, "ab"), (903, "zzqx unique")]
    df = spark.createDataFrame(rows, "id long, title string")
    search.write_name_index(df, f"{tmp_path}/x", "id", "title", parts=16)
    for text in ("ring", "RING", "läuf", "g 50%", "a_b", "ab", "%", "unique", "ringring", "nothing like it", "string spring 50% grinder and more than sixteen pieces"):
        want = {i for i, t in rows if t is not None and text.lower() in t.lower()}
        assert {r.id for r in search.search_names(spark, f"{tmp_path}/x", text).collect()} == want, text
    one = search.search_names(spark, f"{tmp_path}/x", "unique")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    postings = search.candidates(spark, f"{tmp_path}/x", "zzqx", 16)
    assert postings.count() == 1


def test_trigrams(spark):
    df = spark.createDataFrame([("AbCd",), ("ab",), ("aaaa",), (None,)], "t string").select(search.trigrams(F.col("t")).alias("g"))
    assert [r.g for r in df.collect()] == [["abc", "bcd"], [], ["aaa"], []]


def test_clustered_reads_few_files(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 999) if rng.random() > 0.02 else None, rng.random() * 1000, f"2025-01-{rng.randint(1, 28):02d}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, customer int, amount double, day string").withColumn("day", F.to_date("day"))
    clustered.write_clustered(df, f"{tmp_path}/t", ["customer", "amount", "day"], files=64)
    everything = spark.read.parquet(f"{tmp_path}/t/rows")
    assert everything.count() == 20_000 and files_of(everything) == 64
    for bounds in ({"customer": (100, 110)}, {"amount": (None, 15.0)}, {"day": (F.to_date(F.lit("2025-01-03")), F.to_date(F.lit("2025-01-03")))}, {"customer": (500, 520), "amount": (100.0, 120.0)}):
        got = clustered.read_between(spark, f"{tmp_path}/t", bounds)
        tests = [(F.col(c) >= lo if lo is not None else F.lit(True)) & (F.col(c) <= hi if hi is not None else F.lit(True)) for c, (lo, hi) in bounds.items()]
        want = df
        for test in tests:
            want = want.where(test)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
        assert files_of(got) <= 32, bounds  # 64 files are four slices of each column; a value at an edge lies in two
    assert clustered.read_between(spark, f"{tmp_path}/t", {"amount": (5000.0, None)}).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 5), (2, 5)]])
def test_clustered_odd_tables(spark, tmp_path, rows):
    clustered.write_clustered(spark.createDataFrame(rows, "id int, n int"), f"{tmp_path}/t", ["n", "id"])
    got = clustered.read_between(spark, f"{tmp_path}/t", {"n": (5, 5)})
    assert sorted(r.id for r in got.collect()) == [i for i, n in rows if n == 5]


def test_zorder_interleaves(spark):
    df = spark.range(1).select(clustered.zorder([F.lit(0b101), F.lit(0b011)]).alias("z"))
    assert df.first().z == 0b100111
