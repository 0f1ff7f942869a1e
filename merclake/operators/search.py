"""Name search by trigrams: postings of three-letter pieces are intersected, and what is left is verified.

A text that contains another one contains all its trigrams. The index has a row per trigram and id, in folders by a hash
of the trigram; the rows it was built from lie in folders by a hash of the id. A search reads the folders of its own
trigrams, and of the rows the folders that hold candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merclake.operators.lookups import name_contains
from merclake.session import materialize

GRAM = 3
#: Grams of one search that are looked up; any of them bound the candidates, all are verified.
_ASKED = 16


def trigrams(text: Column) -> Column:
    """The different pieces of three characters of a text in lower case."""
    low = F.lower(text)
    starts = F.when(F.char_length(low) >= GRAM, F.sequence(F.lit(1), F.char_length(low) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(low, i, F.lit(GRAM))))


def _part(col: str | Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(parts)).cast("int")


def write_name_index(rows: DataFrame, path: str, id_col: str, name_col: str, parts: int = 64) -> None:
    """Store the rows and the postings of their names under ``path``. A piece that stands in very many names is spread by
    a hash of the id, so no task and no file holds all of its postings."""
    postings = rows.select(F.col(id_col).alias("id"), F.explode(trigrams(F.col(name_col))).alias("gram"))
    placed = postings.withColumn("part", _part("gram", parts))
    placed.repartition("part", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("part", "gram", "id").write.partitionBy("part").parquet(f"{path}/postings")
    rows.withColumn("part", _part(id_col, parts)).repartition("part").write.partitionBy("part").parquet(f"{path}/rows")
    rows.sparkSession.createDataFrame([(id_col, name_col, parts)], "id_col string, name_col string, parts int").coalesce(1).write.parquet(f"{path}/about")


def candidates(spark: SparkSession, path: str, text: str, parts: int) -> DataFrame:
    """``id`` of the rows whose name has all (of the first some) trigrams of the text."""
    grams = list(dict.fromkeys(text.lower()[i : i + GRAM] for i in range(len(text) - GRAM + 1)))[:_ASKED]
    found = spark.createDataFrame([(g,) for g in grams], "gram string").select("gram", _part("gram", parts).alias("part"))
    wanted = sorted({r["part"] for r in found.collect()})  # as many as the text has trigrams
    postings = spark.read.parquet(f"{path}/postings").where(F.col("part").isin(wanted) & F.col("gram").isin(grams))
    return postings.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("id")


def search_names(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The stored rows whose name contains the text, whatever the case. Texts of less than three characters have no
    trigram and are looked for in all rows."""
    about = spark.read.parquet(f"{path}/about").first()
    rows = spark.read.parquet(f"{path}/rows")
    if len(text) >= GRAM:
        ids = materialize(candidates(spark, path, text, about["parts"]))
        held = [r["part"] for r in ids.select(_part("id", about["parts"]).alias("part")).distinct().collect()]  # at most all parts
        rows = rows.where(F.col("part").isin(held) if held else F.lit(False)).join(ids.select(F.col("id").alias(about["id_col"])), about["id_col"], "left_semi")
    return rows.where(name_contains(about["name_col"], text)).drop("part")
