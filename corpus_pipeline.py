"""Corpus pipeline: documents pass one operator after another, each stage written and read again.

1. language_id: documents in which no language is recognised go.
2. near_duplicates: of each group of near-duplicates the document with the smallest doc_id stays.
3. repeated_strings: every byte covered by a string of 50 bytes that a document with a smaller doc_id has goes, with
   the rest of its character; n_chars follows the text. A document that loses its whole text goes.
4. decontamination: documents that overlap with a benchmark text go.
5. mixing: the training order, one row for each pass over a document.

Defined results: documents without doc_id are judged as each operator says; none of them goes as a near-duplicate. Rows
that repeat a doc_id are one document to stages 2 and 4: if one goes, all go. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm import decontam, language, mixing, near_dup, suffix_dedup
from merclake.llm.common import remainder, small_batches, store

#: Stage 2 calls its operator with the shingle length and the largest distance of that operator's query.
SHINGLE, DISTANCE = 3, 3
LENGTH = 50


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    judged = language.identify(docs, remainder("doc_id", 4) == 2, keep=docs.columns)
    return judged.where(F.col("lang_pred") != language.UNDETERMINED).select("row.*")


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(docs, SHINGLE, DISTANCE)
    gone = store(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near-duplicates")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, LENGTH, keep=docs.columns)
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    left = cut.where(~changed | (F.col("kept") != ""))
    return left.select(*[
        F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns
    ])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(mixing.mix(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", first_of_near_duplicates),
    ("repeated_strings", without_repeats),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Fingerprints and profiles are beyond SQL; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
