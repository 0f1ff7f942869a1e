"""Rows that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import pytest

from merclake.llm.common import small_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    small_batches(spark)

    def make(rows, clashing=False):
        """rows: (doc_id, text[, lang[, source]])."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:  # names that operators use themselves
            for i, name in enumerate(["key", "n", "size", "fp", "rep", "hash", "position", "kept", "score", "held_out", "bucket", "words", "token", "span"]):
                from pyspark.sql import functions as F

                df = df.withColumn(name, F.lit(i))
        return df

    return make
