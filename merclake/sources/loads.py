"""Loads of files into a ledger: target, dead letters and history change in one commit.

A run that stops anywhere before its commit has loaded nothing, so the next run loads every file once, with its dead
letters and its counts. The target is a keyed table, so known keys are told by its index.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from merclake.functions.columns import moment
from merclake.sources.keyed import Keyed, insert_new, outgrown, regrow
from merclake.sources.ledger import Change, Ledger
from merclake.sources.readers import FileSpec
from merclake.sources.writers import FILE_HISTORY, arrived_files, file_results

HISTORY_TABLE = "load_history"
#: Statuses of a load from the one that decides downwards.
RANK = ["failed", "partial", "completed", "skipped"]


def dead_letter_table(target: str) -> str:
    return f"{target}_dead_letters"


def load_files(
    ledger: Ledger, spec: FileSpec, target: Keyed, loaded_at: datetime, expected: dict[str, str] | None = None, pattern: str = "*"
) -> DataFrame:
    """Load the new files of a folder into ``target``; one result row per file, as :func:`writers.load_directory`."""
    spark, state = ledger.spark, ledger.state()
    history = ledger.read(HISTORY_TABLE, FILE_HISTORY, state).where(F.col("target_table") == target.table)
    arrived = arrived_files(spark, spec, history, loaded_at, list(target.keys), expected, pattern)
    if arrived is None:
        return spark.createDataFrame([], FILE_HISTORY)
    change, fresh = Change(), None
    if arrived.good is not None:
        rows = arrived.good
        if target.table in state.schemas:  # types are inferred per load; the table's hold
            kinds = dict(ledger.read(target.table, state=state).dtypes)
            rows = rows.select(*[F.col(c).try_cast(kinds[c]).alias(c) if kinds.get(c, t) != t else F.col(c) for c, t in rows.dtypes])
        change, fresh = insert_new(ledger, state, target, rows)
        letters = arrived.bad.select(
            "*", F.lit("date does not fit " + spec.datetime_format).alias("_error_message"), moment(loaded_at).alias("_failed_at")
        )
        change = change.also(ledger.write(dead_letter_table(target.table), letters))
    result = file_results(spark, target.table, arrived, fresh, loaded_at)
    state = ledger.commit(state, change.also(ledger.write(HISTORY_TABLE, result)))
    if outgrown(state, target):
        regrow(ledger, state, target)
    return result


def load_summary(results: DataFrame, target: str) -> DataFrame:
    """One row for the files of a load: the gravest status, rows loaded and failed, the first failed file and its reason."""
    order = F.array_position(F.array(*map(F.lit, RANK)), F.col("status"))
    broken = F.when(F.col("status") == "failed", F.col("source_file"))
    return results.agg(
        F.lit(target).alias("target_table"), F.coalesce(F.min_by("status", order), F.lit("skipped")).alias("status"), F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"), F.coalesce(F.sum("rows_failed"), F.lit(0)).alias("rows_failed"),
        F.min(broken).alias("source_file"), F.min_by("error_message", broken).alias("error_message"),
    )
