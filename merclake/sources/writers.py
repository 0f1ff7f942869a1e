"""Load steps and sinks: schema check, dead letters, insert-ignore, upsert, history, audit.

Tables are Parquet folders. A table is never overwritten while it is read: new rows are
appended, and replaced partitions go through dynamic partition overwrite.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from merclake.functions.columns import moment
from merclake.functions.sequence import first_per_key
from merclake.session import materialize
from merclake.sources.readers import FileSpec, file_fingerprints, read_directory, read_file

# Type names of other tools and the Spark type names they stand for.
TYPE_NAMES = {
    "utf8": ["string"], "str": ["string"], "string": ["string"], "object": ["string"],
    "int": ["tinyint", "smallint", "int", "bigint"], "int32": ["int"], "int64": ["bigint"],
    "float": ["float", "double"], "float64": ["double"], "float32": ["float"],
    "bool": ["boolean"], "boolean": ["boolean"], "date": ["date"],
    "datetime": ["timestamp", "timestamp_ntz"],
}

HISTORY = (
    "load_id string, source_file string, target_table string, status string, rows_loaded bigint, "
    "rows_failed bigint, error_message string, file_hash string, started_at timestamp_ntz, completed_at timestamp_ntz"
)


def validate_schema(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Messages for missing columns and unfitting types. Reads no data."""
    actual = dict(df.dtypes)
    errors = []
    for column, kind in expected.items():
        if column not in actual:
            errors.append(f"Missing column: {column}")
            continue
        fits = TYPE_NAMES.get(kind.lower(), [])
        if actual[column] not in fits and kind.lower() not in actual[column]:
            errors.append(f"Column {column}: expected {kind}, got {actual[column]}")
    return errors


def parse_date_columns(df: DataFrame, columns: list[str], fmt: str) -> DataFrame:
    """Strict: a text that does not fit fails the job."""
    return df.withColumns({c: F.to_timestamp(F.col(c), fmt) for c in columns if c in df.columns})


def dates_fit(df: DataFrame, columns: list[str], fmt: str) -> Column:
    """Whether every date text of a row parses or is NULL."""
    fits = [F.col(c).isNull() | F.try_to_timestamp(F.col(c), F.lit(fmt)).isNotNull() for c in columns if c in df.columns]
    return reduce(lambda a, b: a & b, fits, F.lit(True))


def split_bad_dates(df: DataFrame, columns: list[str], fmt: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose dates parse, with the dates; the other rows as they came)."""
    good = dates_fit(df, columns, fmt)
    return parse_date_columns(df.where(good), columns, fmt), df.where(~good)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def add_load_metadata(df: DataFrame, loaded_at: datetime, source_file: str | None = None) -> DataFrame:
    """``_source_file`` (given, or that of the scanned file) and ``_loaded_at``."""
    origin = F.lit(source_file) if source_file else F.col("_metadata.file_path")
    return df.select("*", origin.alias("_source_file"), moment(loaded_at).alias("_loaded_at"))


def filter_incremental(df: DataFrame, column: str, last) -> DataFrame:
    """Rows above the last high-water mark (all rows when there is none). The mark is a literal
    of the column's own type, so that it reaches the scan."""
    if last is None:
        return df
    naive = isinstance(last, datetime) and dict(df.dtypes)[column] == "timestamp_ntz"
    return df.where(F.col(column) > (moment(last) if naive else F.lit(last)))


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("high_water_mark"))


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """The batch rows to append: one per key, none whose key the target has."""
    return first_per_key(batch, keys, order_by or []).join(target.select(*keys), keys, "left_anti")


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], update_columns: list[str], newest: str | None = None
) -> DataFrame:
    """The target after the batch: known keys get ``update_columns`` from the batch's newest
    row, unknown keys are inserted. One full outer join, no sort of a key's rows."""
    rest = [c for c in batch.columns if c not in keys]
    order = F.struct(*([F.col(newest)] if newest else []), F.xxhash64(*rest))
    last = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_new"))
    joined = target.withColumn("_old", F.lit(True)).join(last, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c not in rest:
            out.append(F.col(c))
        elif c in update_columns:
            out.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c))
    return joined.select(*out)


def upsert_partitions(
    path: str, batch: DataFrame, keys: list[str], update_columns: list[str], partition: str, newest: str | None = None
) -> int:
    """Upsert into a stored table that is partitioned by ``partition``, a column that never changes for a key (the day
    of an order, say). Only partitions that the batch names are read and rewritten; the merged rows are set aside
    before they replace anything. Returns the number of partitions rewritten."""
    spark = batch.sparkSession
    touched = [r[0] for r in batch.select(partition).distinct().collect()]  # partition names, not rows
    stored = read_table(spark, path, batch.schema)
    stored = stored.where(F.col(partition).isin([t for t in touched if t is not None]) | F.col(partition).isNull())
    merged = materialize(upsert(stored.select(*batch.columns), batch, keys, update_columns, newest))
    replace_partitions(merged, path, [partition])
    return len(touched)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_dead_letter(df: DataFrame, path: str, error: str, failed_at: datetime) -> None:
    df.select("*", F.lit(error).alias("_error_message"), moment(failed_at).alias("_failed_at")).write.mode(
        "append"
    ).parquet(path)


def write_curated(
    df: DataFrame, root: str, name: str, stamp: datetime, partition_by: list[str] | None = None
) -> str:
    """A new Parquet folder ``name_<stamp>``, partitioned as asked."""
    path = f"{root}/{name}_{stamp.strftime('%Y%m%d_%H%M%S')}.parquet"
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table's rows, or an empty frame while its folder does not exist. Any other trouble is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema).where(F.lit(False))  # known to be empty when a plan is made


def append_history(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(path)


def unseen_files(fingerprints: DataFrame, history: DataFrame) -> DataFrame:
    """Files whose content no completed load has brought in."""
    done = history.where(F.col("status").isin("completed", "partial")).select("file_hash")
    return fingerprints.join(done, "file_hash", "left_anti")


def folder_digest(fingerprints: DataFrame) -> DataFrame:
    """One row ``h``: the hash of a single file, else a digest of the files' hashes that does
    not depend on their order and combines on the map side."""
    many = F.md5(F.concat_ws(
        "-", F.count(F.lit(1)).cast("string"), F.sum("length").cast("string"),
        F.bit_xor(F.xxhash64("file_hash")).cast("string"), F.sum(F.crc32("file_hash")).cast("string"),
    ))
    return fingerprints.agg(F.when(F.count(F.lit(1)) == 1, F.max("file_hash")).otherwise(many).alias("h"))


def load_batch(
    spark: SparkSession, spec: FileSpec, target_path: str, history_path: str, dead_letter_path: str,
    loaded_at: datetime, keys: list[str], expected: dict[str, str] | None = None,
) -> DataFrame:
    """Load one file or folder and return the one-row result (columns of the load history and
    ``load_duration_seconds``).

    Rows with an unreadable date go to the dead letters; known keys are skipped; content that
    was loaded before gives status ``skipped``. Rows are counted while they are written."""
    started = time.monotonic()
    load_id = uuid.uuid4().hex
    hashed = folder_digest(file_fingerprints(spark, spec.path))
    status, loaded, failed, error, digest = "completed", 0, 0, None, None
    try:
        digest = hashed.first()["h"]
        history = read_table(spark, history_path, HISTORY)
        seen = history.where((F.col("file_hash") == digest) & F.col("status").isin("completed", "partial"))
        if seen.limit(1).count():
            status = "skipped"
        else:
            raw = read_file(spark, spec)
            errors = validate_schema(raw, expected or {})
            if errors:
                raise ValueError("schema validation failed: " + "; ".join(errors))
            # one pass reads, types and judges the rows; good and bad ones are then taken from what it stored
            staged = materialize(drop_all_null_rows(raw).withColumn("_fits", dates_fit(raw, spec.date_columns, spec.datetime_format)))
            good = parse_date_columns(staged.where("_fits").drop("_fits"), spec.date_columns, spec.datetime_format)
            bad = staged.where("NOT _fits").drop("_fits")
            rows = add_load_metadata(good, loaded_at, spec.path)
            fresh = insert_ignore(read_table(spark, target_path, rows.schema), rows, keys)
            wrote, rejected = Observation(f"loaded-{load_id}"), Observation(f"failed-{load_id}")
            fresh.observe(wrote, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(target_path)
            loaded = wrote.get["n"]
            bad_rows = bad.observe(rejected, F.count(F.lit(1)).alias("n"))
            write_dead_letter(bad_rows, dead_letter_path, "date does not fit " + spec.datetime_format, loaded_at)
            failed = rejected.get["n"]
            status = "partial" if failed else "completed"
    except Exception as problem:  # the result row carries the failure, as the audit table needs it
        status, error = "failed", str(problem).splitlines()[0]
    ended = datetime.fromtimestamp(loaded_at.timestamp() + (time.monotonic() - started))
    target = target_path.rstrip("/").rsplit("/", 1)[-1]
    row = (load_id, spec.path, target, status, loaded, failed, error, digest, loaded_at, ended)
    append_history(spark, history_path, [row])
    return spark.createDataFrame([row], HISTORY).withColumn(
        "load_duration_seconds", F.lit(round(time.monotonic() - started, 3))
    )


def new_files(spark: SparkSession, path: str, history: DataFrame, pattern: str = "*") -> list[str]:
    """Files of a folder that no completed load names, or that were changed after it. Only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    listed = files.select(F.col("_metadata.file_path").alias("source_file"), "modificationTime")
    done = history.where(F.col("status").isin("completed", "partial", "skipped")).groupBy("source_file").agg(
        F.max("file_time").alias("file_time")
    )
    fresh = listed.join(done, "source_file", "left").where(
        F.col("file_time").isNull() | (F.col("modificationTime").cast("timestamp_ntz") > F.col("file_time"))
    )
    return sorted(r["source_file"] for r in fresh.select("source_file").collect())  # names of the files to read


FILE_HISTORY = HISTORY + ", file_time timestamp_ntz"


def _file_groups(spark: SparkSession, spec: FileSpec, paths: list[str]) -> dict[str, list[str]]:
    """Files that can be read together: delimited ones by their header line (empty files under an empty one)."""
    if spec.format != "csv":
        return {spec.format: paths}
    lines = spark.read.option("encoding", spec.encoding).text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_top"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = lines.where("_top").groupBy("_file").agg(F.min_by("value", "_line").alias("header"))
    found = {r["_file"]: r["header"] for r in first.collect()}  # a line of each new file
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(found.get(path, ""), []).append(path)
    return groups


def stage_files(
    spark: SparkSession, spec: FileSpec, paths: list[str], expected: dict[str, str] | None = None, required: list[str] | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """Read, type and judge files: their rows with ``_fits`` (whether the dates parse) and ``_source_file``, set aside,
    and the files that cannot be loaded with the reason. Good files are read in one pass; where that fails, halves of
    the list are tried, so a bad file among n costs some log n further attempts and no other file its load."""
    staged: list[DataFrame] = []
    failures: dict[str, str] = {}

    def fail(some: list[str], reason: str) -> None:
        failures.update(dict.fromkeys(some, reason))

    def attempt(some: list[str]) -> None:
        options = {"sep": spec.delimiter, "encoding": spec.encoding} if spec.format == "csv" else {}
        try:
            raw = read_directory(spark, some, spec.format, schema=spec.schema, null_values=spec.null_values, **options)
            errors = [f"Missing column: {c}" for c in required or [] if c not in raw.columns] + validate_schema(raw, expected or {})
            if errors and spec.format == "csv":  # the files of a group have one header
                fail(some, "schema validation failed: " + "; ".join(errors))
                return
            if errors:
                raise ValueError("schema validation failed: " + "; ".join(errors))
            kept = raw.na.drop("all", subset=[c for c in raw.columns if c != "_source_file"])
            staged.append(materialize(kept.withColumn("_fits", dates_fit(kept, spec.date_columns, spec.datetime_format))))
        except Exception as problem:  # the file's result row carries the failure; the next run tries the file again
            if len(some) == 1:
                fail(some, str(problem).strip().splitlines()[0])
            else:
                attempt(some[: len(some) // 2])
                attempt(some[len(some) // 2 :])

    for header, some in _file_groups(spark, spec, paths).items():
        if header:
            attempt(some)
        else:
            fail(some, "the file is empty")
    union = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return (reduce(union, staged) if staged else None), failures


@dataclass
class Arrived:
    """New files of a folder: ``prints`` with a row per file, rows that fit and rows that do not, files read and failed."""

    prints: DataFrame
    good: DataFrame | None
    bad: DataFrame | None
    read: list[str]
    failures: dict[str, str]


def arrived_files(
    spark: SparkSession, spec: FileSpec, history: DataFrame, loaded_at: datetime, keys: list[str],
    expected: dict[str, str] | None = None, pattern: str = "*",
) -> Arrived | None:
    """Read the files that the history does not name; None without any. Content that was loaded under another name, or
    that two of them share, is read once."""
    paths = new_files(spark, spec.path, history, pattern)
    if not paths:
        return None
    stamp = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("modificationTime").cast("timestamp_ntz").alias("file_time")
    )
    prints = materialize(file_fingerprints(spark, paths).join(stamp, "path"))
    unseen = unseen_files(prints, history).groupBy("file_hash").agg(F.min("path").alias("path"))
    chosen = sorted(r["path"] for r in unseen.select("path").collect())
    staged, failures = stage_files(spark, spec, chosen, expected, [*keys, *spec.date_columns]) if chosen else (None, {})
    if staged is None:
        return Arrived(prints, None, None, chosen, failures)
    good = parse_date_columns(staged.where("_fits").drop("_fits"), spec.date_columns, spec.datetime_format)
    return Arrived(prints, good.withColumn("_loaded_at", moment(loaded_at)), staged.where("NOT _fits").drop("_fits"), chosen, failures)


def file_results(spark: SparkSession, target: str, arrived: Arrived, fresh: DataFrame | None, loaded_at: datetime) -> DataFrame:
    """One history row per file, set aside."""
    counts = spark.createDataFrame([], "source_file string, rows_loaded bigint, rows_failed bigint")
    if fresh is not None:
        per_file = lambda df, name: df.groupBy(F.col("_source_file").alias("source_file")).agg(F.count(F.lit(1)).alias(name))
        counts = per_file(fresh, "rows_loaded").join(per_file(arrived.bad, "rows_failed"), "source_file", "full_outer")
    loaded, failed = F.coalesce("rows_loaded", F.lit(0)), F.coalesce("rows_failed", F.lit(0))
    tried = [(p, arrived.failures.get(p)) for p in arrived.read]
    result = arrived.prints.withColumnRenamed("path", "source_file").join(counts, "source_file", "left").join(
        spark.createDataFrame(tried, "_read string, _error string"), F.col("source_file") == F.col("_read"), "left"
    )
    status = (
        F.when(F.col("_read").isNull(), "skipped").when(F.col("_error").isNotNull(), "failed")
        .when(failed > 0, "partial").otherwise("completed")
    )
    return materialize(result.select(
        F.lit(uuid.uuid4().hex).alias("load_id"), "source_file", F.lit(target).alias("target_table"), status.alias("status"),
        loaded.alias("rows_loaded"), failed.alias("rows_failed"), F.col("_error").alias("error_message"),
        "file_hash", moment(loaded_at).alias("started_at"), moment(loaded_at).alias("completed_at"), "file_time",
    ))


def load_directory(
    spark: SparkSession, spec: FileSpec, target_path: str, history_path: str, dead_letter_path: str,
    loaded_at: datetime, keys: list[str], expected: dict[str, str] | None = None, pattern: str = "*",
) -> DataFrame:
    """Load the new files of a folder and return one result row per file, which is also added to the history.

    Files that the history names and that have not changed since are neither hashed nor read. Of the others, content
    that was loaded under another name, or that two of them share, is skipped. Rows with an unreadable
    date go to the dead letters, known keys are skipped. A file that cannot be read, or lacks a column, fails alone and
    is tried again by the next run. For loads whose tables change together see :mod:`merclake.sources.loads`."""
    history = read_table(spark, history_path, FILE_HISTORY)
    arrived = arrived_files(spark, spec, history, loaded_at, keys, expected, pattern)
    if arrived is None:
        return spark.createDataFrame([], FILE_HISTORY)
    fresh = None
    if arrived.good is not None:
        fresh = materialize(insert_ignore(read_table(spark, target_path, arrived.good.schema), arrived.good, keys))
        fresh.write.mode("append").parquet(target_path)
        write_dead_letter(arrived.bad, dead_letter_path, "date does not fit " + spec.datetime_format, loaded_at)
    result = file_results(spark, target_path.rstrip("/").rsplit("/", 1)[-1], arrived, fresh, loaded_at)
    result.write.mode("append").parquet(history_path)
    return result


def apply_scd2(
    current: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str], effective: datetime
) -> DataFrame:
    """The dimension after the changes: a row whose tracked columns differ is closed at
    ``effective`` and a new version opened; new keys are opened; all else is kept. Closed
    versions are passed through. ``changes`` has one row per key with the columns of
    ``current`` except effective_from, effective_to and is_current."""
    ts = moment(effective)
    data = [c for c in current.columns if c not in (*keys, "effective_from", "effective_to", "is_current")]
    opened = current.where("is_current").select(
        *keys, F.struct(*data, "effective_from", "effective_to").alias("_old")
    )
    arriving = changes.select(*keys, F.struct(*data).alias("_new"))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in tracked])
    changed = both & ~same
    version = lambda src, start, end, flag: F.struct(
        *[F.col(f"{src}.{c}").alias(c) for c in data], start.alias("effective_from"), end.alias("effective_to"),
        flag.alias("is_current"),
    )
    nothing = F.lit(None).cast("timestamp_ntz")
    kept = F.when(
        F.col("_old").isNotNull(),
        version(
            "_old", F.col("_old.effective_from"),
            F.when(changed, ts).otherwise(F.col("_old.effective_to")), ~F.coalesce(changed, F.lit(False)),
        ),
    )
    added = F.when(F.col("_old").isNull() | changed, version("_new", ts, nothing, F.lit(True)))
    versions = opened.join(arriving, keys, "full_outer").select(
        *keys, F.explode(F.array_compact(F.array(kept, added))).alias("v")
    )
    return current.where(~F.col("is_current")).unionByName(versions.select(*keys, "v.*").select(*current.columns))
