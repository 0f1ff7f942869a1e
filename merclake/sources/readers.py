"""File and stream sources."""

from __future__ import annotations

import csv
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from merclake.functions.columns import wide_sum

# Texts that mean NULL in delimited files.
NULL_TEXTS = ["", "NULL", "null", "None", "NA", "N/A"]


@dataclass(frozen=True)
class FileSpec:
    path: str
    format: str
    delimiter: str = ","
    encoding: str = "utf-8"
    skip_rows: int = 0
    null_values: list[str] = field(default_factory=lambda: list(NULL_TEXTS))
    schema: str | T.StructType | None = None
    date_columns: list[str] = field(default_factory=list)
    datetime_format: str = "yyyy-MM-dd HH:mm:ss"


def _struct(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns; a value that does not fit becomes NULL."""
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


#: Types of text columns, the first that fits counts; rows of a file's part that are looked at beforehand.
KINDS, FIRST_ROWS = ["bigint", "double", "boolean", "timestamp_ntz"], 200


def _fitting(df: DataFrame, kinds: dict[str, list[str]]) -> dict[str, tuple[int, list[str]]]:
    """Of every column the number of values, and which of its types fit them all. One row of counts reaches the driver."""
    names = list(kinds)
    aggs = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]
    aggs += [F.count(F.col(f"`{c}`").try_cast(k)).alias(f"n{i}_{k}") for i, c in enumerate(names) for k in kinds[c]]
    seen = df.agg(*aggs).first()
    return {c: (seen[f"n{i}"], [k for k in kinds[c] if seen[f"n{i}_{k}"] == seen[f"n{i}"]]) for i, c in enumerate(names)}


def infer_types(df: DataFrame) -> T.StructType:
    """Types that fit every non-NULL text value, from an aggregation over the file: BIGINT,
    DOUBLE, BOOLEAN, TIMESTAMP_NTZ, else STRING.

    A cast that fails costs an exception, so types that a value of the first rows does not fit are ruled out by these;
    all rows are then asked for the types that are left."""
    if not df.columns:
        return T.StructType()
    first = _fitting(df.limit(FIRST_ROWS), dict.fromkeys(df.columns, KINDS))
    seen = _fitting(df, {c: fits for c, (_, fits) in first.items()})
    fields = []
    for c, (n, fits) in seen.items():
        fields.append(T.StructField(c, T._parse_datatype_string(fits[0]) if n and fits else T.StringType()))
    return T.StructType(fields)


def _without_preamble(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """The cells of the lines after the first ``skip_rows`` and the header, as text, under the names of their own file's
    header; the columns are in the order of some header.

    Files stay splittable: a line's position is known relative to the first line of its
    file, and only lines of the first block of a file can be preamble. The table of headers has one row per
    file, and the planner decides by its size how to join it. However many orders the files have their columns in, the
    lines are scanned once: a cell is taken by the place of its name in the header."""
    lines = spark.read.option("encoding", spec.encoding).text(spec.path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.file_block_start") == 0).alias("_first_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    top = lines.where("_first_block").groupBy("_file").agg(F.min("_line").alias("_start"))
    first = lines.where("_first_block").join(top, "_file")
    headers = first.where(F.col("_line") - F.col("_start") == spec.skip_rows).select("_file", "_start", F.col("value").alias("_header"))
    some = headers.agg(F.min("_header")).first()[0]
    if some is None:
        raise ValueError(f"{spec.path} has no header after {spec.skip_rows} rows")
    names = [n.strip() for n in next(csv.reader([some], delimiter=spec.delimiter))]
    width = len(names) + 1  # a header with more columns shows in one more cell
    as_text = ", ".join(f"_c{i} STRING" for i in range(width))

    def cells(text: str) -> Column:
        # exploding a one-element array keeps the line from being parsed once per cell
        return F.explode(F.array(F.from_csv(text, as_text, {"sep": spec.delimiter})))

    as_array = lambda struct: F.array(*[F.col(f"{struct}._c{i}") for i in range(width)])
    headers = headers.withColumn("_h", cells("_header")).withColumn("_names", F.transform(as_array("_h"), F.trim)).drop("_h")
    same = F.array_sort(F.array_compact("_names")) == F.array(*map(F.lit, sorted(names)))
    odd = [r["_header"] for r in headers.where(~same).select("_header").limit(3).collect()]
    if odd:
        raise ValueError(f"the files of {spec.path} differ in their columns: {[some, *odd]}")
    placed = lines.join(headers.drop("_header"), "_file")
    body = placed.where((~F.col("_first_block") | (F.col("_line") - F.col("_start") > spec.skip_rows)) & (F.length("value") > 0))
    rows = body.select("_names", cells("value").alias("_v")).select("_names", as_array("_v").alias("_cells"))
    return rows.select(*[F.get("_cells", (F.array_position("_names", n) - 1).cast("int")).alias(n) for n in names])


def _nulled(text: DataFrame, null_values: list[str], but: tuple[str, ...] = ()) -> DataFrame:
    return text.select(*[
        F.when(~F.col(f"`{c}`").isin(null_values), F.col(f"`{c}`")).alias(c) if c not in but else F.col(c) for c in text.columns
    ])


def read_csv(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """Delimited text with a header. All NULL texts are honoured, then types are applied
    (``schema``, or inferred over the whole file). With ``skip_rows`` a row is one line, and every file is read by
    its own header; files may order the same columns differently."""
    if spec.skip_rows:
        text = _without_preamble(spark, spec)
    else:
        text = spark.read.csv(
            spec.path, sep=spec.delimiter, encoding=spec.encoding, header=True, inferSchema=False,
            ignoreLeadingWhiteSpace=False,
        )
    nulled = _nulled(text, spec.null_values)
    kept = [c for c in nulled.columns if c in spec.date_columns]
    schema = _struct(spec.schema) if spec.schema else infer_types(nulled.drop(*kept))
    wanted = T.StructType([f for f in schema.fields if f.name not in spec.date_columns])
    return _typed(nulled, wanted)


def read_json(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """One JSON document (an array of rows) per file."""
    reader = spark.read.option("multiLine", True).option("encoding", spec.encoding)
    return (reader.schema(_struct(spec.schema)) if spec.schema else reader).json(spec.path)


def read_jsonl(spark: SparkSession, spec: FileSpec) -> DataFrame:
    reader = spark.read
    return (reader.schema(_struct(spec.schema)) if spec.schema else reader).json(spec.path)


def read_parquet(spark: SparkSession, spec: FileSpec) -> DataFrame:
    return spark.read.parquet(spec.path)


READERS = {"csv": read_csv, "json": read_json, "jsonl": read_jsonl, "parquet": read_parquet}


def read_file(spark: SparkSession, spec: FileSpec) -> DataFrame:
    if spec.format not in READERS:
        raise ValueError(f"unsupported file format: {spec.format}")
    return READERS[spec.format](spark, spec)


def read_directory(
    spark: SparkSession, directory: str | list[str], file_format: str, pattern: str = "*", schema: str | T.StructType | None = None,
    null_values: list[str] | None = None, **options,
) -> DataFrame:
    """All files ``pattern.format`` of a directory, or of a list of files, as one scan, with ``_source_file``. Delimited files honour the same
    NULL texts as :func:`read_csv`."""
    if file_format not in READERS:
        raise ValueError(f"unsupported file format: {file_format}")
    reader = spark.read.option("pathGlobFilter", f"{pattern}.{file_format}")
    if schema is not None and file_format != "csv":
        reader = reader.schema(_struct(schema))
    if file_format == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    if file_format == "json":
        reader = reader.option("multiLine", True)
    for key, value in options.items():
        reader = reader.option(key, value)
    kind = "json" if file_format == "jsonl" else file_format
    rows = reader.format(kind).load(directory).select("*", F.col("_metadata.file_path").alias("_source_file"))
    if file_format != "csv":
        return rows
    nulled = _nulled(rows, NULL_TEXTS if null_values is None else null_values, ("_source_file",))
    return _typed(nulled, _struct(schema) if schema is not None else infer_types(nulled.drop("_source_file")))


def file_row_counts(directory: DataFrame) -> DataFrame:
    return directory.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))


def file_fingerprints(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``(path, length, file_hash)`` of every file. The hash is the MD5 of the file's length, its number of lines and sums
    over the MD5s of the lines (four numbers of 24 bits each), plain and times the line's number. So it depends on
    the content and its order, not on a file's name or time, nor on how Spark splits it: a large file is hashed by many
    tasks, each of which gives one row of sums per block, and a block's lines are moved on by those of earlier blocks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    listed = files.select(F.col("_metadata.file_path").alias("path"), "length")
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    # within a task the ids of lines rise by one
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    read = lines.select(
        F.col("_metadata.file_path").alias("_p"), F.col("_metadata.file_block_start").alias("_block"), at.alias("_at"),
        F.md5(F.col("value").cast("binary")).alias("_m"),
    )
    digits = [F.conv(F.substring("_m", 1 + 6 * i, 6), 16, 10).cast("bigint") for i in range(4)]
    wide = "decimal(38,0)"
    blocks = read.groupBy("_p", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"), *[F.sum(d).cast(wide).alias(f"_s{i}") for i, d in enumerate(digits)],
        *[wide_sum(d * F.col("_at")).alias(f"_w{i}") for i, d in enumerate(digits)],  # beyond BIGINT
    )
    earlier = W.partitionBy("_p").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    placed = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    moved = (F.col("_before") - F.col("_first")).cast("decimal(18,0)")
    sums = placed.groupBy("_p").agg(
        F.sum("_n").alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(4)],
        *[F.sum(F.col(f"_w{i}") + F.col(f"_s{i}").cast("decimal(20,0)") * moved).alias(f"_w{i}") for i in range(4)],
    )
    zero = lambda c: F.coalesce(F.col(c).cast(wide), F.lit(0).cast(wide)).cast("string")
    return listed.join(sums, F.col("path") == F.col("_p"), "left").select(
        "path", "length", F.md5(F.concat_ws("-", F.col("length").cast("string"), zero("_n"), *[zero(f"_{c}{i}") for c in "sw" for i in range(4)])).alias("file_hash"),
    )


def recent_rows(df: DataFrame, reference: Column, hours: int = 24, time_col: str = "order_timestamp") -> DataFrame:
    """Rows of the last ``hours`` before ``reference`` (a column or literal) or later."""
    return df.where(F.col(time_col) >= reference - F.expr(f"INTERVAL {hours} HOURS"))


def read_event_files(spark: SparkSession, path: str, schema: str, pattern: str = "*", file_format: str = "parquet",
                     files_per_trigger: int | None = None) -> DataFrame:
    """A directory as a stream: every new file that fits the pattern becomes input."""
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_event_topics(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest",
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topics as ``(topic, value, partition, offset)`` rows of JSON text. Needs Spark's Kafka connector on
    the class path; consumed offsets live in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select("topic", F.col("value").cast("string").alias("value"), "partition", "offset")
