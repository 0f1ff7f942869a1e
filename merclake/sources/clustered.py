"""Tables clustered by several columns, with the range of each column per file, so that a filter on any of them reads
few files.

Rows are sorted by a Z-order key: each column's place among its own quantiles, with the bits of all columns interleaved.
Rows that are near in every column get near keys, so each file covers a small range of every column. The ranges are kept
in a table beside the files, and a read picks files by it before Spark opens any.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bits of a column's place. 2**BITS - 1 quantiles bound the places; they come from a sketch of fixed size.
BITS = 6


def places(df: DataFrame, columns: list[str]) -> list[Column]:
    """Of every column the place of its value among its quantiles, 0 to 2**BITS - 1; NULL is 0."""
    shares = [i / 2**BITS for i in range(1, 2**BITS)]
    number = lambda c: F.unix_micros(F.col(c).cast("timestamp")).cast("double") if dict(df.dtypes)[c] in ("date", "timestamp", "timestamp_ntz") else F.col(c).cast("double")
    bounds = df.agg(*[F.percentile_approx(number(c), shares, 10_000).alias(c) for c in columns]).first()
    out = []
    for c in columns:
        steps = sorted(set(bounds[c] or []))
        above = F.array(*map(F.lit, steps)) if steps else F.array().cast("array<double>")
        # few different values are spread over all places, so that they too take part in the upper bits
        out.append(F.floor(_below(above, number(c)) * F.lit(2**BITS / (len(steps) + 1))).cast("int"))
    return out


def _below(bounds: Column, value: Column) -> Column:
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b < value)))


def zorder(spots: list[Column]) -> Column:
    """The bits of all places interleaved, the first column's first."""
    n = len(spots)
    bits = [
        F.shiftleft(F.shiftright(spot, b).bitwiseAND(1).cast("bigint"), b * n + (n - 1 - i)) for i, spot in enumerate(spots) for b in range(BITS)
    ]
    return reduce(Column.bitwiseOR, bits)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None) -> None:
    """Write rows in Z-order of the columns (numbers or times), in about ``files`` files or as Spark sees fit, and the
    ranges of the columns in each file."""
    keyed = df.withColumn("_z", zorder(places(df, columns)))
    ranged = keyed.repartitionByRange(files, "_z") if files else keyed.repartitionByRange("_z")
    ranged.sortWithinPartitions("_z").drop("_z").write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    ranges = [f(F.col(c)).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "low"), (F.max, "high"))]
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ranges).coalesce(1).write.parquet(f"{path}/files")


def files_between(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> list[str]:
    """Files that may hold rows within the bounds ``{column: (low, high)}``, both inclusive, None for an open one."""
    ranges = spark.read.parquet(f"{path}/files")
    tests = [F.col(f"high_{c}") >= F.lit(low) for c, (low, _) in bounds.items() if low is not None]
    tests += [F.col(f"low_{c}") <= F.lit(high) for c, (_, high) in bounds.items() if high is not None]
    return sorted(r["file"] for r in ranges.where(reduce(and_, tests, F.lit(True))).select("file").collect())  # names of the files to read


def read_between(spark: SparkSession, path: str, bounds: dict[str, tuple]) -> DataFrame:
    """The rows within the bounds, from the files that may hold some."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_between(spark, path, bounds)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    tests = [F.col(c) >= F.lit(low) for c, (low, _) in bounds.items() if low is not None]
    tests += [F.col(c) <= F.lit(high) for c, (_, high) in bounds.items() if high is not None]
    return rows.where(reduce(and_, tests, F.lit(True)))
