"""Helpers the operators share: Arrow batches as bytes, stored tables, held-out rows, global order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.session import store  # noqa: F401  the operators take it from here

# Arrow's own allocators keep freed memory; a worker that lives through many stages should give it back
pa.set_memory_pool(pa.system_memory_pool())

#: Rows and bytes of one Arrow batch and of one batch of a Parquet scan. Texts differ in length by orders of magnitude,
#: so the bytes count; a single longer text still is one batch of its own.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the memory a Python worker needs for one batch of texts."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, never more: those with the smallest hash of ``key``, or all if there are fewer. The hash
    is cut off in the tasks first, so what reaches the driver does not grow with the number of tasks."""
    order = F.shiftrightunsigned(F.xxhash64(key), 11)  # 53 bits
    total = df.count()
    if total > rows:
        df = df.where(order < int(2**53 * (rows / total)))
    return df.orderBy(order, *df.columns).limit(rows)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(modulus)


def indexed(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Number the rows from 0 in a global order. Each task numbers its own range; only the number of rows of
    each range goes to the driver."""
    spark = df.sparkSession
    cols = df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    ranged = store(ranged, "indexed")
    counts = {r["_pid"]: r["n"] for r in ranged.groupBy("_pid").agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for pid in sorted(counts):
        starts.append((pid, at))
        at += counts[pid]
    offsets = spark.createDataFrame(starts or [(0, 0)], "_pid int, _start long")
    own = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return ranged.join(F.broadcast(offsets), "_pid").select(*cols, (F.col("_start") + own).alias(name))


#: 2**64 divided by the golden ratio (odd), and the finaliser constants of splitmix64. Fixed values.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def grouped(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20, column: str = "text") -> Iterator[pa.Table]:
    """Join small batches until they hold about ``limit`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def chunk(table: pa.Table, name: str) -> pa.Array:
    """A column of a combined table as one array."""
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    return column
