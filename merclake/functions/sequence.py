"""Row-to-row operations along an order, safe for keys that hold most of the rows.

``Window.partitionBy(key)`` sends every row of a key to one task. These helpers
partition by (key, bucket) instead, where ``bucket`` is any column that never
decreases along the order (the hour or day of a timestamp, an index divided by a
block length). What a bucket needs from earlier ones is carried by a summary with
one row per (key, bucket), so a hot key is spread over its buckets and the wide
rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merclake.session import materialize


def beside(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the further columns of a summary that has one row per value of ``keys``. A NULL key, which a window
    groups like any other value, meets the NULL of the summary."""
    renamed = summary.select(*[F.col(k).alias(f"_k_{k}") if k in keys else F.col(k) for k in summary.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, same, "left").drop(*[f"_k_{k}" for k in keys])


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], bucket: Column
) -> DataFrame:
    """Add ``{new: source}`` columns with the source value of the preceding row of the key.

    ``order`` must be unique within a key (end it with an id).
    """
    part = [*keys, "_bkt"]
    rows = df.withColumn("_bkt", bucket)
    payload = F.struct(*[F.col(src).alias(new) for new, src in columns.items()])
    carried = (
        rows.groupBy(*part)
        .agg(F.max(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], payload.alias("_p"))).alias("_t"))
        .select(*part, F.lag("_t._p").over(W.partitionBy(*keys).orderBy("_bkt")).alias("_carry"))
    )
    inside = rows.withColumn("_prev", F.lag(payload).over(W.partitionBy(*part).orderBy(*order)))
    out = beside(inside, carried, part).withColumn("_prev", F.coalesce("_prev", "_carry"))
    return out.select(*df.columns, *[F.col(f"_prev.{new}").alias(new) for new in columns])


def with_running_last(
    df: DataFrame, keys: list[str], order: list[str], source: str, new: str, bucket: Column
) -> DataFrame:
    """Add the last non-NULL ``source`` value of the key up to and including the row."""
    part = [*keys, "_bkt"]
    rows = df.withColumn("_bkt", bucket)
    stamp = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(source).alias("_p"))
    earlier = W.partitionBy(*keys).orderBy("_bkt").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*part)
        .agg(F.max(F.when(F.col(source).isNotNull(), stamp)).alias("_t"))
        .select(*part, F.last("_t._p", ignorenulls=True).over(earlier).alias("_carry"))
    )
    upto = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = rows.withColumn(new, F.last(source, ignorenulls=True).over(upto))
    out = beside(inside, carried, part).withColumn(new, F.coalesce(new, "_carry"))
    return out.select(*df.columns, new)


def with_run_start(
    df: DataFrame, keys: list[str], order: list[str], time: str, gap: Column, new: str, bucket: Column
) -> DataFrame:
    """Add the time at which the row's run began. A run ends where the next row of the key is
    more than ``gap`` later. ``order`` is unique within a key and begins with ``time``.

    A row opens a run if the gap lies inside its bucket, which a window over the bucket
    sees, or if it is the bucket's first row and far from the last row of the bucket before.
    The latter, and the run still open at a bucket's start, follow from one row per bucket."""
    part = [*keys, "_bkt"]
    inside = W.partitionBy(*part).orderBy(*order)
    before = F.lag(time).over(inside)
    rows = df.withColumn("_bkt", bucket)
    inner = F.when(F.col(time) - before > gap, F.col(time))
    buckets = W.partitionBy(*keys).orderBy("_bkt")
    carried = (
        rows.select(*part, *[o for o in order if o not in part])
        .withColumn("_inner", inner)
        .groupBy(*part)
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"), F.max("_inner").alias("_inner"))
        .withColumn("_gap", F.col("_first") - F.lag("_last").over(buckets))
        .withColumn("_opens", F.when(F.col("_gap").isNull() | (F.col("_gap") > gap), F.col("_first")))
        .withColumn("_open", F.coalesce("_inner", "_opens"))
        .withColumn("_carry", F.last("_open", True).over(buckets.rowsBetween(W.unboundedPreceding, -1)))
        .select(*part, F.coalesce("_opens", "_carry").alias("_carry"))
    )
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = rows.withColumn("_inner", inner).withColumn(new, F.last("_inner", True).over(upto))
    out = beside(marked, carried, part).withColumn(new, F.coalesce(new, "_carry"))
    return out.select(*df.columns, new)


def with_dense_rank(df: DataFrame, keys: list[str], order: str, new: str, bucket: Column) -> DataFrame:
    """Add the dense rank of ``order`` within the key (equal values share a rank; NULL has none). Rows without a
    key are ranked together, like those of any key.

    Distinct values are ranked and joined back, so repeated values never meet in a window;
    ``bucket`` is computed from ``order``."""
    part = [*keys, "_bkt"]
    values = df.where(F.col(order).isNotNull()).select(*keys, order).distinct().withColumn("_bkt", bucket)
    earlier = W.partitionBy(*keys).orderBy("_bkt").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        values.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_k"))
        .select(*part, F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"))
    )
    ranked = values.withColumn("_in", F.row_number().over(W.partitionBy(*part).orderBy(order)))
    ranks = beside(ranked, offsets, part).select(*keys, order, (F.col("_in") + F.col("_before")).cast("int").alias(new))
    return beside(df, ranks, [*keys, order]).select(*df.columns, new)


def with_dense_index(df: DataFrame, key: str, new: str, buckets: int = 4096) -> DataFrame:
    """Add a gap-free 0-based BIGINT index over the distinct rows of a one-key frame.

    Keys are ordered by (hash bucket, key): hashing keeps the buckets even for any id
    pattern. Each bucket is numbered on its own and shifted by the sizes of the earlier ones.
    """
    rows = df.withColumn("_bkt", F.pmod(F.xxhash64(key), F.lit(buckets)))
    # ``buckets`` rows at most.
    earlier = W.partitionBy(F.lit(0)).orderBy("_bkt").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bkt")
        .agg(F.count(F.lit(1)).alias("_k"))
        .select("_bkt", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"))
    )
    numbered = rows.withColumn(new, F.row_number().over(W.partitionBy("_bkt").orderBy(key)) - 1)
    out = numbered.join(offsets, "_bkt").withColumn(new, (F.col(new) + F.col("_before")).cast("bigint"))
    return out.select(*df.columns, new)


def ranged(df: DataFrame, order: list[str], name: str = "_range") -> DataFrame:
    """Store the rows in ranges of about equal size along ``order`` and add the number of their range. The ranges
    are measured, so any ids and any times spread evenly; rows that are equal in ``order`` share one."""
    rows = df.repartitionByRange(*order).withColumn(name, F.spark_partition_id().cast("bigint"))
    return materialize(rows)


def with_position(df: DataFrame, order: list[str], new: str) -> DataFrame:
    """Add the 0-based BIGINT position of the row in the order of the whole frame, NULLs first.

    Rows are numbered per range and shifted by the sizes of the earlier ranges, of which there is one summary
    row each."""
    rows = ranged(df, order, "_bkt")
    earlier = W.partitionBy(F.lit(0)).orderBy("_bkt").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bkt")
        .agg(F.count(F.lit(1)).alias("_k"))
        .select("_bkt", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"))
    )
    numbered = rows.withColumn(new, F.row_number().over(W.partitionBy("_bkt").orderBy(*order)) - 1)
    out = numbered.join(offsets, "_bkt").withColumn(new, (F.col(new) + F.col("_before")).cast("bigint"))
    return out.select(*df.columns, new)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by the whole row.

    A ``min`` over structs combines on the map side, so a key repeated billions of
    times costs one row per task; ``row_number`` would sort them all in one.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [o.alias(f"_k{i}") for i, o in enumerate(order)]
    kinds = dict(df.dtypes)
    # maps have no hash; their JSON text does
    comparable = [F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(c) for c in rest if kinds[c] != "variant"]
    tie = F.xxhash64(*comparable).alias("_tie") if comparable else F.lit(0).alias("_tie")
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("_none"))
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*ranked, tie)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
