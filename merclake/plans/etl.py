"""Chains of operators: transformations to curated tables, daily and incremental loads,
quality checks. Each ``*_frame`` function only builds a plan; its ``transform_*`` companion
writes it and returns a one-row result with the rows in and out, counted during the write."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from merclake.functions.columns import Instant, as_date, date_key, moment
from merclake.operators import anomaly, quality
from merclake.operators.aggregates import daily_sales
from merclake.operators.cleaning import (
    clean_customers, clean_orders, clean_products, counted, remove_duplicates, trim_strings,
)
from merclake.operators.enrichment import (
    enrich_customers, hash_pii, order_time_features, product_sales_metrics, session_metrics,
)
from merclake.session import materialize
from merclake.sources import writers
from merclake.sources.keyed import Keyed, merge, outgrown, regrow
from merclake.sources.ledger import Ledger
from merclake.sources.loads import load_files, load_summary
from merclake.sources.readers import FileSpec, recent_rows

RESULT = (
    "transformation string, input_rows bigint, output_rows bigint, rows_dropped bigint, duration_seconds double, "
    "output_path string, errors string"
)
PII_COLUMNS = ["email", "phone", "first_name", "last_name"]


def orders_frame(raw: DataFrame) -> DataFrame:
    """Clean, time features, net amount, date key."""
    return featured_orders(clean_orders(raw))


def featured_orders(cleaned: DataFrame) -> DataFrame:
    """:func:`orders_frame` of orders that are clean."""
    df = order_time_features(cleaned) if "order_timestamp" in cleaned.columns else cleaned
    if "subtotal" in df.columns and "discount_amount" in df.columns:
        df = df.withColumn("net_amount", F.col("subtotal") - F.col("discount_amount"))
    if "order_timestamp" in df.columns:
        df = df.withColumn("order_date_key", date_key("order_timestamp"))
    return df


def customers_frame(raw: DataFrame, orders: DataFrame | None, reference_date: Instant) -> DataFrame:
    """Clean, replace personal data by hash and mask, add scores and value when orders are given."""
    df = hash_pii(clean_customers(raw), PII_COLUMNS, drop_raw=True)
    return df if orders is None else enrich_customers(df, orders, reference_date)


def products_frame(raw: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Clean, sales metrics when order lines are given, margin."""
    df = clean_products(raw)
    if items is not None:
        df = product_sales_metrics(df, items)
    if "unit_price" in df.columns and "cost_price" in df.columns:
        margin = F.try_divide(F.col("unit_price") - F.col("cost_price"), F.col("unit_price")) * 100
        df = df.withColumn("margin_percent", margin)
    return df


def clickstream_frame(raw: DataFrame) -> DataFrame:
    """Trim, one row per page view, date key, session figures."""
    df = remove_duplicates(trim_strings(raw), ["page_view_id"])
    if "event_timestamp" in df.columns:
        df = df.withColumn("date_key", date_key("event_timestamp"))
        if "session_id" in df.columns:
            df = session_metrics(df).drop("session_start", "session_end")
    return df


def _write(
    name: str, raw: DataFrame, build, root: str, stamp: datetime, partition_by: list[str] | None, rows_before: int | None = None
) -> DataFrame:
    """``rows_before``: the rows in where ``raw`` has gone through a step already."""
    spark = raw.sparkSession
    started = time.monotonic()
    path, errors, rows_in, rows_out = None, "", None, 0
    source, seen = counted(raw, f"{name}-in-{stamp.timestamp()}")
    try:
        result, made = counted(build(source), f"{name}-out-{stamp.timestamp()}")
        path = writers.write_curated(result, root, f"{name}_curated", stamp, partition_by)
        rows_in, rows_out = rows_before if rows_before is not None else seen.get["rows"], made.get["rows"]
    except Exception as problem:  # reported in the result row; the other tables still run
        errors = str(problem).splitlines()[0]
        rows_in = next(n for n in (rows_in, rows_before, raw.count()) if n is not None)
    row = (name, rows_in, rows_out, rows_in - rows_out, round(time.monotonic() - started, 3), path, errors)
    return spark.createDataFrame([row], RESULT)


def _spread(raw: DataFrame) -> DataFrame:
    """The rows over all tasks. A file is read by a task per row group, so a dimension often comes in one."""
    return raw.hint("rebalance")


def transform_orders(raw: DataFrame, root: str, stamp: datetime, partition_by: list[str] | None = None) -> DataFrame:
    return _write("orders", raw, orders_frame, root, stamp, partition_by)


def transform_customers(
    raw: DataFrame, root: str, stamp: datetime, orders: DataFrame | None = None, reference_date: Instant | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    day = reference_date or stamp
    return _write("customers", raw, lambda df: customers_frame(_spread(df), orders, day), root, stamp, partition_by)


def transform_products(
    raw: DataFrame, root: str, stamp: datetime, items: DataFrame | None = None, partition_by: list[str] | None = None
) -> DataFrame:
    return _write("products", raw, lambda df: products_frame(_spread(df), items), root, stamp, partition_by)


def transform_clickstream(raw: DataFrame, root: str, stamp: datetime, partition_by: list[str] | None = None) -> DataFrame:
    return _write("clickstream", raw, clickstream_frame, root, stamp, partition_by)


def _cleaned_once(orders: DataFrame, stamp: datetime) -> tuple[DataFrame | None, int | None]:
    """Clean orders, set aside, and the rows in; nothing where cleaning fails, which the tables' own rows then report."""
    try:
        source, seen = counted(orders, f"orders-raw-{stamp.timestamp()}")
        cleaned = materialize(clean_orders(source))
        return cleaned, seen.get["rows"]
    except Exception:  # reported by the tables that need the orders
        return None, None


def run_full_etl(
    orders: DataFrame, customers: DataFrame, products: DataFrame, root: str, stamp: datetime,
    items: DataFrame | None = None, clickstream: DataFrame | None = None, reference_date: Instant | None = None,
) -> DataFrame:
    """Products, customers, orders, clickstream; one result row each. The orders are cleaned once, for the customers and
    for themselves."""
    cleaned, rows_in = _cleaned_once(orders, stamp)
    out = transform_products(products, root, stamp, items)
    out = out.unionByName(transform_customers(customers, root, stamp, clean_orders(orders) if cleaned is None else cleaned, reference_date))
    if cleaned is None:
        out = out.unionByName(transform_orders(orders, root, stamp))
    else:
        out = out.unionByName(_write("orders", cleaned, featured_orders, root, stamp, None, rows_in))
    if clickstream is not None:
        out = out.unionByName(transform_clickstream(clickstream, root, stamp))
    return out


def etl_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("output_rows").alias("output_rows"),
        F.sum("duration_seconds").alias("duration_seconds"), F.count_if(F.col("errors") != "").alias("failed"),
    )


def transform_data(spark: SparkSession, data_type: str, input_path: str, root: str, stamp: datetime) -> DataFrame:
    by_type = {"orders": transform_orders, "customers": transform_customers, "products": transform_products}
    if data_type not in by_type:
        raise ValueError(f"unknown data type: {data_type}")
    return by_type[data_type](spark.read.parquet(input_path), root, stamp)


def validate_data(df: DataFrame, data_type: str, strict: bool = False) -> DataFrame | None:
    """Summary of the suite of the data type; None when it has no suite."""
    if data_type not in quality.SUITES:
        return None
    suite = quality.SUITES[data_type](strict)
    return suite.summary(suite.run(df))


def write_daily_aggregate(orders: DataFrame, path: str) -> None:
    """The daily table from scratch, one partition (and file) per month."""
    days = daily_sales(orders).withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))
    days.repartition("month_key").write.mode("overwrite").partitionBy("month_key").parquet(path)


def update_daily_aggregate(orders: DataFrame, day: Instant, path: str) -> DataFrame:
    """Recompute one day and replace its row of the daily table. Only the partition of its
    month, at most 31 rows, is rewritten; it is set aside before it is overwritten. A day
    without orders leaves the table as it is."""
    key = int(as_date(day).strftime("%Y%m%d"))
    row = daily_sales(orders, key).withColumn("month_key", F.lit(key // 100))
    stored = writers.read_table(orders.sparkSession, path, row.schema)
    others = stored.where((F.col("month_key") == key // 100) & (F.col("date_key") != key))
    fresh = materialize(row)
    month = materialize(fresh.unionByName(others.select(*fresh.columns)).coalesce(1))
    if fresh.count():
        writers.replace_partitions(month, path, ["month_key"])
    return fresh


#: Tables of the daily load and their keys.
STAGED = {"orders": Keyed("staging_orders", ("order_id",)), "customers": Keyed("staging_customers", ("customer_id",))}


def daily_batch_etl(
    spark: SparkSession, source_dir: str, warehouse: str, day: Instant, loaded_at: datetime, file_format: str = "csv"
) -> DataFrame:
    """Load the order and customer files that have arrived, then replace the day's aggregate. Returns one load-result
    row per source. Files of earlier days are listed, not read; of the stored orders the day's range is read. A failed
    file fails the run after all others were loaded and its row was recorded; the next run tries it again."""
    ledger, loads = Ledger(spark, f"{warehouse}/staging"), []
    for name, dates in (("orders", ["order_timestamp"]), ("customers", [])):
        spec = FileSpec(f"{source_dir}/{name}", file_format, date_columns=dates)
        files = load_files(ledger, spec, STAGED[name], loaded_at, pattern=f"*.{file_format}")
        loads.append(load_summary(files, STAGED[name].table))
    results = materialize(loads[0].unionByName(loads[1]))
    broken = results.where(F.col("status") == "failed").select("source_file", "error_message").take(2)
    if broken:
        raise RuntimeError("; ".join(f"{r.source_file}: {r.error_message}" for r in broken))
    staged = ledger.read(STAGED["orders"].table)
    orders = staged.withColumn("order_date_key", date_key("order_timestamp"))
    update_daily_aggregate(orders, day, f"{warehouse}/agg_daily_sales")
    return results


def incremental_rows(source: DataFrame, since, time_col: str = "updated_at") -> DataFrame:
    return writers.filter_incremental(source, time_col, since)


def incremental_etl(target: DataFrame, changed: DataFrame, since, time_col: str = "updated_at") -> DataFrame:
    """The order table after cleaning and merging the rows changed since the last run."""
    rows = orders_frame(incremental_rows(changed, since, time_col))
    update = [c for c in rows.columns if c != "order_number"]
    return writers.upsert(target, rows.select(*target.columns), ["order_number"], update, time_col)


def incremental_load(ledger: Ledger, target: Keyed, changed: DataFrame, since, time_col: str = "updated_at") -> list[int]:
    """As :func:`incremental_etl` on a stored table: only the buckets of changed orders are read and rewritten, also
    where an order's day changes. Returns these buckets."""
    state = ledger.state()
    rows = orders_frame(incremental_rows(changed, since, time_col))
    if target.table in state.schemas:
        rows = rows.select(*[c for c in ledger.read(target.table, state=state).columns if c != "bucket"])
    update = [c for c in rows.columns if c not in target.keys]
    change, buckets = merge(ledger, state, target, rows, update, time_col)
    state = ledger.commit(state, change)
    if outgrown(state, target):
        regrow(ledger, state, target)
    return buckets


def data_quality_check(orders: DataFrame, reference: Instant, hours: int = 24) -> dict[str, DataFrame]:
    """Checks, summary, anomalies, report and alerts over the orders of the last hours."""
    # every frame is read by several others, so each is computed once
    recent = materialize(recent_rows(orders, moment(reference), hours))
    suite = quality.orders_suite()
    checks = materialize(suite.run(recent))
    found = materialize(anomaly.detect_order_anomalies(recent))
    return {
        "checks": checks,
        "summary": suite.summary(checks),
        "anomalies": found,
        "report": anomaly.report(found, 2),
        "alerts": anomaly.alerts(found),
    }
