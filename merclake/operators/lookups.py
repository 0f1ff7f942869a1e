"""Filtered lists, pages, point lookups and top-k reports.

Every order ends with an id, so pages do not overlap. NULLs sort last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from merclake.functions.columns import Instant, all_of, as_date, within_days


def filter_where(
    df: DataFrame,
    equals: dict[str, object] | None = None,
    at_least: dict[str, object] | None = None,
    at_most: dict[str, object] | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """AND of the given tests. A bound of None is left out; a bound of 0 is a bound."""
    tests = [F.col(c) == v for c, v in (equals or {}).items() if v is not None]
    tests += [F.col(c) >= v for c, v in (at_least or {}).items() if v is not None]
    tests += [F.col(c) <= v for c, v in (at_most or {}).items() if v is not None]
    return df.where(all_of(tests + list(extra)))


def name_contains(col: str, text: str) -> Column:
    """Case-insensitive search; ``%``, ``_`` and the escape sign match themselves."""
    return F.contains(F.lower(F.col(col)), F.lit(text.lower()))


def page(df: DataFrame, order: list[Column], page: int = 1, page_size: int = 50) -> DataFrame:
    """One page. ``order`` must end with a unique column. Page p keeps the best
    p * page_size rows per task (top-k), so it suits the first pages of a list;
    use :func:`page_after` to walk far into one."""
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    return df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


def page_after(df: DataFrame, order_col: str, id_col: str, last: tuple | None, page_size: int = 50) -> DataFrame:
    """Next page of a descending list after the row ``last = (order value, id)``; ids ascend
    within equal values. Its cost does not grow with the depth, as the bound is a pushed filter."""
    if last is not None:
        value, ident = last
        df = df.where(
            (F.col(order_col) <= F.lit(value))
            & ((F.col(order_col) < F.lit(value)) | (F.col(id_col) > F.lit(ident)))
        )
    return df.orderBy(F.col(order_col).desc_nulls_last(), F.col(id_col)).limit(page_size)


def page_info(df: DataFrame, page: int = 1, page_size: int = 50) -> DataFrame:
    """One row: total, page, page_size, total_pages."""
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.ceil(F.col("total") / F.lit(page_size)).cast("bigint").alias("total_pages"),
    )


def find_orders(
    orders: DataFrame, status: str | None = None, start: Instant | None = None, end: Instant | None = None,
    customer_id=None, min_amount: float | None = None, max_amount: float | None = None,
) -> DataFrame:
    return filter_where(
        orders,
        equals={"status": status, "customer_id": customer_id},
        at_least={"total_amount": min_amount},
        at_most={"total_amount": max_amount},
        extra=[within_days("order_timestamp", start, end)],
    )


def list_orders(orders: DataFrame, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    newest = [F.col("order_timestamp").desc_nulls_last(), F.col("order_id")]
    return page(find_orders(orders, **filters), newest, page_no, page_size)


def customer_orders(orders: DataFrame, customer_id, page_no: int = 1, page_size: int = 50) -> DataFrame:
    return list_orders(orders, page_no, page_size, customer_id=customer_id)


def detail(df: DataFrame, id_col: str, ident) -> DataFrame:
    """The row(s) of one id. ``ident`` is a value or a scalar subquery."""
    return df.where(F.col(id_col) == (ident if isinstance(ident, Column) else F.lit(ident)))


def customer_detail(customers: DataFrame, ident) -> DataFrame:
    return detail(customers.where("is_current"), "customer_id", ident)


def find_customers(
    customers: DataFrame, segment: str | None = None, country: str | None = None, min_ltv: float | None = None
) -> DataFrame:
    return filter_where(
        customers.where("is_current"), equals={"segment": segment, "country": country},
        at_least={"lifetime_value": min_ltv},
    )


def list_customers(customers: DataFrame, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    richest = [F.col("lifetime_value").desc_nulls_last(), F.col("customer_id")]
    return page(find_customers(customers, **filters), richest, page_no, page_size)


def top_spenders(customers: DataFrame, limit: int = 10) -> DataFrame:
    return list_customers(customers, 1, limit)


def at_risk_customers(customers: DataFrame, limit: int = 100) -> DataFrame:
    return (
        find_customers(customers, segment="at_risk")
        .orderBy(F.col("churn_probability").desc_nulls_last(), "customer_id")
        .limit(limit)
    )


def store_scores(customers: DataFrame, path: str, day: Instant) -> None:
    """Store the customers with their scores of a day, by segment; a day that is stored again is replaced."""
    dated = customers.withColumn("score_day", F.lit(as_date(day).isoformat()))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("score_day", "segment").parquet(path)


def stored_scores(spark: SparkSession, path: str, day: Instant) -> DataFrame:
    """The customers of a stored day. A filter on the segment reads that segment's files."""
    return spark.read.parquet(path).where(F.col("score_day") == F.lit(as_date(day).isoformat())).drop("score_day")


def find_products(
    products: DataFrame, category: str | None = None, brand: str | None = None, in_stock_only: bool = False,
    min_price: float | None = None, max_price: float | None = None, search: str | None = None,
) -> DataFrame:
    extra = [F.col("is_active")]
    if in_stock_only:
        extra.append(F.col("is_in_stock"))
    if search:
        extra.append(name_contains("name", search))
    return filter_where(
        products, equals={"category": category, "brand": brand},
        at_least={"unit_price": min_price}, at_most={"unit_price": max_price}, extra=extra,
    )


def list_products(products: DataFrame, page_no: int = 1, page_size: int = 50, **filters) -> DataFrame:
    by_name = [F.col("name").asc_nulls_last(), F.col("product_id")]
    return page(find_products(products, **filters), by_name, page_no, page_size)


def low_stock(products: DataFrame, threshold: int = 10, limit: int | None = 100) -> DataFrame:
    short = products.where(F.col("is_active") & (F.col("stock_quantity") <= threshold))
    return short if limit is None else short.orderBy("stock_quantity", "product_id").limit(limit)


def having_members(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    keys = members.select(F.col(member_key).alias("_member"))
    return df.join(keys, F.col(key) == F.col("_member"), "left_semi")


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Parent lookup for all orders at once."""
    return orders.join(customers, "customer_id", "left")


def latest_per_parent(children: DataFrame, parent: str, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """Child rows ``offset+1 .. offset+limit`` of every parent. The row_number bound lets
    Spark keep only that many rows per parent before the shuffle, whatever its size."""
    ranked = children.withColumn("_rn", F.row_number().over(W.partitionBy(parent).orderBy(*order)))
    return ranked.where((F.col("_rn") <= offset + limit) & (F.col("_rn") > offset)).drop("_rn")
