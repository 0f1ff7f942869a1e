"""Training sets: feature choice, repeatable splits, churn / value / recommendation data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from merclake.functions.columns import Instant, exact_sum, within_days
from merclake.functions.ranks import cuts_of_each, smallest_share
from merclake.functions.sequence import with_dense_index
from merclake.operators.features import CHURN_QUANTILES, churn_features, clv_features, customer_features
from merclake.session import materialize

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
ID_COLUMNS = ("customer_id", "product_id", "order_id")


def select_features(
    df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, booleans: bool = False
) -> list[str]:
    """Names of the numeric columns without ids (counts included), or ``include`` as given."""
    if include:
        return list(include)
    left_out = {*ID_COLUMNS, *(exclude or [])}
    kinds = NUMERIC + (("boolean",) if booleans else ())
    return [c for c, t in df.dtypes if c not in left_out and t in kinds]


def train_val_split(
    df: DataFrame, id_col: str, validation: float = 0.2, seed: int = 42, stratify: str | None = None,
    few_labels: bool = False,
) -> DataFrame:
    """Add ``split``: the ceil(validation * n) rows with the smallest MD5 of (seed, id), per
    label when stratified, are ``val``. Depends only on ids and seed, not on partitioning.

    ``few_labels`` states that one row per label may be broadcast; else the planner decides by size.

    The hash that bounds the share is found by a distributed rank search, since two labels
    mean two window partitions that would each sort half of the data."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(id_col).cast("string")))
    unit = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")  # 52 bits: exact as a double
    rows = df.withColumn("_u", unit)
    by = [stratify] if stratify else []
    cuts = smallest_share(rows, "_u", validation, by, few_groups=few_labels)
    if stratify:
        bounds = cuts.select(stratify, "cut")
        out = rows.join(F.broadcast(bounds) if few_labels else bounds, stratify)
    else:
        out = rows.withColumn("cut", cuts.select("cut").scalar())
    return out.withColumn("split", F.when(F.col("_u") <= F.col("cut"), "val").otherwise("train")).select(
        *df.columns, "split"
    )


def churn_dataset(
    orders: DataFrame, reference_date: Instant, train: tuple[Instant, Instant],
    test: tuple[Instant, Instant] | None = None, validation: float = 0.2, seed: int = 42,
    include: list[str] | None = None, exclude: list[str] | None = None,
) -> DataFrame:
    """``customer_id, split, y, features...``: stratified train and val rows from the training
    days, test rows from the test days."""

    periods = {"train": train, **({"test": test} if test else {})}
    # one row per customer and period, read by the rank searches and the result
    features = {p: materialize(customer_features(orders.where(within_days("order_timestamp", *days)), reference_date)) for p, days in periods.items()}
    found = cuts_of_each(features, CHURN_QUANTILES)
    labelled = {p: churn_features(features[p], found=found[p]) for p in periods}
    rows = labelled["train"]
    names = [c for c in select_features(rows, include, exclude) if c != "is_churned"]
    shaped = lambda df: df.select("customer_id", F.col("is_churned").cast("int").alias("y"), *names)
    out = train_val_split(shaped(rows), "customer_id", validation, seed, "y", few_labels=True)
    if test:
        out = out.unionByName(shaped(labelled["test"]).withColumn("split", F.lit("test")))
    return out


def clv_dataset(
    orders: DataFrame, reference_date: Instant, train: tuple[Instant, Instant], validation: float = 0.2, seed: int = 42,
    include: list[str] | None = None, exclude: list[str] | None = None,
) -> DataFrame:
    """``customer_id, split, y, features...`` with the projected value (NULL as 0) as target."""
    window = orders.where(within_days("order_timestamp", *train))
    rows = clv_features(materialize(customer_features(window, reference_date)))
    target = ["projected_clv", "historical_clv", "clv_quartile"]
    names = [c for c in select_features(rows, include, [*(exclude or []), *target])]
    shaped = rows.select("customer_id", F.coalesce("projected_clv", F.lit(0.0)).alias("y"), *names)
    return train_val_split(shaped, "customer_id", validation, seed)


def dataset_metadata(dataset: DataFrame, target: str) -> DataFrame:
    """One row: samples per split, and the mean and population deviation of the target over
    the training period (for churn the mean of the training rows, i.e. the churn rate)."""
    fitted = F.col("split") != "test"
    of_train = F.when(F.col("split") == "train", F.col("y"))
    mean = F.avg(of_train) if target == "churn" else F.avg(F.when(fitted, F.col("y")))
    return dataset.agg(
        F.lit(target).alias("target"),
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "val").alias("val_samples"),
        F.count_if(F.col("split") == "test").alias("test_samples"),
        mean.alias("target_mean"),
        F.stddev_pop(F.when(fitted, F.col("y").cast("double"))).alias("target_std"),
    )


def save_dataset(dataset: DataFrame, path: str, metadata: dict) -> str:
    """Parquet by split plus one JSON line of metadata beside it."""
    names = [c for c in dataset.columns if c not in ("customer_id", "y", "split")]
    dataset.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    text = json.dumps({**metadata, "feature_names": names})
    dataset.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata"
    )
    return path


def load_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    line = spark.read.text(f"{path}/metadata").first()
    return spark.read.parquet(f"{path}/rows"), json.loads(line["value"])


def interactions(items: DataFrame) -> DataFrame:
    """Units and spend per customer and product."""
    return items.groupBy("customer_id", "product_id").agg(
        F.sum("quantity").alias("purchase_count"), exact_sum("line_total", 4).alias("total_spent")
    )


def recommendation_dataset(items: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """Frames ``interactions`` (user_idx, item_idx, value), ``users``, ``items`` (id to dense
    0-based index), ``product_features`` and the one-row ``metadata``."""
    pairs = materialize(interactions(items))
    users = with_dense_index(pairs.select("customer_id").distinct(), "customer_id", "user_idx")
    goods = with_dense_index(pairs.select("product_id").distinct(), "product_id", "item_idx")
    matrix = (
        pairs.join(users, "customer_id").join(goods, "product_id")
        .select("user_idx", "item_idx", F.col("purchase_count").alias("value"))
    )
    size = pairs.agg(
        F.count(F.lit(1)).alias("n_interactions"),
        F.count_distinct("customer_id").alias("n_users"),
        F.count_distinct("product_id").alias("n_items"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items")
    return {
        "interactions": matrix,
        "users": users,
        "items": goods,
        "product_features": products.select("product_id", "unit_price", "stock_quantity", "avg_rating"),
        "metadata": size.withColumn("sparsity", 1 - F.try_divide(F.col("n_interactions").cast("double"), cells)),
    }


def order_baskets(items: DataFrame) -> DataFrame:
    """``order_id, product_id, times``: the products of an order and on how many of its lines each stands. One form
    for orders of any size; whoever needs lists groups what fits."""
    return items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("times"))


def co_purchased_with(items: DataFrame, product_ids: list) -> DataFrame:
    """Edges of the co-purchase graph at the given products: ``(product_id, other_id, orders)``,
    the number of orders that hold both. Only the lines of orders that hold one of the products are shuffled
    for the distinct pairs.

    The work is linear in the lines of the orders that hold one of the products. The whole
    edge list is not offered: it is quadratic in the size of an order."""
    lines = items.select("order_id", "product_id")
    anchors = lines.where(F.col("product_id").isin(product_ids)).distinct().withColumnRenamed("product_id", "anchor")
    held = anchors.select("order_id").distinct()
    pairs = lines.join(held, "order_id", "left_semi").distinct()
    return (
        anchors.join(pairs, "order_id")
        .where(F.col("anchor") != F.col("product_id"))
        .groupBy(F.col("anchor").alias("product_id"), F.col("product_id").alias("other_id"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def frequent_pairs(items: DataFrame, min_orders: int) -> DataFrame:
    """``product_a, product_b, orders, confidence, lift`` of the product pairs (a before b) that at least ``min_orders``
    orders hold together. ``confidence`` is the share of a's orders that hold b, ``lift`` that share against b's share
    of all orders.

    A pair cannot be more frequent than its products, so lines of rarer products are dropped first, and with them orders
    of which one product is left; pairs are formed among the rest and counted. The result has at most (lines /
    min_orders) pairs per product. The join of the rest with itself is one Spark can split for large orders."""
    lines = items.select("order_id", "product_id").distinct()
    total = items.select("order_id").distinct().count()
    counts = materialize(lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_orders))
    rest = lines.join(counts.select("product_id"), "product_id", "left_semi")
    several = rest.groupBy("order_id").agg(F.count(F.lit(1)).alias("_of")).where("_of > 1").select("order_id")
    rest = materialize(rest.join(several, "order_id", "left_semi"))
    a = rest.withColumnRenamed("product_id", "product_a")
    b = rest.withColumnRenamed("product_id", "product_b")
    pairs = a.join(b, "order_id").where(F.col("product_a") < F.col("product_b")).groupBy("product_a", "product_b").agg(
        F.count(F.lit(1)).alias("orders")
    ).where(F.col("orders") >= min_orders)
    of = lambda side: counts.select(F.col("product_id").alias(f"product_{side}"), F.col("n").alias(f"_n{side}"))
    confidence = F.col("orders") / F.col("_na")
    return pairs.join(of("a"), "product_a").join(of("b"), "product_b").select(
        "product_a", "product_b", "orders", confidence.alias("confidence"),
        (F.col("orders").cast("double") * total / (F.col("_na").cast("double") * F.col("_nb"))).alias("lift"),
    )
