"""Data-quality checks: declare them, run them all in one aggregation, read a result frame.

Result columns: position, name, passed, severity, message, failed_rows, total_rows, details.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from merclake.functions.columns import nan_to_null
from merclake.functions.ranks import cuts

# Statuses of an order, the pattern of a stored e-mail hash, and the least
# value that counts as positive when zero is not allowed.
ORDER_STATUSES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded"]
EMAIL_HASH_PATTERN = r"^[a-f0-9]{64}$"
LEAST_POSITIVE = 0.0001

RESULT = (
    "position int, name string, passed boolean, severity string, message string, "
    "failed_rows bigint, total_rows bigint, details string"
)


@dataclass(frozen=True)
class Check:
    name: str
    column: str | None
    severity: str
    failed: Callable[[DataFrame], Column] | None  # aggregate: number of failing rows
    total: Callable[[], Column]  # aggregate: number of rows looked at
    reason: str  # what is wrong with a failing row
    details: str = ""


def _message(failed: Column, total: Column, reason: str) -> Column:
    bad = F.concat(failed.cast("string"), F.lit(" of "), total.cast("string"), F.lit(f" rows: {reason}"))
    return F.when(failed == 0, F.lit("ok")).otherwise(bad)


def _rows() -> Column:
    return F.count(F.lit(1))


class Suite:
    """A list of checks. Every ``add`` returns the suite itself."""

    def __init__(self, strict: bool = False) -> None:
        self.strict = strict
        self._checks: list[Check | tuple] = []

    def _add(self, *args, **kw) -> Suite:
        self._checks.append(Check(*args, **kw))
        return self

    def not_null(self, column: str, severity: str = "error") -> Suite:
        return self._add(
            f"not_null_{column}", column, severity, lambda df: F.count_if(F.col(column).isNull()), _rows,
            f"{column} is missing",
        )

    def unique(self, column: str, severity: str = "error") -> Suite:
        """Rows minus distinct values; NULL counts as one value."""

        def surplus(df: DataFrame) -> Column:
            has_null = F.max(F.col(column).isNull().cast("bigint"))
            return _rows() - F.count_distinct(F.col(column)) - F.coalesce(has_null, F.lit(0))

        return self._add(
            f"unique_{column}", column, severity, surplus, _rows,
            f"{column} repeats another row's",
        )

    def in_range(self, column: str, low: float | None = None, high: float | None = None, severity: str = "error") -> Suite:
        """NULL and NaN pass."""

        def outside(df: DataFrame) -> Column:
            value = F.col(column)
            if dict(df.dtypes)[column] in ("float", "double"):
                value = nan_to_null(value)
            test = F.lit(False)
            if low is not None:
                test = test | (value < low)
            if high is not None:
                test = test | (value > high)
            return F.count_if(test)

        return self._add(
            f"range_{column}", column, severity, outside, _rows,
            f"{column} lies outside {'-inf' if low is None else low} to {'inf' if high is None else high}",
            details=f"min={low}, max={high}",
        )

    def positive(self, column: str, allow_zero: bool = True, severity: str = "error") -> Suite:
        return self.in_range(column, low=0 if allow_zero else LEAST_POSITIVE, severity=severity)

    def pattern(self, column: str, regex: str, severity: str = "error") -> Suite:
        """The pattern may match anywhere in the value; NULLs are not counted."""
        return self._add(
            f"pattern_{column}", column, severity, lambda df: F.count_if(~F.col(column).rlike(regex)),
            lambda: F.count(F.col(column)), f"{column} does not fit the pattern", details=f"pattern={regex}",
        )

    def one_of(self, column: str, allowed: list, severity: str = "error") -> Suite:
        return self._add(
            f"enum_{column}", column, severity, lambda df: F.count_if(~F.col(column).isin(allowed)), _rows,
            f"{column} is not one of the allowed values",
            details="allowed=" + ",".join(map(str, allowed)),
        )

    def custom(self, name: str, test: Callable[[DataFrame], Column], message: str, severity: str = "error") -> Suite:
        """``test(df)`` returns a boolean aggregate. A test that cannot be built fails its check."""
        self._checks.append(("custom", name, test, message, severity))
        return self

    def references(self, column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> Suite:
        self._checks.append(("references", column, parent, parent_column, severity))
        return self

    def run(self, df: DataFrame) -> DataFrame:
        """One row per check. All but the reference checks share a single aggregation."""
        aggs: list[Column] = [_rows().alias("_rows")]
        rows: list[Column] = []
        fixed: list[tuple] = []
        lookups: list[DataFrame] = []
        spark = df.sparkSession

        def line(i, name, passed, severity, message, failed, total, details) -> Column:
            return F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("name"), passed.alias("passed"),
                F.lit(severity).alias("severity"), message.alias("message"),
                failed.cast("bigint").alias("failed_rows"), total.cast("bigint").alias("total_rows"),
                F.lit(details).alias("details"),
            )

        for i, check in enumerate(self._checks):
            if isinstance(check, Check):
                if check.column not in df.columns:
                    message = f"no column {check.column}"
                    fixed.append((i, check.name, False, check.severity, message, 0, 0, ""))
                    continue
                aggs += [check.failed(df).alias(f"_f{i}"), check.total().alias(f"_t{i}")]
                failed = F.coalesce(F.col(f"_f{i}"), F.lit(0))
                message = _message(failed, F.col(f"_t{i}"), check.reason)
                rows.append(
                    line(i, check.name, failed == 0, check.severity, message, failed, F.col(f"_t{i}"), check.details)
                )
            elif check[0] == "custom":
                _, name, test, message, severity = check
                try:
                    outcome = test(df).alias(f"_c{i}")
                    df.agg(outcome)  # analysis only: a wrong expression fails its own check, not the run
                except Exception as error:
                    reason = str(error).splitlines()[0]
                    fixed.append((i, name, False, severity, f"cannot be computed: {reason}", 0, 0, ""))
                    continue
                aggs.append(outcome)
                passed = F.coalesce(F.col(f"_c{i}").cast("boolean"), F.lit(False))
                text = F.when(passed, F.lit("ok")).otherwise(F.lit(message))
                rows.append(line(i, name, passed, severity, text, F.lit(0), F.col("_rows"), ""))
            else:
                _, column, parent, parent_column, severity = check
                name = f"ref_integrity_{column}"
                if column not in df.columns:
                    fixed.append((i, name, False, severity, f"no column {column}", 0, 0, ""))
                    continue
                orphans = orphan_keys(df, column, parent, parent_column)
                counts = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_bad")).withColumn(
                    "_all", df.agg(_rows()).scalar()
                )
                text = _message(F.col("_bad"), F.col("_all"), f"{column} has no parent row")
                lookups.append(
                    counts.select(
                        line(i, name, F.col("_bad") == 0, severity, text, F.col("_bad"), F.col("_all"), "").alias("r")
                    ).select("r.*")
                )
        parts = []
        if rows:
            parts.append(df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
        if fixed or not (rows or lookups):
            parts.append(spark.createDataFrame(fixed, RESULT))
        out = None
        for part in parts + lookups:
            out = part if out is None else out.unionByName(part)
        return out

    def summary(self, results: DataFrame) -> DataFrame:
        """One row: status, counts and success rate. Failed errors give ``failed``; failed
        warnings give ``partial``, or ``failed`` in strict mode."""
        bad = ~F.col("passed")
        counts = results.agg(
            F.count(F.lit(1)).alias("total_checks"),
            F.count_if("passed").alias("passed_checks"),
            F.count_if(bad & (F.col("severity") == "error")).alias("failed_checks"),
            F.count_if(bad & (F.col("severity") == "warning")).alias("warning_count"),
        )
        status = (
            F.when(F.col("failed_checks") > 0, "failed")
            .when(F.col("warning_count") > 0, "failed" if self.strict else "partial")
            .otherwise("passed")
        )
        rate = F.coalesce(F.try_divide(F.col("passed_checks") * F.lit(100.0), F.col("total_checks")), F.lit(100.0))
        return counts.withColumn("status", status).withColumn("success_rate", rate)


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``(key, rows)`` for values without a parent. Rows are counted per value first, so the
    anti join moves one row per distinct value."""
    keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(_rows().alias("rows"))
    return keys.join(parent.select(F.col(parent_column).alias("key")).distinct(), "key", "left_anti")


def orders_suite(strict: bool = False) -> Suite:
    return (
        Suite(strict)
        .not_null("order_id")
        .not_null("customer_id")
        .not_null("order_timestamp")
        .unique("order_number")
        .positive("total_amount")
        .positive("item_count", allow_zero=False)
        .in_range("discount_amount", low=0)
        .one_of("status", ORDER_STATUSES)
    )


def customers_suite(strict: bool = False) -> Suite:
    return (
        Suite(strict)
        .not_null("customer_id")
        .unique("customer_key")
        .pattern("email_hash", EMAIL_HASH_PATTERN, severity="warning")
        .in_range("lifetime_value", low=0)
        .in_range("total_orders", low=0)
    )


def products_suite(strict: bool = False) -> Suite:
    return (
        Suite(strict)
        .not_null("product_id")
        .not_null("name")
        .unique("sku")
        .positive("unit_price", allow_zero=False)
        .in_range("stock_quantity", low=0)
    )


SUITES = {"orders": orders_suite, "customers": customers_suite, "products": products_suite}


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per numeric or text column: rows, NULLs, distinct values, and for numbers min,
    max, mean, sample deviation and quartiles. One plain aggregation over typed columns gives all but the
    quartiles, which a rank search over the numbers alone finds. Distinct values are estimated (about 2 % off) unless
    ``exact_distinct`` asks for the shuffle that counting them takes."""
    numeric = [c for c, t in df.dtypes if t.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")]
    text = [c for c, t in df.dtypes if t in ("string", "boolean", "date", "timestamp", "timestamp_ntz")]
    wanted = [c for c in df.columns if c in numeric or c in text]
    quartiles = cuts(df, {c: [0.25, 0.5, 0.75] for c in numeric}, "linear") if numeric else {}
    aggs, rows = [_rows().alias("_rows")], []
    for i, c in enumerate(wanted):
        v = nan_to_null(F.col(c).cast("double")) if c in numeric else F.lit(None).cast("double")
        distinct = F.count_distinct(F.col(c)) if exact_distinct else F.approx_count_distinct(F.col(c), 0.02)
        aggs += [F.count(F.col(c)).alias(f"_n{i}"), distinct.alias(f"_d{i}")]
        aggs += [f(v).alias(f"_{name}{i}") for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))]
        q1, median, q3 = (F.lit(x).cast("double") for x in quartiles.get(c, [None] * 3))
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.col(f"_d{i}").alias("distinct_count"), *[F.col(f"_{n}{i}").alias(n) for n in ("min", "max", "mean", "std")],
            q1.alias("q1"), median.alias("median"), q3.alias("q3"),
        ))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
