"""Cleaning of raw frames. Steps skip columns that a frame does not have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from merclake.functions.columns import nan_to_null, present, title_case
from merclake.functions.ranks import cuts
from merclake.functions.sequence import first_per_key

# Accepted date formats (tried in this order), currency signs, the e-mail
# pattern and the NULL defaults of each data type.
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd-MM-yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
]
WHITE_SPACE = " \t\n\x0b\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SIGNS = "$€£¥,"
CURRENCY_SIGNS = f"[{SIGNS}]"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
ORDER_DATES = ["order_date", "order_timestamp", "ship_date", "created_at", "updated_at"]
ORDER_AMOUNTS = ["subtotal", "total_amount", "discount_amount", "tax_amount", "shipping_amount"]
ORDER_DEFAULTS = {"discount_amount": 0.0, "tax_amount": 0.0, "shipping_amount": 0.0, "item_count": 1}
CUSTOMER_DEFAULTS = {"total_orders": 0, "lifetime_value": 0.0}
PRODUCT_PRICES = ["unit_price", "cost_price"]
PRODUCT_DEFAULTS = {"stock_quantity": 0, "review_count": 0, "avg_rating": 0.0, "is_active": True}


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.withColumns(exprs) if exprs else df


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def trim_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip all leading and trailing white space, tabs and line ends included. A text without any at its ends is
    passed on as it is, which costs a fraction of a strip."""
    names = present(df, columns) if columns else [c for c, t in df.dtypes if t == "string"]
    blank = lambda c, place: F.substring(c, place, 1).isin(*WHITE_SPACE)
    return _replace(df, {c: F.when(blank(c, 1) | blank(c, -1), _strip(F.col(c))).otherwise(F.col(c)) for c in names})


def normalize_case(df: DataFrame, columns: list[str], case: str = "lower") -> DataFrame:
    how = {"lower": F.lower, "upper": F.upper, "title": title_case}
    if case not in how:
        raise ValueError(f"unknown case: {case}")
    return _replace(df, {c: how[case](F.col(c)) for c in present(df, columns)})


def remove_duplicates(df: DataFrame, subset: list[str] | None = None, order_by: list[Column] | None = None) -> DataFrame:
    """Whole-row duplicates, or the first row per ``subset`` by ``order_by`` (ties by row content)."""
    if not subset:
        return df.dropDuplicates()
    return first_per_key(df, subset, order_by or [])


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def parse_timestamp(c: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """First format that fits the value; NULL when none does.

    The default formats are told apart by their shape and turned into ISO text, so that a
    value is parsed once; trying formats in turn costs an exception per miss."""
    if formats != DATE_FORMATS:
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    turned = F.regexp_replace(c, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2")
    turned = F.regexp_replace(turned, r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1")
    iso = F.when(F.substring(c, 3, 1).isin("/", "-"), turned).otherwise(c)
    shape = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d{1,6})?|T\d{2}:\d{2}:\d{2})?$"
    return F.when(iso.rlike(shape), iso.try_cast("timestamp_ntz"))


def standardize_dates(df: DataFrame, columns: list[str], formats: list[str] = DATE_FORMATS) -> DataFrame:
    """Parse text dates value by value. Columns that are no text are left as they are."""
    kinds = dict(df.dtypes)
    return _replace(
        df, {c: parse_timestamp(F.col(c), formats) for c in present(df, columns) if kinds[c] == "string"}
    )


#: Digits with an optional sign, point and exponent: the texts that are amounts once signs are gone.
AMOUNT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_amount(c: Column) -> Column:
    """The number a text spells; NULL for words such as NaN and for type suffixes, which a cast would take."""
    text = F.trim(F.translate(c.cast("string"), SIGNS, ""))
    return F.when(text.rlike(AMOUNT), text.try_cast("double"))


def normalize_currency(df: DataFrame, columns: list[str]) -> DataFrame:
    """Amounts as DOUBLE without currency signs and thousands separators; NULL if no number.
    Numeric columns are only cast."""
    kinds = dict(df.dtypes)
    return _replace(
        df,
        {
            c: to_amount(F.col(c)) if kinds[c] == "string" else F.col(c).cast("double")
            for c in present(df, columns)
        },
    )


def clean_email(df: DataFrame, column: str = "email") -> DataFrame:
    if column not in df.columns:
        return df
    text = _strip(F.lower(F.col(column)))
    return df.withColumn(column, text).withColumn(column, F.when(F.col(column).rlike(EMAIL_PATTERN), F.col(column)))


def clean_phone(df: DataFrame, column: str = "phone") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, F.regexp_replace(column, "[^0-9]", ""))


def clean_orders(df: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """Trim, parse dates and amounts, fill defaults, keep one row per order number, and
    drop rows with a negative or missing amount."""
    df = trim_strings(df)
    df = standardize_dates(df, ORDER_DATES)
    df = normalize_currency(df, ORDER_AMOUNTS)
    df = fill_nulls(df, ORDER_DEFAULTS)
    if "order_number" in df.columns:
        df = remove_duplicates(df, ["order_number"], order_by)
    for c in present(df, ORDER_AMOUNTS):
        df = df.where(F.col(c) >= 0)
    return df


def clean_customers(df: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    df = clean_phone(clean_email(trim_strings(df)))
    df = normalize_case(df, ["first_name", "last_name"], "title")
    df = normalize_case(df, ["country"], "upper")
    df = fill_nulls(df, CUSTOMER_DEFAULTS)
    return remove_duplicates(df, ["customer_key"], order_by) if "customer_key" in df.columns else df


def clean_products(df: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    df = normalize_currency(trim_strings(df), PRODUCT_PRICES)
    df = fill_nulls(df, PRODUCT_DEFAULTS)
    for c in present(df, PRODUCT_PRICES):
        df = df.where(F.col(c) > 0)
    return remove_duplicates(df, ["sku"], order_by) if "sku" in df.columns else df


def clean_dataframe(df: DataFrame, data_type: str = "generic") -> DataFrame:
    by_type = {"orders": clean_orders, "customers": clean_customers, "products": clean_products}
    if data_type in by_type:
        return by_type[data_type](df)
    return remove_duplicates(trim_strings(df))


class CleaningRules:
    """Named DataFrame -> DataFrame steps: the built-in ones and any the user adds."""

    def __init__(self) -> None:
        self._rules: dict[str, Callable[..., DataFrame]] = {
            "trim_strings": trim_strings,
            "normalize_case": normalize_case,
            "remove_duplicates": remove_duplicates,
            "fill_nulls": fill_nulls,
            "standardize_dates": standardize_dates,
            "normalize_currency": normalize_currency,
            "clean_email": clean_email,
            "clean_phone": clean_phone,
        }

    def register(self, name: str, func: Callable[..., DataFrame]) -> None:
        self._rules[name] = func

    def apply(self, df: DataFrame, steps: list) -> DataFrame:
        """``steps`` holds rule names or (name, keyword arguments) pairs."""
        for step in steps:
            name, args = step if isinstance(step, tuple) else (step, {})
            df = df.transform(self._rules[name], **args)
        return df


def _fences(df: DataFrame, column: str, threshold: float, interpolation: str) -> tuple[Column, Column]:
    q1, q3 = cuts(df, {column: [0.25, 0.75]}, interpolation)[column]
    if q1 is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    return F.lit(q1 - threshold * (q3 - q1)), F.lit(q3 + threshold * (q3 - q1))


def detect_outliers(
    df: DataFrame, column: str, method: str = "iqr", threshold: float = 1.5, interpolation: str = "nearest"
) -> DataFrame:
    """Add ``_is_outlier``: outside the quartile fences, or more than ``threshold`` sample
    standard deviations from the mean. The bounds are computed first, from the column alone."""
    if column not in df.columns:
        return df
    x = nan_to_null(F.col(column).cast("double"))
    if method == "iqr":
        low, high = _fences(df, column, threshold, interpolation)
        flag = (x < low) | (x > high)
    elif method == "zscore":
        row = df.agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")).first()
        flag = F.abs(F.try_divide(x - F.lit(row["mean"]).cast("double"), F.lit(row["std"]).cast("double"))) > threshold
    else:
        raise ValueError(f"unknown method: {method}")
    return df.withColumn("_is_outlier", flag)


def handle_outliers(
    df: DataFrame, column: str, strategy: str = "clip", method: str = "iqr", threshold: float = 1.5,
    lower: float | None = None, upper: float | None = None, replacement_value: float | None = None,
    interpolation: str = "nearest",
) -> DataFrame:
    """``clip`` to the fences (or given bounds), ``remove`` outliers, or ``replace`` them by the
    median (or a given value)."""
    if column not in df.columns:
        return df
    if strategy == "clip":
        low, high = (None, None) if lower is not None and upper is not None else _fences(df, column, threshold, interpolation)
        low = F.lit(float(lower)) if lower is not None else low
        high = F.lit(float(upper)) if upper is not None else high
        bounded = F.when(F.col(column).isNotNull(), F.least(F.greatest(F.col(column), low), high))
        return df.withColumn(column, bounded)
    flagged = detect_outliers(df, column, method, threshold, interpolation)
    if strategy == "remove":
        return flagged.where(~F.col("_is_outlier")).drop("_is_outlier")
    if strategy == "replace":
        other = replacement_value if replacement_value is not None else cuts(df, {column: [0.5]}, "linear")[column][0]
        return flagged.withColumn(
            column, F.when(F.col("_is_outlier"), F.lit(other).cast("double")).otherwise(F.col(column))
        ).drop("_is_outlier")
    raise ValueError(f"unknown strategy: {strategy}")


def clip(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(column, F.least(F.greatest(F.col(column), F.lit(low)), F.lit(high)))


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Fill NULLs of every numeric column."""
    return df.na.fill(value)


#: The text form of a time that needs no correction.
PLAIN_TIME = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def cleaning_stats(
    raw: DataFrame, cleaned: DataFrame, key: str, filled: dict, parsed: list[str], dates: list[str] | None = None,
    outlier_flag: str | None = None,
) -> DataFrame:
    """One row: rows before and after, NULLs filled, surplus rows per key, values whose text changed when parsed as an
    amount or a time, and the rows that ``outlier_flag`` of the cleaned frame marks. Each input is read once."""
    changed = [
        F.count_if(F.col(c).cast("string").rlike(CURRENCY_SIGNS + r"|^\s|\s$")) for c in present(raw, parsed)
    ] + [F.count_if(~F.col(c).cast("string").rlike(PLAIN_TIME)) for c in present(raw, dates or [])]
    nulls = [F.count_if(F.col(c).isNull()) for c in present(raw, list(filled))]
    zero = F.lit(0).cast("bigint")
    before = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        sum(nulls, zero).alias("nulls_filled"),
        (F.count(key) - F.count_distinct(_strip(F.col(key).cast("string")))).alias("duplicates_removed"),
        sum(changed, zero).alias("format_corrections"),
    )
    marked = F.count_if(outlier_flag) if outlier_flag else F.lit(0).cast("bigint")
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_after_cleaning"), marked.alias("outliers_handled"))
    # one row beside one row
    return before.withColumn("_one", F.lit(1)).join(after.withColumn("_one", F.lit(1)), "_one").drop("_one")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills in when a later action runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
