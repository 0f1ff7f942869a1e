"""Event streams: parse, route, dead letters, order state, page views, counters.

Every function takes a batch or a streaming frame of ``(topic, value)`` rows, ``value``
being JSON text, unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from merclake.functions.columns import date_key, present
from merclake.sources.writers import insert_ignore, read_table

# Event types per family, schemas and required fields.
ORDER_EVENTS = [
    "order_created", "order_updated", "order_cancelled", "payment_received", "shipment_created", "shipment_delivered",
]
CLICK_EVENTS = [
    "page_view", "product_view", "add_to_cart", "remove_from_cart", "checkout_started", "checkout_completed",
]
USER_EVENTS = ["user_registered", "user_login"]
CART_EVENTS = ["add_to_cart", "remove_from_cart"]

ENVELOPE = "event_id STRING, event_type STRING, event_timestamp TIMESTAMP, source STRING, version STRING"
ORDER_FIELDS = (
    "order_id STRING, customer_id STRING, total_amount DOUBLE, currency STRING, items ARRAY<MAP<STRING, STRING>>, "
    "status STRING, payment_method STRING, shipping_address MAP<STRING, STRING>"
)
CLICK_FIELDS = (
    "session_id STRING, visitor_id STRING, customer_id STRING, page_url STRING, page_path STRING, page_title STRING, "
    "referrer_url STRING, utm_source STRING, utm_medium STRING, utm_campaign STRING, device_type STRING, "
    "browser STRING, product_id STRING, product_name STRING"
)
CART_FIELDS = (
    "session_id STRING, customer_id STRING, product_id STRING, product_name STRING, quantity INT, unit_price DOUBLE, "
    "cart_total DOUBLE"
)
REQUIRED = {
    "order": ["event_timestamp", "order_id", "customer_id", "total_amount"],
    "click": ["event_timestamp", "session_id", "visitor_id", "page_url", "page_path"],
    "user": ["event_timestamp"],
    "cart": ["event_timestamp", "session_id", "product_id", "product_name", "quantity", "unit_price"],
}
DEFAULTS = {"source": "ecommerce-platform", "version": "1.0", "currency": "USD"}
PARSE_ERROR = "Event parsing failed"

SCHEMAS = {
    "order": f"{ENVELOPE}, {ORDER_FIELDS}",
    "click": f"{ENVELOPE}, {CLICK_FIELDS}",
    "user": ENVELOPE,
    "cart": f"{ENVELOPE}, {CART_FIELDS}",
}


def family_of(event_type: Column) -> Column:
    """The family follows from the event type alone, whatever topic it came on."""
    return (
        F.when(event_type.isin(ORDER_EVENTS), "order")
        .when(event_type.isin(CLICK_EVENTS), "click")
        .when(event_type.isin(USER_EVENTS), "user")
    )


def _fields(family: str) -> list[str]:
    return T._parse_datatype_string(SCHEMAS[family]).fieldNames()


#: Columns that say where a message lay in its source, where there are some.
ORIGIN = ["partition", "offset"]


def own_id(raw: DataFrame) -> Column:
    """An id for a message that comes without one: a digest of its topic, its text and its place in the source. The same
    message read again gets the same id, so replays stay recognisable; a source without places cannot tell
    two messages of equal text apart."""
    return F.concat(F.lit("own-"), F.md5(F.concat_ws("\n", "topic", *[F.col(c).cast("string") for c in present(raw, ORIGIN)], "value")))


def parse_events(raw: DataFrame) -> DataFrame:
    """Add ``event_type, family, event`` (a struct over the fields of all families) and
    ``error``. A row with broken JSON, an unknown type, or a missing required field has an
    error and keeps its text for the dead letters. An event without an id gets one (:func:`own_id`)."""
    every = ", ".join([ENVELOPE, ORDER_FIELDS, ", ".join(
        f for f in CLICK_FIELDS.split(", ") if not f.startswith("customer_id ")
    )])
    # exploding a one-element array keeps later filters from repeating the JSON parse
    event = F.explode(F.array(F.from_json("value", every, {"mode": "PERMISSIVE"})))
    out = raw.select("*", event.alias("_e")).withColumn("event_type", F.col("_e.event_type"))
    out = out.withColumn("family", family_of(F.col("event_type")))
    lacking = F.lit(False)
    for name in ("order", "click", "user"):
        for field in REQUIRED[name]:
            lacking = lacking | ((F.col("family") == name) & F.col(f"_e.{field}").isNull())
    broken = F.col("family").isNull() | lacking
    defaults = F.col("_e").withField("event_id", F.coalesce("_e.event_id", own_id(raw)))
    for field, value in DEFAULTS.items():
        defaults = defaults.withField(field, F.coalesce(F.col(f"_e.{field}"), F.lit(value)))
    return out.withColumn("error", F.when(F.coalesce(broken, F.lit(True)), F.lit(PARSE_ERROR))).withColumn(
        "event", F.when(F.col("error").isNull(), defaults)
    ).drop("_e")


def of_family(parsed: DataFrame, family: str) -> DataFrame:
    """The valid events of one family with the columns of its schema."""
    valid = parsed.where(F.col("error").isNull() & (F.col("family") == family))
    return valid.select(*[F.col(f"event.{f}").alias(f) for f in _fields(family)])


def cart_events(raw: DataFrame) -> DataFrame:
    """Cart additions and removals with quantity, price and cart total; incomplete ones are left out."""
    parsed = raw.select(F.explode(F.array(F.from_json("value", SCHEMAS["cart"]))).alias("e")).select("e.*")
    complete = F.col("event_type").isin(CART_EVENTS)
    for field in REQUIRED["cart"]:
        complete = complete & F.col(field).isNotNull()
    return parsed.where(complete)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select(
        F.concat("topic", F.lit(".dlq")).alias("dead_letter_topic"),
        F.col("topic").alias("original_topic"),
        F.col("value").alias("original_data"),
        "error",
        F.current_timestamp().alias("failed_at"),
    )


def event_counts(parsed: DataFrame) -> DataFrame:
    """Events per topic and status."""
    status = F.when(F.col("error").isNull(), "success").otherwise("error")
    return parsed.groupBy("topic", status.alias("status")).agg(F.count(F.lit(1)).alias("events"))


def drop_replayed(events: DataFrame) -> DataFrame:
    """One event per ``event_id`` of a batch. A stream needs a sink that knows what it has stored (:func:`write_once`):
    a memory bounded by a watermark would drop late events that were never seen."""
    if events.isStreaming:
        raise ValueError("use write_once as the sink of a stream")
    return events.dropDuplicates(["event_id"])


_CREATED = {"customer_id": "customer_id", "total_amount": "total_amount", "currency": "currency_code"}


def order_facts(orders: DataFrame) -> DataFrame:
    """What a set of events says about each order: its creation (the earliest), the newest status, whether it was
    paid. Facts of several sets merge by :func:`merge_facts` in any order, and repeated events change nothing."""
    kind, stamp = F.col("event_type"), F.struct("event_timestamp", "event_id")
    new_status = (
        F.when(kind == "order_created", "pending")
        .when(kind == "order_updated", F.col("status"))
        .when(kind == "order_cancelled", "cancelled")
        .when(kind == "shipment_created", "shipped")
        .when(kind == "shipment_delivered", "delivered")
    )
    is_new = kind == "order_created"
    return orders.withColumn("_s", new_status).groupBy(F.col("order_id").alias("order_number")).agg(
        *[F.min_by(F.when(is_new, F.col(c)), F.when(is_new, stamp)).alias(name) for c, name in _CREATED.items()],
        F.min(F.when(is_new, stamp)).alias("created_at"),
        F.max_by("_s", F.when(F.col("_s").isNotNull(), stamp)).alias("status"),
        F.max(F.when(F.col("_s").isNotNull(), stamp)).alias("status_at"),
        F.coalesce(F.max(kind == "payment_received"), F.lit(False)).alias("is_paid"),
        F.max("event_timestamp").alias("updated_at"),
    )


def merge_facts(facts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per order from facts of several batches. ``by`` names further columns that an order never changes."""
    return facts.groupBy(*(by or []), "order_number").agg(
        *[F.min_by(c, "created_at").alias(c) for c in _CREATED.values()],
        F.min("created_at").alias("created_at"), F.max_by("status", "status_at").alias("status"), F.max("status_at").alias("status_at"),
        F.max("is_paid").alias("is_paid"), F.max("updated_at").alias("updated_at"),
    )


def order_state(facts: DataFrame) -> DataFrame:
    """Order-table rows from merged facts. Status and payment follow event time, not arrival; ties go to the larger
    event id. An order without a creation event is not shown yet; its facts wait for it."""
    known = facts.where(F.col("created_at").isNotNull())
    return known.select(
        "order_number", *_CREATED.values(), F.col("created_at.event_timestamp").alias("order_timestamp"), "status",
        F.when(F.col("is_paid"), "captured").otherwise("pending").alias("payment_status"), "updated_at",
        date_key("created_at.event_timestamp").alias("order_date_key"),
    )


def order_rows(orders: DataFrame) -> DataFrame:
    """The state of every order after its events."""
    return order_state(order_facts(orders))


def apply_order_events(facts: DataFrame, orders: DataFrame) -> DataFrame:
    """Facts after one more batch of events, which may be late, repeated, or about orders not yet created."""
    return merge_facts(facts.unionByName(order_facts(orders)))


def page_view_rows(clicks: DataFrame) -> DataFrame:
    """Click events as page views, keyed by the event id so that a replay writes the same row."""
    return clicks.select(
        F.col("event_id").alias("page_view_id"), "session_id", "visitor_id", "customer_id",
        date_key("event_timestamp").alias("date_key"), "event_timestamp", "page_url", "page_path", "page_title",
        "referrer_url", "utm_source", "utm_medium", "utm_campaign", "device_type", "browser", "product_id", "event_type",
    )


Handler = Callable[[DataFrame, int], None]


def write_batches(path: str) -> Handler:
    """Sink for ``foreachBatch``: each batch is its own partition and a repeated batch replaces
    it, so a retry after a lost driver or executor leaves every row once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    return write


def write_once(path: str, keys: list[str], time_col: str = "event_timestamp") -> Handler:
    """Sink for ``foreachBatch`` that stores every key once, however late or often it comes. Rows lie in folders by
    event day and batch; a batch reads the keys of its own days only, and a repeated batch replaces what it wrote.
    A message sent again must carry the same event time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("_day", F.coalesce(F.to_date(time_col).cast("string"), F.lit("none"))).persist()
        try:
            days = [r["_day"] for r in dated.select("_day").distinct().collect()]
            if not days:
                return
            stored = read_table(batch.sparkSession, path, dated.withColumn("batch_id", F.lit(0)).schema)
            stored = stored.where(F.col("_day").cast("string").isin(days) & (F.col("batch_id") < batch_id))
            fresh = insert_ignore(stored, dated, keys).withColumn("batch_id", F.lit(batch_id))
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "batch_id").parquet(path)
        finally:
            dated.unpersist()

    return handle


def write_facts(path: str) -> Handler:
    """Sink for order events: each batch adds its facts, so nothing that is stored is read or rewritten. Read the
    folder through :func:`merge_facts` and :func:`order_state`."""
    write = write_batches(path)
    return lambda batch, batch_id: write(order_facts(batch), batch_id)


def consume(raw: DataFrame, handlers: dict[str, Handler], checkpoint: str, available_now: bool = False):
    """Start the stream that routes events to handlers by family (``order``, ``click``, ``user``),
    broken ones to ``dead_letter`` and counts to ``counts``. A family without a handler is
    accepted and dropped. The offsets are committed after all handlers of a batch returned."""

    def route(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch).persist()
        try:
            for family in ("order", "click", "user"):
                if family in handlers:
                    handlers[family](drop_replayed(of_family(parsed, family)), batch_id)
            if "dead_letter" in handlers:
                handlers["dead_letter"](dead_letters(parsed), batch_id)
            if "counts" in handlers:
                handlers["counts"](event_counts(parsed), batch_id)
        finally:
            parsed.unpersist()

    writer = raw.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
