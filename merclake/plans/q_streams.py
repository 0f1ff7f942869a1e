"""Event and time-window queries, as batch frames and as streams over the event files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merclake.plans import star
from merclake.plans.registry import PV, SQL, SV, query, total, with_
from merclake.session import shared_dir
from merclake.sources.readers import read_event_files
from merclake.sources.keyed import Keyed
from merclake.sources.ledger import Ledger
from merclake.streaming import events as ev, state, windows as win

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
PARSED = """pe AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'orders' WHEN event_type IN ('view', 'click') THEN 'clickstream' ELSE 'events' END AS topic,
 CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'order_created' WHEN 'signup' THEN 'user_registered' END AS kind,
 CASE event_type WHEN 'view' THEN 'click' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'user' END AS family,
 event_type = 'error' AS bad, user_id, ts, value, regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS k FROM events)"""


@query(
    "parse_events",
    with_(PARSED) + """SELECT topic, kind AS event_type, family, CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp,
 CAST(user_id AS VARCHAR) AS customer_id, 'ecommerce-platform' AS source, '1.0' AS version FROM pe WHERE NOT bad""",
)
def parse_events(spark, d):
    parsed = ev.parse_events(star.raw_events(spark, d)).where(F.col("error").isNull())
    return parsed.select(
        "topic", "event_type", "family", "event.event_id", F.col("event.event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        "event.customer_id", "event.source", "event.version",
    )


@query(
    "event_counts",
    with_(PARSED) + "SELECT topic, CASE WHEN bad THEN 'error' ELSE 'success' END AS status, count(*) AS events FROM pe GROUP BY 1, 2",
)
def event_counts(spark, d):
    return ev.event_counts(ev.parse_events(star.raw_events(spark, d)))


@query(
    "dead_letters",
    with_(PARSED) + """SELECT 'events.dlq' AS dead_letter_topic, 'events' AS original_topic, 'Event parsing failed' AS error,
 event_id % 2 = 0 AS broken, count(*) AS events FROM pe WHERE bad GROUP BY 4""",
)
def dead_letters(spark, d):
    letters = ev.dead_letters(ev.parse_events(star.raw_events(spark, d)))
    broken = F.col("original_data") == "{error"
    return letters.groupBy("dead_letter_topic", "original_topic", "error", broken.alias("broken")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    "order_events_state",
    """WITH p AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT 'ORD-' || event_id AS order_number, CAST(user_id AS VARCHAR) AS customer_id, value AS total_amount, 'USD' AS currency_code,
 ts AS order_timestamp, CASE WHEN event_id % 5 = 0 THEN 'cancelled' WHEN event_id % 7 = 0 THEN 'shipped'
 WHEN event_id % 2 = 0 THEN 'processing' ELSE 'pending' END AS status, CASE WHEN event_id % 3 = 0 THEN 'captured' ELSE 'pending' END AS payment_status,
 CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS order_date_key FROM p""",
)
def order_events_state(spark, d):
    orders = ev.of_family(ev.parse_events(star.raw_order_events(spark, d)), "order")
    out = ev.order_rows(orders).drop("updated_at")
    return out.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


@query("order_events_in_two_batches", SQL["order_events_state"])
def order_events_in_two_batches(spark, d):
    """The same state when updates, cancellations and payments come before the creations, and some come twice."""
    orders = ev.of_family(ev.parse_events(star.raw_order_events(spark, d)), "order")
    early = orders.where(F.col("event_type") != "order_created")
    facts = ev.apply_order_events(ev.order_facts(early), orders.where(F.col("event_type").isin("order_created", "order_updated")))
    return ev.order_state(facts).drop("updated_at").withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


@query(
    "click_event_rows",
    with_(PARSED) + """SELECT CAST(event_id AS VARCHAR) AS page_view_id, 's-' || user_id AS session_id, CAST(user_id AS VARCHAR) AS visitor_id,
 CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, 'http://store.com/p/' || k AS page_url, '/p/' || k AS page_path, k AS product_id,
 kind AS event_type FROM pe WHERE family = 'click'""",
)
def click_event_rows(spark, d):
    clicks = ev.of_family(ev.parse_events(star.raw_events(spark, d)), "click")
    return ev.page_view_rows(clicks).select(
        "page_view_id", "session_id", "visitor_id", "date_key", "page_url", "page_path", "product_id", "event_type"
    )


@query(
    "cart_events",
    with_(PARSED) + """SELECT CAST(event_id AS VARCHAR) AS event_id, 's-' || user_id AS session_id, k AS product_id, 'item ' || k AS product_name,
 1 AS quantity, value AS unit_price FROM pe WHERE kind = 'add_to_cart'""",
)
def cart_events(spark, d):
    return ev.cart_events(star.raw_events(spark, d)).select(
        "event_id", "session_id", "product_id", "product_name", "quantity", "unit_price"
    )


@query(
    "drop_replayed_events",
    with_(PARSED) + "SELECT family, CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM pe WHERE NOT bad",
)
def drop_replayed_events(spark, d):
    """Every message arrives twice."""
    raw = star.raw_events(spark, d)
    parsed = ev.parse_events(raw.unionByName(raw))
    parts = [
        ev.drop_replayed(ev.of_family(parsed, f)).select(
            F.lit(f).alias("family"), "event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp")
        )
        for f in ("order", "click", "user")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _sales_sql(length: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{length}', ts) AS window_start, time_bucket(INTERVAL '{length}', ts) + INTERVAL '{length}' AS window_end,
 count(*) AS orders, {total('value')} AS revenue FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""


@query("windowed_sales", _sales_sql("1 hour"))
def windowed_sales(spark, d):
    return win.windowed_sales(star.purchases(spark, d), "order_timestamp")


@query(
    "sliding_sales",
    f"""WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
s AS (SELECT time_bucket(INTERVAL '30 minutes', ts) - o AS window_start, value FROM p, (VALUES (INTERVAL 0 MINUTE), (INTERVAL 30 MINUTE)) t(o))
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, count(*) AS orders, {total('value')} AS revenue FROM s GROUP BY 1""",
)
def sliding_sales(spark, d):
    return win.windowed_sales(star.purchases(spark, d), "order_timestamp", slide="30 minutes")


@query(
    "session_windows",
    with_(PV, SV) + """SELECT visitor_id, session_start, max(event_timestamp) AS session_end, count(*) AS pages,
 (epoch_us(max(event_timestamp)) - epoch_us(session_start)) / CAST(1000000 AS DOUBLE) AS duration_seconds FROM sv GROUP BY 1, 2""",
)
def session_windows(spark, d):
    return win.session_windows(star.page_views(spark, d))


@query("sessionize", with_(PV, SV) + "SELECT * FROM sv")
def sessionize(spark, d):
    return star.session_views(spark, d)


@query(
    "funnel",
    with_(PV, """a AS (SELECT visitor_id, min(event_timestamp) AS t FROM pv WHERE event_type = 'view' GROUP BY 1),
b AS (SELECT visitor_id, min(event_timestamp) AS t FROM pv JOIN a USING (visitor_id) WHERE event_type = 'click' AND event_timestamp > a.t GROUP BY 1),
c AS (SELECT visitor_id, min(event_timestamp) AS t FROM pv JOIN b USING (visitor_id) WHERE event_type = 'purchase' AND event_timestamp > b.t GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM c) AS n3)""")
    + """SELECT 1 AS step, 'view' AS event_type, n1 AS units, CAST(n1 AS DOUBLE) / n1 AS conversion FROM n UNION ALL
 SELECT 2, 'click', n2, CAST(n2 AS DOUBLE) / n1 FROM n UNION ALL SELECT 3, 'purchase', n3, CAST(n3 AS DOUBLE) / n1 FROM n""",
)
def funnel(spark, d):
    return win.funnel(star.page_views(spark, d), "visitor_id", "event_timestamp", "event_type", ["view", "click", "purchase"])


@query(
    "session_funnel",
    with_(PV, SV, """a AS (SELECT session_id, min(event_timestamp) AS t FROM sv WHERE event_type = 'view' GROUP BY 1),
b AS (SELECT session_id, min(event_timestamp) AS t FROM sv JOIN a USING (session_id) WHERE event_type = 'click' AND event_timestamp > a.t GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2)""")
    + """SELECT 1 AS step, 'view' AS event_type, n1 AS units, CAST(n1 AS DOUBLE) / n1 AS conversion FROM n UNION ALL
 SELECT 2, 'click', n2, CAST(n2 AS DOUBLE) / n1 FROM n""",
)
def session_funnel(spark, d):
    return win.funnel(star.session_views(spark, d), "session_id", "event_timestamp", "event_type", ["view", "click"])


# Stand-in for the traffic source of a touch: the event type of the visitor's last view or click.
_TOUCH = """l AS (SELECT event_id AS order_id, user_id AS customer_id, ts AS order_timestamp, value AS total_amount,
 (SELECT arg_max(t.event_type, (t.ts, t.event_type)) FROM events t WHERE t.user_id = e.user_id AND t.event_type IN ('view', 'click') AND t.ts <= e.ts) AS attributed_source
 FROM events e WHERE event_type = 'purchase')"""


def _attributed(spark, d) -> DataFrame:
    touches = star.page_views(spark, d).where(F.col("event_type").isin("view", "click"))
    return win.last_touch(star.purchases(spark, d), touches, source="event_type")


@query("last_touch", with_(_TOUCH) + "SELECT * FROM l")
def last_touch(spark, d):
    return _attributed(spark, d)


@query(
    "attribution_report",
    with_(_TOUCH) + f"SELECT attributed_source, count(*) AS orders, {total('total_amount')} AS revenue FROM l GROUP BY 1",
)
def attribution_report(spark, d):
    return win.attribution_report(_attributed(spark, d))


# --- streams -----------------------------------------------------------------------

def _stream(spark, d) -> DataFrame:
    return read_event_files(spark, d, EVENTS_SCHEMA, "events.parquet")


def _messages(rows: DataFrame) -> DataFrame:
    """Order messages from streamed purchase rows."""
    value = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.lit("order_created").alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.concat(F.lit("ORD-"), F.col("event_id").cast("string")).alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("total_amount"),
    ))
    return rows.where(F.col("event_type").isin("purchase", "error")).select(F.lit("orders").alias("topic"), value.alias("value"))


@query(
    "stream_consume_orders",
    """SELECT 'ORD-' || event_id AS order_id, CAST(user_id AS VARCHAR) AS customer_id, value AS total_amount, 'USD' AS currency FROM events
 WHERE event_type = 'purchase'""",
)
def stream_consume_orders(spark, d):
    """Messages routed by the stream consumer; those without an amount go to the dead letters."""
    root = shared_dir(spark, "consume")
    handlers = {
        "order": ev.write_once(f"{root}/orders", ["event_id"]), "dead_letter": ev.write_batches(f"{root}/dlq"),
        "counts": ev.write_batches(f"{root}/counts"),
    }
    ev.consume(_messages(_stream(spark, d)), handlers, f"{root}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/orders").select("order_id", "customer_id", "total_amount", "currency")


@query(
    "stream_dead_letters",
    """SELECT 'orders.dlq' AS dead_letter_topic, 'orders' AS original_topic, 'Event parsing failed' AS error,
 '{"event_id":"' || event_id || '","event_type":"order_created","event_timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
 || '","order_id":"ORD-' || event_id || '","customer_id":"' || user_id || '"}' AS original_data FROM events WHERE event_type = 'error'""",
)
def stream_dead_letters(spark, d):
    root = shared_dir(spark, "consume")
    handlers = {"dead_letter": ev.write_batches(f"{root}/dlq")}
    ev.consume(_messages(_stream(spark, d)), handlers, f"{root}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/dlq").select("dead_letter_topic", "original_topic", "error", "original_data")


#: Rows of an input file. Larger inputs have more files, not larger ones, and a batch takes as many more.
FILE_ROWS = 50_000


def _files_of(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def _deal(raw: DataFrame, again: DataFrame, part: Column, again_part: int, path: str) -> int:
    """Write messages as eight parts by ``part`` (0 to 7), with further ones in part ``again_part``. A part is one
    file, or as many as its share of the rows needs; returns that number."""
    files = _files_of(-(-raw.count() // 8))
    file = lambda part: (part * files + F.pmod(F.xxhash64("value", F.lit(2)), F.lit(files))).cast("int")
    dealt = raw.withColumn("file", file(part)).unionByName(again.withColumn("file", file(F.lit(again_part))))
    dealt.repartitionById(8 * files, "file").select("topic", "value").write.parquet(path)
    return files


@query("stream_order_state", SQL["order_events_state"])
def stream_order_state(spark, d):
    """The order messages, dealt over eight parts whatever their order, read part by part; every fifth message is
    sent again in the first part."""
    root = shared_dir(spark, "orders")
    raw = star.raw_order_events(spark, d).select("topic", "value")
    again = raw.where(F.pmod(F.xxhash64("value", F.lit(1)), F.lit(5)) == 0)
    files = _deal(raw, again, F.pmod(F.xxhash64("value"), F.lit(8)), 0, f"{root}/messages")
    messages = read_event_files(spark, f"{root}/messages", "topic STRING, value STRING", "*.parquet", files_per_trigger=files)
    ev.consume(messages, {"order": ev.write_facts(f"{root}/facts")}, f"{root}/checkpoint", available_now=True).awaitTermination()
    state = ev.order_state(ev.merge_facts(spark.read.parquet(f"{root}/facts")))
    return state.drop("updated_at").withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


@query("stream_order_facts", SQL["order_events_state"])
def stream_order_facts(spark, d):
    """The same messages into a ledger, whose buckets are folded every third batch."""
    root = shared_dir(spark, "orders")
    raw = star.raw_order_events(spark, d).select("topic", "value")
    part = F.pmod(F.xxhash64("value"), F.lit(8))
    files = _deal(raw, raw.where(part == 3), part, 3, f"{root}/messages")
    messages = read_event_files(spark, f"{root}/messages", "topic STRING, value STRING", "*.parquet", files_per_trigger=2 * files)
    ledger = Ledger(spark, f"{root}/ledger")
    ev.consume(messages, {"order": state.keep_order_facts(ledger, buckets=8, fold=2)}, f"{root}/checkpoint", available_now=True).awaitTermination()
    return state.stored_order_state(ledger).drop("updated_at").withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


_NO_ID = """m AS (SELECT *, '{"event_type":"order_created","event_timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","order_id":"ORD-' || event_id
 || '","customer_id":"' || user_id || '","total_amount":1.5}' AS msg FROM events WHERE event_type = 'purchase')"""


@query(
    "events_without_id",
    with_(_NO_ID) + """SELECT 'own-' || md5('orders' || chr(10) || msg) AS event_id, 'ORD-' || event_id AS order_id, CAST(user_id AS VARCHAR) AS customer_id FROM m""",
)
def events_without_id(spark, d):
    """Messages that carry no id, some of them sent twice: none is lost, none stays double."""
    rows = star.table(spark, d, "events").where("event_type = 'purchase'")
    value = F.to_json(F.struct(
        F.lit("order_created").alias("event_type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.concat(F.lit("ORD-"), F.col("event_id").cast("string")).alias("order_id"), F.col("user_id").cast("string").alias("customer_id"),
        F.lit(1.5).alias("total_amount"),
    ))
    raw = rows.select(F.lit("orders").alias("topic"), value.alias("value"))
    again = raw.where(F.pmod(F.xxhash64("value"), F.lit(4)) == 0)
    return ev.drop_replayed(ev.of_family(ev.parse_events(raw.unionByName(again)), "order")).select("event_id", "order_id", "customer_id")


def _run_append(df: DataFrame, spark, name: str) -> DataFrame:
    """Run a stream to the end of its files and read what it has emitted."""
    root = shared_dir(spark, name)
    (
        df.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(df.schema).parquet(f"{root}/rows")


@query(
    "stream_windowed_sales",
    f"""WITH w AS ({_sales_sql('1 hour')}), m AS (SELECT max(ts) AS t FROM events WHERE event_type = 'purchase')
SELECT w.* FROM w, m WHERE window_end <= date_trunc('millisecond', t - INTERVAL 10 MINUTE)""",
)
def stream_windowed_sales(spark, d):
    """The windows that are closed when the files end."""
    bought = _stream(spark, d).where(F.col("event_type") == "purchase").select(
        F.col("ts").alias("order_timestamp"), F.col("value").alias("total_amount")
    )
    return _run_append(win.windowed_sales(bought, "order_timestamp"), spark, "sales")


def _sent_twice(spark, rows: DataFrame, path: str) -> DataFrame:
    """Events as a stream of two batches, whatever the number of their files: half of the rows, then all of them, which
    bring the other half, and the first half again."""
    half = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0)
    files = _files_of(rows.count())
    for part in (half, rows):
        part.repartition(files).write.mode("append").parquet(path)
    return read_event_files(spark, path, "event_id STRING, event_type STRING, event_timestamp TIMESTAMP", "*.parquet", files_per_trigger=files)


@query(
    "stream_page_views",
    "SELECT CAST(event_id AS VARCHAR) AS page_view_id, event_type, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events",
)
def stream_page_views(spark, d):
    """Events stored once each, although the stream sees every one twice, in two batches."""
    root = shared_dir(spark, "views")
    rows = star.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("ts").cast("timestamp").alias("event_timestamp")
    )
    stream = _sent_twice(spark, rows, f"{root}/in")
    sink = ev.write_once(f"{root}/rows", ["event_id"])
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/rows").select(
        F.col("event_id").alias("page_view_id"), "event_type", star.date_key("event_timestamp").alias("date_key")
    )


@query("stream_new_events", SQL["stream_page_views"])
def stream_new_events(spark, d):
    """The same events, told by the index of a keyed table."""
    root = shared_dir(spark, "views")
    rows = star.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("ts").cast("timestamp").alias("event_timestamp")
    )
    stream = _sent_twice(spark, rows, f"{root}/in")
    ledger, spec = Ledger(spark, f"{root}/ledger"), Keyed("events", ("event_id",), buckets=8, blocks=256)
    stream.writeStream.foreachBatch(state.keep_new(ledger, spec, "views")).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return ledger.read("events").select(F.col("event_id").alias("page_view_id"), "event_type", star.date_key("event_timestamp").alias("date_key"))
