"""Streams over files: routing, dead letters, replays, windows, sessions."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from merclake.streaming import events as ev, windows as win

T0 = datetime(2025, 1, 1)


def order(i, kind="order_created", minutes=0, **more):
    at = (T0 + timedelta(minutes=minutes)).isoformat(sep=" ")
    return json.dumps({"event_id": f"e{i}", "event_type": kind, "event_timestamp": at, "order_id": more.pop("order_id", f"o{i}"),
                       "customer_id": "c", "total_amount": 5.0, **more})


def click(i, **more):
    return json.dumps({"event_id": f"v{i}", "event_type": "page_view", "event_timestamp": "2025-01-01 00:00:00", "session_id": "s",
                       "visitor_id": "w", "page_url": "u", "page_path": "p", **more})


@pytest.fixture()
def messages(spark):
    return lambda *rows: spark.createDataFrame([(t, v) for t, v in rows], "topic string, value string")


def test_parse(messages):
    raw = messages(
        ("orders", order(1, items=[{"sku": "x", "qty": 2}], shipping_address={"city": "Y"})), ("orders", click(1)), ("x", "{broken"),
        ("x", json.dumps({"event_type": "party"})), ("orders", order(2, total_amount=None)),
        ("x", json.dumps({"event_type": "user_login", "event_timestamp": "2025-01-01 00:00:00"})),
    )
    rows = ev.parse_events(raw).collect()
    assert [r.family for r in rows if r.error is None] == ["order", "click", "user"]
    first = rows[0].event
    assert first["items"] == [{"sku": "x", "qty": "2"}] and first["shipping_address"] == {"city": "Y"} and first["currency"] == "USD"
    letters = ev.dead_letters(ev.parse_events(raw)).collect()
    assert len(letters) == 3 and {r.dead_letter_topic for r in letters} == {"x.dlq", "orders.dlq"}
    assert {(r.topic, r.status): r.events for r in ev.event_counts(ev.parse_events(raw)).collect()} == {
        ("orders", "success"): 2, ("orders", "error"): 1, ("x", "success"): 1, ("x", "error"): 2
    }


def test_order_state_follows_event_time(messages):
    rows = [
        order(1, "order_cancelled", 90, order_id="a"), order(2, "order_updated", 60, order_id="a", status="processing"),
        order(3, "order_created", 0, order_id="a"), order(4, "payment_received", 30, order_id="a"),
        order(5, "order_updated", 10, order_id="ghost", status="shipped"), order(6, "order_created", 5, order_id="b"),
        order(7, "shipment_delivered", 50, order_id="b"), order(8, "shipment_created", 40, order_id="b"),
    ]
    events = lambda part: ev.of_family(ev.parse_events(messages(*[("orders", r) for r in part])), "order")
    want = {("a", "cancelled", "captured"), ("b", "delivered", "pending")}
    got = lambda df: {(r.order_number, r.status, r.payment_status) for r in df.collect()}
    assert got(ev.order_rows(events(rows))) == want
    for cut in range(1, len(rows)):  # whatever came first, and with two messages sent again
        facts = ev.apply_order_events(ev.order_facts(events(rows[:cut])), events([*rows[cut:], rows[0], rows[2]]))
        assert got(ev.order_state(facts)) == want
    early = ev.order_facts(events([rows[0]]))  # the cancellation waits for its creation
    assert ev.order_state(early).count() == 0
    assert got(ev.order_state(ev.apply_order_events(early, events([rows[2]])))) == {("a", "cancelled", "pending")}


def run(spark, source, out, handlers, name="ck"):
    raw = spark.readStream.schema("topic string, value string").json(str(source))
    ev.consume(raw, handlers, f"{out}/{name}", available_now=True).awaitTermination()


def test_consume_routes_and_ignores_replays(spark, messages, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    handlers = {
        "order": ev.write_once(f"{out}/orders", ["event_id"]), "click": ev.write_batches(f"{out}/clicks"),
        "dead_letter": ev.write_batches(f"{out}/dlq"), "counts": ev.write_batches(f"{out}/counts"),
    }
    messages(("orders", order(1)), ("orders", order(1)), ("clicks", click(1)), ("x", "nope")).write.json(str(source))
    run(spark, source, out, handlers)
    messages(("orders", order(1)), ("orders", order(2)), ("x", json.dumps({"event_type": "user_login", "event_timestamp": "2025-01-01 00:00:00"}))).write.mode("append").json(str(source))
    run(spark, source, out, handlers)
    read = lambda n: spark.read.parquet(f"{out}/{n}")
    assert sorted(r.event_id for r in read("orders").collect()) == ["e1", "e2"]
    assert read("clicks").count() == 1 and read("dlq").count() == 1
    assert ev.page_view_rows(read("clicks")).first().date_key == 20250101
    assert read("counts").where("status = 'success'").agg(F.sum("events")).first()[0] == 6


def test_late_events_are_kept_once(spark, tmp_path):
    """Four batches: an event two hours late, replays of old events, an event without a time."""
    sink = ev.write_once(f"{tmp_path}/t", ["event_id"])
    at = lambda h: T0 + timedelta(hours=h)
    batches = [[("a", at(0)), ("b", at(1))], [("c", at(30))], [("d", at(28)), ("a", at(0)), ("n", None)], [("e", at(-2)), ("c", at(30)), ("n", None)]]
    for i, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, "event_id string, event_timestamp timestamp")
        sink(batch, i)
        sink(batch, i)  # a retry replaces
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["a", "b", "c", "d", "e", "n"]
    with pytest.raises(ValueError):
        ev.drop_replayed(spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(f"{tmp_path}/t"))


def test_anonymous_visitors(spark):
    rows = [(1, None, T0), (2, None, T0 + timedelta(minutes=110)), (3, "v", T0 + timedelta(minutes=5)), (4, None, T0 + timedelta(minutes=20)), (5, "v", None)]
    df = spark.createDataFrame(rows, "page_view_id long, visitor_id string, event_timestamp timestamp_ntz")
    got = {r.page_view_id: r for r in win.sessionize(df).collect()}
    assert got[1].session_start == got[4].session_start == T0 and got[2].session_start == T0 + timedelta(minutes=110)
    assert got[1].session_id.startswith("anonymous-") and got[3].session_id.startswith("v-")
    windows = {(r.visitor_id, r.pages) for r in win.session_windows(df.where("event_timestamp IS NOT NULL")).collect()}
    assert windows == {(None, 2), (None, 1), ("v", 1)}


def test_batch_rewritten_on_retry(spark, tmp_path):
    write = ev.write_batches(f"{tmp_path}/t")
    df = spark.range(3)
    for _ in range(2):
        write(df, 7)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_sessions_batch_equals_stream(spark, tmp_path):
    rows = [("a", T0 + timedelta(minutes=m)) for m in (0, 30, 58, 89, 400, 400)] + [("b", T0), ("z", T0 + timedelta(days=3))]
    schema = "visitor_id string, event_timestamp timestamp_ntz"
    batch = spark.createDataFrame(rows, schema)
    want = {(r.visitor_id, r.session_start, r.pages) for r in win.session_windows(batch).collect() if r.visitor_id != "z"}
    assert want == {("a", T0, 3), ("a", T0 + timedelta(minutes=89), 1), ("a", T0 + timedelta(minutes=400), 2), ("b", T0, 1)}
    batch.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = win.session_windows(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    got = {(r.visitor_id, r.session_start, r.pages) for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()}
    assert got == want


def test_funnel_order_matters(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    rows = [("a", "view", 0), ("a", "cart", 5), ("a", "buy", 200), ("b", "cart", 0), ("b", "view", 10), ("b", "cart", 10),
            ("c", "view", 0), ("c", "buy", 1), ("d", "view", 50), ("d", "cart", 20), ("d", "cart", 55), ("d", "buy", 54)]
    df = spark.createDataFrame([(u, k, at(m)) for u, k, m in rows], "u string, k string, t timestamp_ntz")
    out = win.funnel(df, "u", "t", "k", ["view", "cart", "buy"]).orderBy("step").collect()
    assert [(r.event_type, r.units) for r in out] == [("view", 4), ("cart", 2), ("buy", 1)]


def test_last_touch(spark):
    at = lambda h: T0 + timedelta(hours=h)
    orders = spark.createDataFrame([(1, "a", at(5), 10.0), (2, "a", at(0), 5.0), (3, "b", at(9), 7.0)], "order_id int, customer_id string, order_timestamp timestamp_ntz, total_amount double")
    touches = spark.createDataFrame([("a", "mail", at(1)), ("a", "ads", at(4)), ("a", None, at(5)), ("a", "late", at(6)), ("c", "x", at(0))], "customer_id string, utm_source string, event_timestamp timestamp_ntz")
    out = {r.order_id: r.attributed_source for r in win.last_touch(orders, touches).collect()}
    assert out == {1: "ads", 2: None, 3: None}


def test_cart_events(messages):
    good = json.dumps({"event_id": "1", "event_type": "add_to_cart", "event_timestamp": "2025-01-01 00:00:00", "session_id": "s",
                       "product_id": "p", "product_name": "n", "quantity": 2, "unit_price": 1.5})
    assert [r.quantity for r in ev.cart_events(messages(("c", good), ("c", click(1)), ("c", good.replace('"quantity": 2, ', "")))).collect()] == [2]
