"""Input files of streams: larger inputs have more of them, in as many batches as before."""

import os
from datetime import datetime, timedelta

import pytest

from merclake.plans import q_streams


@pytest.fixture()
def purchases(spark, tmp_path, monkeypatch):
    """400 events in five files, and the folder of the queries."""
    rows = [(i, datetime(2025, 1, 1) + timedelta(minutes=i), 7, "purchase", 2.5, "{}") for i in range(1, 401)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.repartition(5).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(q_streams, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(q_streams, "FILE_ROWS", 20)
    return tmp_path


def batches(folder) -> int:
    return len([n for n in os.listdir(f"{folder}/checkpoint/commits") if n.isdigit()])


def largest(spark, folder) -> int:
    files = [f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet")]
    return max(spark.read.parquet(f).count() for f in files)


def test_order_state(spark, purchases):
    """about 870 messages and 170 of them again; the first part was one file."""
    assert q_streams.stream_order_state(spark, f"{purchases}/in").select("order_number").distinct().count() == 400
    assert batches(f"{purchases}/orders") == 8
    assert largest(spark, f"{purchases}/orders/messages") < 90


def test_order_facts(spark, purchases):
    """the third part holds its messages twice."""
    assert q_streams.stream_order_facts(spark, f"{purchases}/in").select("order_number").distinct().count() == 400
    assert batches(f"{purchases}/orders") == 4
    assert largest(spark, f"{purchases}/orders/messages") < 90


@pytest.mark.parametrize("name", ["stream_new_events", "stream_page_views"])
def test_two_batches(spark, purchases, name):
    """every file was a batch, and each batch reads what is stored."""
    found = getattr(q_streams, name)(spark, f"{purchases}/in")
    assert (found.count(), found.select("page_view_id").distinct().count()) == (400, 400)
    assert batches(f"{purchases}/views") == 2
    assert largest(spark, f"{purchases}/views/in") < 60
