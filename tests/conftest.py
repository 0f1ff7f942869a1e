from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from merclake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, shuffle_partitions=4,
        **{"spark.python.sql.dataFrameDebugging.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    with tempfile.TemporaryDirectory(prefix="merclake-test-") as root:
        if not session.conf.get("spark.checkpoint.dir", None):
            session.conf.set("spark.checkpoint.dir", root)
        yield session
        session.stop()


@pytest.fixture()
def orders(spark):
    """A returning buyer, a guest order without a customer, and one that is still open."""
    rows = [
        (501, "N-501", 71, "2024-02-29 23:59:00", "delivered", 80.00, 4, 0.00, 6.40, 4.90),
        (502, "N-502", 71, "2024-03-09 00:05:30", "shipped", 1200.75, 1, 24.25, 96.06, 0.00),
        (503, "N-503", None, "2024-03-10 12:00:00", "pending", 0.00, 1, 19.00, 0.00, 0.00),
    ]
    return spark.createDataFrame(
        rows,
        "order_id bigint, order_number string, customer_id bigint, order_timestamp string, status string, "
        "total_amount double, item_count bigint, discount_amount double, tax_amount double, shipping_amount double",
    )


@pytest.fixture()
def customers(spark):
    rows = [
        (71, "K71", "mira.sand@post.example", "Mira", "Sand", "DE", "loyal", 1280.75, 2),
        (72, "K72", "oleg@mail.test", "Oleg", "Berg", "AT", "new", 0.00, 0),
        (73, "K73", None, "Ines", "Prado", "ES", "at_risk", 45.10, 1),
    ]
    return spark.createDataFrame(
        rows,
        "customer_id bigint, customer_key string, email string, first_name string, last_name string, country string, "
        "segment string, lifetime_value double, total_orders bigint",
    )


@pytest.fixture()
def products(spark):
    rows = [
        (9001, "P9001", "LAMP-1", "Desk lamp", "lighting", 34.50, 12.20, 0, False, 3.9, True),
        (9002, "P9002", "ROPE-7", "Climbing rope", "sport", 119.00, 70.00, 12, True, 4.8, True),
        (9003, "P9003", "TEA-33", "Green tea", "food", 6.25, 2.00, 400, True, 4.1, False),
    ]
    return spark.createDataFrame(
        rows,
        "product_id bigint, product_key string, sku string, name string, category string, unit_price double, "
        "cost_price double, stock_quantity bigint, is_in_stock boolean, avg_rating double, is_active boolean",
    )
