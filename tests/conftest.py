from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from orderflow.constants import ORDER_FIELDS
from orderflow.schema import ORDER_EVENT
from orderflow.session import engine_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    session = engine_session(
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path) -> str:
    return str(tmp_path)


ORDER = {
    "order_id": "o1",
    "customer_id": "C1000",
    "product_id": "P1",
    "product_name": "Lamp",
    "category": "Home",
    "quantity": "2",
    "unit_price": "10.25",
    "total_amount": "20.50",
    "currency": "USD",
    "payment_method": "PAYPAL",
    "order_status": "PLACED",
    "shipping_city": "Boston",
    "shipping_state": "MA",
    "order_timestamp": "2026-01-02T03:04:05.678901+00:00",
}


def order(**changes: str | None) -> dict[str, str | None]:
    return {**ORDER, **changes}


@pytest.fixture
def raw(spark: SparkSession):
    """Make raw orders: each argument holds the fields that differ from ``ORDER``."""

    def make(*orders: dict[str, str | None]):
        rows = [tuple(order(**changes)[name] for name in ORDER_FIELDS) for changes in orders]
        return spark.createDataFrame(rows, ORDER_EVENT)

    return make


def rows(frame, *names: str) -> list[tuple]:
    """Rows as tuples, in a fixed order."""
    found = frame.select(*names) if names else frame
    return sorted((tuple(row) for row in found.collect()), key=repr)
