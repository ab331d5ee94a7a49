from __future__ import annotations

import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import prepare  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("plumbline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir"))
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def trade_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("trade tables are not available")
    return TESTDATA


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def dec(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def rows(df):
    """All rows as a sorted list of dicts."""
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(sorted(r.items(), key=str)))


def multiset(df, columns=None):
    columns = columns or sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


ORDER_DDL = (
    "order_id STRING, event_id STRING, event_version INT, order_timestamp_utc TIMESTAMP, "
    "region_code STRING, category_code STRING, currency_code STRING, gross_amount DECIMAL(12,2), "
    "customer_segment STRING, source_updated_at TIMESTAMP, ingested_at TIMESTAMP, "
    "source_system STRING"
)
RETURN_DDL = (
    "return_id STRING, order_id STRING, return_timestamp_utc TIMESTAMP, "
    "return_amount DECIMAL(12,2), currency_code STRING, return_reason STRING, "
    "source_updated_at TIMESTAMP, ingested_at TIMESTAMP, source_system STRING"
)
BASE = ts("2026-08-05 10:00:00")


def order(order_id, event="E1", version=1, amount="100.00", **changes):
    row = {
        "order_id": order_id,
        "event_id": event,
        "event_version": version,
        "order_timestamp_utc": BASE,
        "region_code": "ON",
        "category_code": "DEV",
        "currency_code": "CAD",
        "gross_amount": dec(amount),
        "customer_segment": "Consumer",
        "source_updated_at": BASE,
        "ingested_at": BASE,
        "source_system": "azure_sql.sales.orders",
    }
    row.update(changes)
    return tuple(row.values())


def returned(return_id, order_id, amount="10.00", **changes):
    row = {
        "return_id": return_id,
        "order_id": order_id,
        "return_timestamp_utc": BASE,
        "return_amount": dec(amount),
        "currency_code": "CAD",
        "return_reason": "Defective",
        "source_updated_at": BASE,
        "ingested_at": BASE,
        "source_system": "sqlserver.dbo.returns",
    }
    row.update(changes)
    return tuple(row.values())
