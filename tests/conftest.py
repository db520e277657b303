from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tollgate.schemas import TXN_COLUMNS, TXN_SCHEMA  # noqa: E402
from tollgate.session import local_session  # noqa: E402

T0 = datetime(2026, 8, 11, 10, 0, 0, tzinfo=timezone.utc)

DEFAULT_ROW = {
    "account_id": "acc_1", "amount": 100.0, "currency": "INR", "merchant_id": "m_1", "merchant_category": "food",
    "payment_method": "UPI", "device_id": "dev_1", "ip_address": "10.0.0.1", "latitude": 28.6139,
    "longitude": 77.209, "country": "IN", "city": "Delhi", "user_id": "u1",
}


def txn(tid: str, seconds: float = 0.0, **fields) -> dict:
    return {**DEFAULT_ROW, "transaction_id": tid, "event_time": T0 + timedelta(seconds=seconds), **fields}


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame of transactions from dicts."""
    return lambda rows: spark.createDataFrame([tuple(r[c] for c in TXN_COLUMNS) for r in rows], TXN_SCHEMA)
