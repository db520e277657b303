import json

import pytest

from tollgate.operators import validate

GOOD = {
    "transaction_id": "order-31", "event_time": "2026-08-11T12:00:00Z", "user_id": "reader", "account_id": "shared",
    "amount": 18.25, "currency": "INR", "merchant_id": "kiosk", "merchant_category": "books", "payment_method": "CARD",
    "device_id": "tablet", "ip_address": "192.0.2.9", "latitude": -33.9, "longitude": 18.4, "country": "IN",
    "city": "Harbour",
}


def without(field):
    return {k: v for k, v in GOOD.items() if k != field}


@pytest.fixture()
def run(spark):
    def check(*payloads):
        texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
        return validate.check_events(spark.createDataFrame([(t,) for t in texts], "value string"))

    return check


@pytest.mark.parametrize(
    "payload",
    [
        GOOD, {**GOOD, "amount": "7.5"}, {**GOOD, "amount": 0}, {**GOOD, "extra": [1]}, without("currency"),
        without("country"), {**GOOD, "latitude": -90, "longitude": 180}, {**GOOD, "event_time": "2026-08-11T12:00:00"},
        {**GOOD, "event_time": "2026-08-11T17:30:00+05:30"}, {**GOOD, "event_time": "20260811T120000Z"},
        {**GOOD, "event_time": "2026-08-11T12Z"}, {**GOOD, "event_time": "20260811T1730+0530"}, {**GOOD, "event_time": "2026-08-11 12:00:00,000"},
        {**GOOD, "amount": " 7.5e0 "}, json.dumps(GOOD)[:-1] + ', "city": "Harbour"}',
    ],
)
def test_accepted(run, payload):
    row = validate.valid_events(run(payload)).first()
    assert row is not None and row["city"] == "Harbour" and row["currency"] == "INR" and row["country"] == "IN"
    assert row["event_time"].isoformat() == "2026-08-11T12:00:00"


@pytest.mark.parametrize(
    "payload, field",
    [
        ({"note": [], "amount": "much"}, "transaction_id"),
        ({"transaction_id": "order-0", "amount": -3, "city": "Nowhere"}, "event_time"),
        (json.dumps(GOOD)[:40], "payload"), ("[1, 2]", "payload"), ("7", "payload"), ("", "payload"), ("null", "payload"),
        ({**GOOD, "currency": None}, "currency"), ({**GOOD, "user_id": 77}, "user_id"),
        ({**GOOD, "latitude": 91}, "latitude"), ({**GOOD, "longitude": -180.5}, "longitude"),
        ({**GOOD, "event_time": "soon"}, "event_time"), ({**GOOD, "event_time": 5}, "event_time"),
        ({**GOOD, "event_time": "2026"}, "event_time"), ({**GOOD, "amount": -0.01}, "amount"),
        ({**GOOD, "amount": "nan"}, "amount"), ({**GOOD, "amount": "7.5d"}, "amount"), ({**GOOD, "amount": "0x1p3"}, "amount"),
        ({**GOOD, "event_time": "20260811120000"}, "event_time"), ({**GOOD, "event_time": "2026-08-11T"}, "event_time"), ({**GOOD, "amount": None}, "amount"), ({**GOOD, "amount": [1]}, "amount"),
        (without("city"), "city"), (without("amount"), "amount"),
    ],
)
def test_rejected(run, payload, field):
    checked = run(payload)
    assert validate.valid_events(checked).isEmpty()
    letter = validate.dead_letters(checked).first()
    assert letter["error_type"] == field and letter["source_topic"] == "transactions.raw"
    assert letter["raw_payload"] == (payload if isinstance(payload, str) else json.dumps(payload))


def test_every_message_goes_to_exactly_one_side(run):
    checked = run(GOOD, {**GOOD, "amount": -1}, "{", GOOD)
    assert validate.valid_events(checked).count() == 2 and validate.dead_letters(checked).count() == 2


def test_all_problems_are_listed(run):
    errors = run({**GOOD, "amount": -1, "latitude": 100, "city": None}).first()["errors"]
    assert errors == ["amount: must be >= 0", "latitude: must be within +-90", "city: must not be null"]


def test_typed_parse(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), ("{broken",)], "value string")
    rows = {r["transaction_id"]: r for r in validate.parse_events(df).collect()}
    assert rows["order-31"]["amount"] == 18.25 and rows[None]["amount"] is None
