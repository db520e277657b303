import pytest
from conftest import txn

from tollgate.config import Config
from tollgate.operators import detect
from tollgate.operators.features import add_features

SPLIT = Config(hot_user_rows=3, chunk_rows=1)
both = pytest.mark.parametrize("cfg", [Config(), SPLIT], ids=["whole users", "split users"])
LONDON = dict(city="London", latitude=51.5074, longitude=-0.1278, country="GB")


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


@both
def test_escalation(frame, cfg):
    amounts = [410.0, 990.0, 2600.0, 7100.0, 19000.0, 47000.0]
    rows = [txn(f"t{i}", 40 * i, amount=a) for i, a in enumerate(amounts)]
    rows += [txn("later", 40 * 5 + 46, amount=99999.0), txn("other", 41, user_id="u2", amount=9.0)]
    assert ids(detect.velocity_escalation(frame(rows), cfg=cfg)) == ["t2", "t3", "t4", "t5"]


def test_spike_and_new_device(frame):
    rows = [txn(f"n{i}", i * 600, amount=900.0 + i) for i in range(6)]
    rows += [txn("big", 4000, amount=150000.0), txn("dev", 4100, amount=70000.0, device_id="other")]
    rows += [txn("rich", 0, user_id="u2", amount=150000.0)]  # no past to compare with
    features = add_features(frame(rows))
    assert ids(detect.amount_spike(features)) == ["big"]
    assert ids(detect.new_device_high_value(features)) == ["dev"]


@both
def test_travel(frame, cfg):
    rows = [txn("delhi", 0), txn("london", 180, **LONDON), txn("home", 180 + 24 * 3600), txn("near", 86400 * 2)]
    out = detect.impossible_travel(frame(rows), cfg=cfg).collect()
    assert [r["transaction_id"] for r in out] == ["london"] and out[0]["kmh"] > 100_000


@both
def test_merchant_shift(frame, cfg):
    rows = [txn("first", 0, merchant_category="jewelry"), txn("food", 10), txn("again", 20, merchant_category="jewelry"),
            txn("shift", 30, merchant_category="crypto_exchange"), txn("food2", 40)]
    assert ids(detect.merchant_shift(frame(rows), cfg=cfg)) == ["shift"]


@both
def test_burst(frame, cfg):
    rows = [txn(f"b{i:02d}", i, amount=50.0) for i in range(12)] + [txn("large", 5.5, amount=500.0)]
    rows += [txn("slow", 500, amount=50.0)]
    assert ids(detect.burst(frame(rows), cfg=cfg)) == ["b09", "b10", "b11"]


@both
def test_sessions(frame, cfg):
    rows = [txn(f"a{i}", i * 60, amount=10.0) for i in range(40)]  # pauses of exactly the gap
    rows += [txn("b", 40 * 60 + 1, amount=5.0), txn("c", 0, user_id="u2")]
    out = sorted((r["user_id"], r["tx_count"], r["total_amount"]) for r in detect.sessions(frame(rows), cfg=cfg).collect())
    assert out == [("u1", 1, 5.0), ("u1", 40, 400.0), ("u2", 1, 100.0)]
