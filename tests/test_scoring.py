import pytest
from pyspark.sql import functions as F

from tollgate.config import Config
from tollgate.functions import haversine_km, rounded
from tollgate.operators import scoring
from tollgate.operators.rules import rule_reasons, rule_score

SCHEMA = (
    "transaction_id string, user_id string, event_time timestamp, amount double, tx_count_5m double, "
    "amount_vs_user_avg double, new_device double, new_location double, distance_from_last_tx double, merchant_category string, ml double"
)


@pytest.fixture()
def row(spark):
    def make(count=0.0, ratio=1.0, amount=100.0, device=0.0, place=0.0, km=0.0, category="food", ml=0.0):
        return spark.createDataFrame(
            [("t1", "u1", None, amount, count, ratio, device, place, km, category, ml)], SCHEMA
        )

    return make


def rule(df):
    out = df.select(rule_score().alias("s"), rule_reasons().alias("r")).first()
    return out["s"], out["r"]


@pytest.mark.parametrize(
    "fields, score, reasons",
    [
        ({}, 0.0, 0),
        ({"count": 2.0}, 0.0, 0), ({"count": 3.0}, 0.5, 0), ({"count": 4.0}, 0.5, 0), ({"count": 5.0}, 1.0, 1),
        ({"ratio": 2.9999}, 0.0, 0), ({"ratio": 3.0}, 0.6, 0), ({"ratio": 5.0}, 1.0, 1),
        ({"amount": 39999.99}, 0.0, 0), ({"amount": 40000.0}, 0.6, 0), ({"amount": 80000.0}, 1.0, 1),
        ({"device": 1.0}, 0.7, 1),
        ({"km": 149.99}, 0.0, 0), ({"km": 150.0}, 0.5, 0), ({"km": 500.0}, 1.0, 1),
        ({"category": "Electronics"}, 0.6, 1), ({"category": "wire_transfer"}, 0.6, 1),
        ({"count": None, "ratio": None, "device": None, "km": None, "category": None}, 0.0, 0),
        ({"count": 11.0, "ratio": 12.5, "amount": 210000.0, "device": 1.0, "km": 4321.0, "category": "jewelry"}, 1.0, 5),
    ],
)
def test_rules(row, fields, score, reasons):
    got, texts = rule(row(**fields))
    assert got == score and len(texts) == reasons


def test_reason_texts(row):
    _, texts = rule(row(count=6.0, ratio=8.04, amount=1234567.895, device=1.0, km=650.25, category="Jewelry"))
    assert texts == [
        "High transaction velocity detected (6 transactions in 5 minutes)",
        f"Transaction amount ₹{1234567.895:,.2f} is significantly above historical user baseline (8.0x average)",
        "Transaction originated from an unrecognized new device",
        f"Impossible travel speed / large location shift detected ({650.25:.1f} km from prior transaction)",
        "Transaction at high-risk merchant category 'Jewelry'",
    ]


def scored(df, **kw):
    return scoring.score(df, ml_score=F.col("ml"), model_version="m1", **kw).first()


def test_bands(row):
    assert scored(row(ml=0.1))["risk_level"] == "LOW"
    assert scored(row(count=3.0, ratio=2.5, ml=0.5))["risk_level"] == "MEDIUM"
    high = scored(row(count=6.0, ratio=5.0, device=1.0, place=1.0, km=600.0, ml=0.85))
    assert high["risk_level"] == "HIGH" and high["risk_score"] == round(0.35 + 0.35 * 0.85 + 0.15 + 0.15, 4)


@pytest.mark.parametrize("level, band", [(0.7, "HIGH"), (0.69999, "MEDIUM"), (0.4, "MEDIUM"), (0.39999, "LOW")])
def test_band_limits_use_the_unrounded_score(spark, level, band):
    out = spark.range(1).select(scoring.risk_band(F.lit(level)).alias("b"), rounded(F.lit(level), 4).alias("r")).first()
    assert out["b"] == band


def test_rules_only_cannot_be_high(row):
    out = scoring.score(row(count=9.0, ratio=9.0, amount=99999.0, device=1.0, place=1.0, km=900.0)).first()
    assert out["risk_score"] == 0.65 and out["risk_level"] == "MEDIUM"
    assert out["model_version"] == "rules_only_v1.0" and out["ml_anomaly_score"] == 0.0


def test_explanations(row):
    assert scored(row(ml=0.65))["reasons"] == ["Unsupervised ML model detected severe statistical anomaly (score: 0.65)"]
    # between the cut-offs the model is mentioned only above the LOW band
    assert scored(row(ml=0.64))["reasons"] == ["Normal transaction pattern within expected historical user baseline"]
    assert scored(row(ratio=3.0, count=3.0, ml=0.5))["reasons"] == ["Elevated ML anomaly signal detected (score: 0.50)"]
    assert scored(row(ratio=4.0, count=4.0, ml=0.1))["reasons"] == [
        "Elevated risk score driven by combined sub-threshold velocity and behavioral signals"
    ]


def test_weights_are_configurable(row):
    cfg = Config(w_rules=0.0, w_ml=1.0, w_velocity=0.0, w_behavior=0.0)
    assert scored(row(ml=0.71), cfg=cfg)["risk_score"] == 0.71


def test_alerts(row):
    many = scoring.score(row(count=6.0, ratio=5.0, km=600.0, ml=0.9), ml_score=F.col("ml"))
    alert = scoring.alerts(many).first()
    assert alert["alert_id"] == "alt_t1" and alert["risk_level"] == "HIGH"
    assert scoring.alerts(scoring.score(row())).isEmpty()


def test_haversine(spark):
    km = spark.range(1).select(
        haversine_km(F.lit(0.0), F.lit(-30.0), F.lit(0.0), F.lit(60.0)).alias("quarter"),
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("antipode"),
    ).first()
    assert km["quarter"] == pytest.approx(10007.543, abs=0.01) and km["antipode"] == pytest.approx(20015.09, abs=0.01)


def test_rounding_follows_the_binary_value(spark):
    values = [2.675, 0.125, 0.375, 1.005, 5e-05, -5e-05, 0.80995, 1e-9, -1e-9, 123456789.125, 0.005]
    values += [(k + 0.5) / 100 for k in range(400)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", rounded(F.col("x"), 2).alias("two"), rounded(F.col("x"), 4).alias("four")
    )
    for r in rows.collect():
        assert (r["two"], r["four"]) == (round(r["x"], 2), round(r["x"], 4)), r
