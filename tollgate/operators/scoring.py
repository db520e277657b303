"""Weighted risk score, bands, explanations and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, Config
from tollgate.functions import clip01, compact, fill, rounded
from tollgate.operators.rules import feature, rule_reasons, rule_score

# Version name without a model, and the sentences of an explanation.
RULES_ONLY_VERSION = "rules_only_v1.0"
SENTENCES = {
    "severe": "Unsupervised ML model detected severe statistical anomaly (score: {score})",
    "elevated": "Elevated ML anomaly signal detected (score: {score})",
    "combined": "Elevated risk score driven by combined sub-threshold velocity and behavioral signals",
    "normal": "Normal transaction pattern within expected historical user baseline",
}


def velocity_score() -> Column:
    return clip01(feature("tx_count_5m", 0.0) / 5.0)


def behavior_score() -> Column:
    deviation = F.least(feature("amount_vs_user_avg", 1.0), F.lit(5.0)) / 5.0
    device, place = feature("new_device", 0.0), feature("new_location", 0.0)
    return clip01(deviation * 0.5 + device * 0.25 + place * 0.25)


def risk_band(score: Column, cfg: Config = DEFAULT) -> Column:
    return (
        F.when(score >= cfg.high_threshold, "HIGH")
        .when(score >= cfg.medium_threshold, "MEDIUM")
        .otherwise("LOW")
    )


def explanation(cfg: Config = DEFAULT) -> Column:
    """Rule sentences, then the model's, or one fallback sentence."""
    ml, elevated = F.col("ml_anomaly_score"), F.col("risk_level") != "LOW"
    shown = {"score": F.expr("format_number(ml_anomaly_score, '0.00')")}
    model = compact(
        F.when(ml >= cfg.ml_severe, fill(SENTENCES["severe"], shown)).when(
            (ml >= cfg.ml_elevated) & elevated, fill(SENTENCES["elevated"], shown)
        )
    )
    found = F.concat(F.col("_rule_reasons"), model)
    fallback = F.when(elevated, SENTENCES["combined"]).otherwise(SENTENCES["normal"])
    return F.when(F.size(found) > 0, found).otherwise(F.array(fallback))


def score(
    features: DataFrame,
    cfg: Config = DEFAULT,
    *,
    ml_score: Column | None = None,
    model_version: str = RULES_ONLY_VERSION,
) -> DataFrame:
    """Add the score columns to feature rows.

    Without `ml_score` the rules-only version is used and the model counts as 0. The band
    follows the unrounded score.
    """
    inputs = features.select(
        "*",
        (F.lit(0.0) if ml_score is None else ml_score.cast("double")).alias("ml_anomaly_score"),
        rule_score().alias("rule_score"),
        velocity_score().alias("_velocity"),
        behavior_score().alias("_behavior"),
        rule_reasons().alias("_rule_reasons"),
    )
    blend = clip01(
        cfg.w_rules * F.col("rule_score")
        + cfg.w_ml * F.col("ml_anomaly_score")
        + cfg.w_velocity * F.col("_velocity")
        + cfg.w_behavior * F.col("_behavior")
    )
    banded = inputs.withColumn("_risk", blend).withColumn("risk_level", risk_band(F.col("_risk"), cfg))
    return banded.select(
        *features.columns,
        rounded(F.col("_risk"), 4).alias("risk_score"),
        "risk_level",
        F.lit(RULES_ONLY_VERSION if ml_score is None else model_version).alias("model_version"),
        "rule_score",
        "ml_anomaly_score",
        F.struct(
            F.col("rule_score"),
            rounded(F.col("ml_anomaly_score"), 4).alias("ml_score"),
            rounded(F.col("_velocity"), 4).alias("velocity_score"),
            rounded(F.col("_behavior"), 4).alias("behavior_score"),
            rounded(F.col("_risk"), 4).alias("final_risk_score"),
        ).alias("score_breakdown"),
        explanation(cfg).alias("reasons"),
    )


def alerts(scored: DataFrame) -> DataFrame:
    """High-band rows in the shape of the alert topic."""
    return scored.filter(F.col("risk_level") == "HIGH").select(
        F.concat(F.lit("alt_"), F.col("transaction_id")).alias("alert_id"),
        "transaction_id",
        "user_id",
        "amount",
        "event_time",
        "risk_score",
        "risk_level",
        "reasons",
    )
