"""Named queries: anomaly model and scenario detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.config import Config
from tollgate.functions import rounded, utc_text
from tollgate.operators import detect, evaluate, iforest, scoring
from tollgate.plans import marts
from tollgate.plans.catalog import QUERIES, featured, register
from tollgate.plans.catalog_data import scratch
from tollgate.plans import spoiled
from tollgate.sources.tables import transactions

# --- anomaly model -------------------------------------------------------------------


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features written once: training and scoring read them several times."""
    path = f"{scratch(spark)}/features"
    featured(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@register("iforest_train")
def _train(spark: SparkSession, sf: str) -> DataFrame:
    return iforest.grow_forest(stored_features(spark, sf))


@register("iforest_score")
def _score(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored_features(spark, sf)
    scored = iforest.with_anomaly_score(rows, iforest.train(rows))
    return scored.select("transaction_id", rounded(F.col("raw_decision"), 4).alias("raw_decision"),
                         rounded(F.col("anomaly_score"), 4).alias("anomaly_score"))


@register("scored_with_forest")
def _score_forest(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored_features(spark, sf)
    forest = iforest.train(rows)
    judged = iforest.with_anomaly_score(rows, forest)
    risk = scoring.score(judged, ml_score=rounded(F.col("anomaly_score"), 4), model_version=forest.version)
    return risk.select("transaction_id", "risk_score", "risk_level", "model_version", "ml_anomaly_score")


@register("model_evaluation")
def _model_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's scores against labels joined by transaction id, at the best threshold."""
    rows = stored_features(spark, sf)
    judged = iforest.with_anomaly_score(rows, iforest.train(rows))
    labels = spoiled.labelled(transactions(spark, sf)).select("transaction_id", F.col("is_fraud").alias("label"))
    pairs = judged.select("transaction_id", F.col("anomaly_score").alias("score")).join(labels, "transaction_id")
    return evaluate.best_threshold(pairs)


# --- scenario detectors; limits lowered where the data holds nothing above the default ---


def _timed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("transaction_id", "user_id", utc_text(F.col("event_time")).alias("event_time"), "amount", *columns)


QUERIES["detect_velocity_escalation"] = lambda s, sf: _timed(
    detect.velocity_escalation(transactions(s, sf), 120), "previous_amount", "amount_before_that"
)
QUERIES["detect_velocity_escalation_split_users"] = lambda s, sf: _timed(
    detect.velocity_escalation(transactions(s, sf), 120, Config(hot_user_rows=70, chunk_rows=2)),
    "previous_amount", "amount_before_that",
)
QUERIES["detect_amount_spike"] = lambda s, sf: _timed(
    detect.amount_spike(featured(s, sf), 40_000.0), "amount_vs_user_avg", "amount_zscore"
)
QUERIES["detect_impossible_travel"] = lambda s, sf: _timed(detect.impossible_travel(transactions(s, sf)), "km", "kmh")
QUERIES["detect_new_device_high_value"] = lambda s, sf: _timed(
    detect.new_device_high_value(featured(s, sf), 20_000.0), "device_id"
)
QUERIES["detect_merchant_shift"] = lambda s, sf: _timed(detect.merchant_shift(transactions(s, sf)), "merchant_category")
QUERIES["detect_burst"] = lambda s, sf: _timed(
    detect.burst(transactions(s, sf), 20_000.0, 300, 4), "payments_in_span"
)


def _sessions(spark: SparkSession, sf: str, cfg: Config) -> DataFrame:
    found = detect.sessions(transactions(spark, sf), 60, 2, cfg)
    return found.withColumn("session_start", utc_text(F.col("session_start"))).withColumn(
        "session_end", utc_text(F.col("session_end"))
    )


QUERIES["burst_sessions"] = lambda s, sf: _sessions(s, sf, Config())
QUERIES["burst_sessions_split_users"] = lambda s, sf: _sessions(s, sf, Config(hot_user_rows=70, chunk_rows=2))


# --- drift between two periods --------------------------------------------------------


@register("drift_report")
def _drift(spark: SparkSession, sf: str) -> DataFrame:
    """First against second half of the month: volume, mean amount, rates and shape of amounts."""
    from tollgate.operators.drift import drift_report

    tx = featured(spark, sf)
    risk = scoring.score(tx, ml_score=(F.col("event_id") * 7919) % 1000 / 1000.0)
    return drift_report(risk, F.col("event_time") < F.lit("2024-01-16").cast("timestamp"))


QUERIES["mart_combined_rule"] = lambda s, sf: featured(s, sf).filter(
    (F.col("new_device") == 1.0) & (F.col("amount") >= 20_000.0) & (F.col("tx_count_5m") >= 1.0)
).select("transaction_id", "amount", "tx_count_5m")
QUERIES["alert_precision_by_band"] = lambda s, sf: _alert_precision(s, sf)


def _alert_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Share of labelled frauds per band: how costly the alerts of each band are."""
    risk = scoring.score(featured(spark, sf), ml_score=(F.col("event_id") * 7919) % 1000 / 1000.0)
    labels = spoiled.labelled(transactions(spark, sf)).select("transaction_id", "is_fraud")
    return risk.join(labels, "transaction_id").groupBy("risk_level").agg(
        F.count("*").alias("tx_count"), F.count_if("is_fraud").alias("fraud_count"),
        marts.rounded(F.count_if("is_fraud").cast("double") / F.count("*"), 4).alias("fraud_rate"),
    )
