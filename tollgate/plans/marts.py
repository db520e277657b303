"""Reporting queries over the score and staging tables.

Sums and means are added in decimal: the result does not depend on how rows were
partitioned. Every aggregate combines on the map side, so a hot user, city or band
reaches a reducer as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import rounded

BANDS = ("HIGH", "MEDIUM", "LOW")


def total(column: str, digits: int = 2) -> Column:
    return F.sum(F.col(column).cast(f"decimal(28,{digits})")).cast("double")


def mean(column: str, digits: int = 4) -> Column:
    return total(column, digits) / F.count(column)


def band_count(band: str) -> Column:
    return F.count_if(F.col("risk_level") == band)


def alert_rate() -> Column:
    rate = F.try_divide(band_count("HIGH").cast("double"), F.count("*").cast("double"))
    return F.coalesce(rounded(rate, 4), F.lit(0.0))


def daily(scores: DataFrame) -> DataFrame:
    """Volume and alert rate per day, newest first."""
    return (
        scores.groupBy(F.to_date("event_time").alias("tx_date"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            rounded(total("amount"), 2).alias("total_amount"),
            rounded(mean("risk_score"), 6).alias("avg_risk_score"),
            band_count("HIGH").alias("high_risk_count"),
            band_count("MEDIUM").alias("medium_risk_count"),
            alert_rate().alias("alert_rate"),
        )
        .orderBy(F.desc("tx_date"))
    )


def _scores_with(scores: DataFrame, staging: DataFrame, column: str) -> DataFrame:
    # both sides are unique by id; only the needed columns cross the shuffle
    return scores.select("transaction_id", "amount", "risk_score", "risk_level").join(
        staging.select("transaction_id", column), "transaction_id"
    )


def by_merchant_category(scores: DataFrame, staging: DataFrame) -> DataFrame:
    return (
        _scores_with(scores, staging, "merchant_category")
        .groupBy("merchant_category")
        .agg(
            F.count("transaction_id").alias("total_tx_count"),
            rounded(total("amount"), 2).alias("total_spend"),
            rounded(mean("risk_score"), 6).alias("avg_merchant_risk_score"),
            band_count("HIGH").alias("high_risk_tx_count"),
        )
        .orderBy(F.desc("high_risk_tx_count"), F.desc("avg_merchant_risk_score"), "merchant_category")
    )


def by_city(scores: DataFrame, staging: DataFrame) -> DataFrame:
    return (
        _scores_with(scores, staging, "city")
        .groupBy("city")
        .agg(
            F.count("transaction_id").alias("total_tx_count"),
            rounded(mean("risk_score"), 6).alias("avg_city_risk_score"),
            band_count("HIGH").alias("high_risk_tx_count"),
        )
        .orderBy(F.desc("high_risk_tx_count"), F.desc("avg_city_risk_score"), "city")
    )


def by_payment_method(scores: DataFrame, staging: DataFrame) -> DataFrame:
    return (
        _scores_with(scores, staging, "payment_method")
        .groupBy("payment_method")
        .agg(
            F.count("transaction_id").alias("total_tx_count"),
            rounded(total("amount"), 2).alias("total_spend"),
            band_count("HIGH").alias("high_risk_tx_count"),
            alert_rate().alias("alert_rate"),
        )
        .orderBy(F.desc("high_risk_tx_count"), "payment_method")
    )


def top_users(scores: DataFrame, limit: int = 20) -> DataFrame:
    """Users with at least one high-band row, the most suspicious first."""
    return (
        scores.groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("user_tx_count"),
            rounded(total("amount"), 2).alias("total_user_spend"),
            rounded(mean("risk_score"), 6).alias("avg_user_risk_score"),
            band_count("HIGH").alias("high_risk_count"),
        )
        .filter(F.col("high_risk_count") > 0)
        .orderBy(F.desc("high_risk_count"), F.desc("avg_user_risk_score"), "user_id")
        .limit(limit)
    )


def top_merchants(scores: DataFrame, staging: DataFrame, limit: int = 20) -> DataFrame:
    return (
        _scores_with(scores, staging, "merchant_id")
        .groupBy("merchant_id")
        .agg(
            F.count("transaction_id").alias("total_tx_count"),
            rounded(mean("risk_score"), 6).alias("avg_risk_score"),
            band_count("HIGH").alias("high_risk_count"),
        )
        .orderBy(F.desc("high_risk_count"), F.desc("avg_risk_score"), "merchant_id")
        .limit(limit)
    )


def risk_bands(scores: DataFrame) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(b) for b in BANDS]), F.col("risk_level"))
    return (
        scores.groupBy("risk_level")
        .agg(
            F.count("transaction_id").alias("tx_count"),
            rounded(mean("amount", 2), 2).alias("avg_amount"),
            rounded(mean("rule_score"), 4).alias("avg_rule_score"),
            rounded(mean("ml_anomaly_score"), 4).alias("avg_ml_score"),
        )
        .orderBy(order)
    )


def summary(scores: DataFrame) -> DataFrame:
    """One row over everything; zeros when the table is empty."""
    return scores.agg(
        F.count("transaction_id").alias("total_tx_count"),
        F.coalesce(rounded(total("amount"), 2), F.lit(0.0)).alias("total_amount"),
        F.coalesce(rounded(F.try_divide(total("risk_score", 4), F.count("risk_score")), 4), F.lit(0.0)).alias(
            "avg_risk_score"
        ),
        *[band_count(b).alias(f"{b.lower()}_risk_count") for b in BANDS],
    )


def _rollup_columns() -> list[Column]:
    return [
        F.count("transaction_id").alias("total_transactions"),
        F.coalesce(rounded(total("amount"), 2), F.lit(0.0)).alias("total_volume"),
        *[band_count(b).alias(f"{b.lower()}_risk_count") for b in BANDS],
        F.coalesce(rounded(F.try_divide(total("risk_score", 4), F.count("risk_score")), 4), F.lit(0.0)).alias(
            "avg_risk_score"
        ),
        alert_rate().alias("fraud_alert_rate"),
    ]


def daily_rollup(scores: DataFrame) -> DataFrame:
    """Rows of the daily metrics table: one per day present in `scores`."""
    return scores.groupBy(F.to_date("event_time").alias("metric_date")).agg(*_rollup_columns())


def rollup_snapshot(scores: DataFrame, run_date: str) -> DataFrame:
    """All of `scores` in one row stamped with the run date."""
    return scores.agg(*_rollup_columns()).select(F.lit(run_date).cast("date").alias("metric_date"), "*")


def user_risk_profile(scores: DataFrame) -> DataFrame:
    return scores.groupBy("user_id").agg(
        F.count("transaction_id").alias("tx_count"),
        rounded(total("amount"), 2).alias("total_amount"),
        rounded(mean("risk_score"), 6).alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        band_count("HIGH").alias("high_risk_count"),
        F.max_by("risk_level", F.struct("event_time", "transaction_id")).alias("latest_risk_level"),
    )
