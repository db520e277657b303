"""Named queries over a data folder, one per capability."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, FEATURE_NAMES, Config
from tollgate.functions import haversine_km, rounded, utc_text
from tollgate.operators import features, rules, scoring
from tollgate.plans import marts
from tollgate.sources.tables import transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SUPPLIED_VERSION = "supplied_ml_v1"


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


def supplied_ml() -> Column:
    """A deterministic model score that fills all three bands (see FIXTURES.md)."""
    return (F.col("event_id") * 7919) % 1000 / 1000.0


def featured(spark: SparkSession, sf: str, cfg: Config = DEFAULT) -> DataFrame:
    return features.add_features(transactions(spark, sf), cfg)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(featured(spark, sf), ml_score=supplied_ml(), model_version=SUPPLIED_VERSION)


def joined(column: str) -> Column:
    return F.array_join(column, " | ").alias(column)


def score_view(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", utc_text(F.col("event_time")).alias("event_time"), "user_id", "amount",
        "risk_score", "risk_level", "model_version", "rule_score", "ml_anomaly_score",
        "score_breakdown.velocity_score", "score_breakdown.behavior_score", joined("reasons"),
    )


# --- features ------------------------------------------------------------------------


def _feature_query(name: str, *columns: str) -> None:
    QUERIES[name] = lambda spark, sf: featured(spark, sf).select("transaction_id", *columns)


_feature_query("features_all", *FEATURE_NAMES)
_feature_query("amount_zscore", "amount", "amount_zscore")
_feature_query("velocity_counts", "tx_count_1m", "tx_count_5m", "tx_count_1h")
_feature_query("monetary_windows", "amount_sum_5m", "avg_amount_1h", "amount_vs_user_avg")
_feature_query("unique_merchants", "unique_merchants_1h")
_feature_query("novelty_flags", "new_device", "new_location")
_feature_query("distance_from_last", "distance_from_last_tx")


@register("features_all_split_users")
def _features_split(spark: SparkSession, sf: str) -> DataFrame:
    # thresholds low enough that about a third of the users take the split path
    small = Config(hot_user_rows=70, chunk_rows=2)
    return featured(spark, sf, small).select("transaction_id", *FEATURE_NAMES)


@register("temporal_features")
def _temporal(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(spark, sf).select(
        "transaction_id", features.hour_of_day().alias("hour_of_day"), features.day_of_week().alias("day_of_week")
    )


@register("feature_vector")
def _vector(spark: SparkSession, sf: str) -> DataFrame:
    digits = F.transform(features.feature_vector(), lambda x: F.format_string("%.4f", x))
    return featured(spark, sf).select("transaction_id", F.array_join(digits, ",").alias("feature_vector"))


@register("haversine")
def _haversine(spark: SparkSession, sf: str) -> DataFrame:
    km = haversine_km(F.lit(28.6139), F.lit(77.209), F.col("latitude"), F.col("longitude"))
    return transactions(spark, sf).select("transaction_id", rounded(km, 2).alias("km"))


@register("bounded_window_features")
def _bounded(spark: SparkSession, sf: str) -> DataFrame:
    return features.bounded_window_features(transactions(spark, sf)).select(
        "transaction_id", "tx_count_1m", "tx_count_5m", "tx_count_1h", "amount_sum_5m", "avg_amount_1h",
        "unique_merchants_1h",
    )


# --- rules and scores ----------------------------------------------------------------


@register("rule_scores")
def _rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    return featured(spark, sf).select("transaction_id", rules.rule_score().alias("rule_score"))


@register("rule_reasons")
def _rule_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return featured(spark, sf).select(
        "transaction_id", F.array_join(rules.rule_reasons(), " | ").alias("rule_reasons")
    )


@register("hybrid_score")
def _hybrid(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(
        "transaction_id", "risk_score", "score_breakdown.rule_score", "score_breakdown.ml_score",
        "score_breakdown.velocity_score", "score_breakdown.behavior_score",
    )


@register("risk_band_of_tx")
def _band(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("transaction_id", "risk_level")


@register("explanations")
def _explanations(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("transaction_id", joined("reasons"))


@register("scored_with_ml")
def _scored_ml(spark: SparkSession, sf: str) -> DataFrame:
    return score_view(scored(spark, sf))


@register("scored_rules_only")
def _scored_rules(spark: SparkSession, sf: str) -> DataFrame:
    return score_view(scoring.score(featured(spark, sf)))


@register("fraud_alerts")
def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.alerts(scored(spark, sf)).select(
        "alert_id", "transaction_id", "user_id", "amount", utc_text(F.col("event_time")).alias("event_time"),
        "risk_score", "risk_level", joined("reasons"),
    )


# --- marts ---------------------------------------------------------------------------


def _dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def _scores_and_staging(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return scored(spark, sf), transactions(spark, sf)


QUERIES["mart_daily"] = lambda s, sf: _dated(marts.daily(scored(s, sf)), "tx_date")
QUERIES["mart_merchant_category"] = lambda s, sf: marts.by_merchant_category(*_scores_and_staging(s, sf))
QUERIES["mart_city"] = lambda s, sf: marts.by_city(*_scores_and_staging(s, sf))
QUERIES["mart_payment_method"] = lambda s, sf: marts.by_payment_method(*_scores_and_staging(s, sf))
QUERIES["mart_top_users"] = lambda s, sf: marts.top_users(scored(s, sf))
QUERIES["mart_top_merchants"] = lambda s, sf: marts.top_merchants(*_scores_and_staging(s, sf))
QUERIES["mart_risk_bands"] = lambda s, sf: marts.risk_bands(scored(s, sf))
QUERIES["summary_metrics"] = lambda s, sf: marts.summary(scored(s, sf))
QUERIES["daily_rollup"] = lambda s, sf: _dated(marts.daily_rollup(scored(s, sf)), "metric_date")
QUERIES["daily_rollup_snapshot"] = lambda s, sf: _dated(
    marts.rollup_snapshot(scored(s, sf), "2024-02-01"), "metric_date"
)
QUERIES["user_risk_profile"] = lambda s, sf: marts.user_risk_profile(scored(s, sf))
