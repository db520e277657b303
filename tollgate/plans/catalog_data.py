"""Named queries: contract checks, dedup, warehouse, quality, evaluation, registry."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions import rounded, utc_text
from tollgate.operators import dedup, evaluate, quality, scoring, validate
from tollgate.plans import jobs, registry, warehouse
from tollgate.plans.catalog import QUERIES, featured, register, score_view, scored, supplied_ml
from tollgate.schemas import TXN_COLUMNS
from tollgate.session import durable_dir
from tollgate.plans import spoiled
from tollgate.sources import messages
from tollgate.sources.tables import transactions

RUN_TS = "2024-02-01 00:00:00"


def scratch(spark: SparkSession) -> str:
    """A new folder for this run below the shared one."""
    base = durable_dir(spark, fallback=tempfile.gettempdir())
    return f"{base.rstrip('/')}/tollgate-{uuid.uuid4().hex}"


def _texted(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", utc_text(F.col("event_time")))


# --- messages and contract -----------------------------------------------------------


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return validate.check_events(spoiled.payloads(transactions(spark, sf)))


@register("parse_json_events")
def _parse(spark: SparkSession, sf: str) -> DataFrame:
    readable = messages.to_messages(transactions(spark, sf).select(*TXN_COLUMNS))
    return _texted(validate.parse_events(readable))


QUERIES["validate_events"] = lambda s, sf: _texted(validate.valid_events(checked(s, sf)))
QUERIES["dead_letters"] = lambda s, sf: validate.dead_letters(checked(s, sf))
QUERIES["strip_labels"] = lambda s, sf: _texted(messages.strip_labels(spoiled.labelled(transactions(s, sf))))


@register("publish_projection")
def _publish(spark: SparkSession, sf: str) -> DataFrame:
    out = messages.to_messages(transactions(spark, sf).select(*TXN_COLUMNS))
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return out.select("key", field("transaction_id"), field("event_time"), field("city"))


@register("ops_counters")
def _ops(spark: SparkSession, sf: str) -> DataFrame:
    """Consumed / failed messages and predictions per level, as (metric, total)."""
    seen = checked(spark, sf).agg(
        F.count("*").alias("events_consumed"), F.count_if(F.size("errors") > 0).alias("events_failed")
    ).unpivot([], ["events_consumed", "events_failed"], "metric", "total")
    levels = scored(spark, sf).groupBy(
        F.concat(F.lit("risk_predictions_"), F.lower("risk_level")).alias("metric")
    ).agg(F.count("*").alias("total"))
    return seen.unionByName(levels)


@register("avg_last_1000")
def _last_1000(spark: SparkSession, sf: str) -> DataFrame:
    latest = transactions(spark, sf).orderBy(F.desc("event_time"), F.desc("event_id")).limit(1000)
    total = F.sum(F.col("amount").cast("decimal(28,2)")).cast("double")
    return latest.agg(rounded(F.coalesce(total / F.count("*"), F.lit(0.0)), 4).alias("avg_last_1000"))


# --- dedup and warehouse -------------------------------------------------------------


@register("dedup_last_wins")
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    copies = spoiled.replayed(transactions(spark, sf))
    return dedup.latest_per_key(copies, ["transaction_id"], ["seq"]).select("transaction_id", "amount", "seq")


def _loaded(spark: SparkSession, sf: str) -> str:
    """Rules-only load of the even events, then everything with the supplied model score."""
    root = scratch(spark)
    base = featured(spark, sf)
    warehouse.load_scored(spark, root, scoring.score(base).filter(F.col("event_id") % 2 == 0), RUN_TS)
    warehouse.load_scored(
        spark, root, scoring.score(base, ml_score=supplied_ml(), model_version="supplied_ml_v1"), RUN_TS
    )
    return root


@register("warehouse_load_staging")
def _staging(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    tx = transactions(spark, sf)
    warehouse.upsert(spark, root, "stg_transactions", warehouse.staging_rows(tx.filter(F.col("event_id") % 3 == 0)))
    copies = spoiled.replayed(tx).drop("event_id")
    stamped = warehouse.staging_rows(dedup.latest_per_key(copies, ["transaction_id"], ["seq"]))
    warehouse.upsert(spark, root, "stg_transactions", stamped)
    table = warehouse.read_table(spark, root, "stg_transactions")
    doubles = [F.col(c).cast("double").alias(c) for c in ("amount", "latitude", "longitude")]
    return _texted(table).select("transaction_id", "event_time", "user_id", "merchant_category", "city", *doubles)


@register("warehouse_load_scores")
def _load_scores(spark: SparkSession, sf: str) -> DataFrame:
    table = warehouse.read_table(spark, _loaded(spark, sf), "transaction_scores")
    doubles = [F.col(c).cast("double").alias(c) for c in ("amount", "risk_score", "rule_score", "ml_anomaly_score")]
    return _texted(table).select(
        "transaction_id", "event_time", "user_id", "risk_level", "model_version", "reasons_json", *doubles
    )


@register("warehouse_load_alerts")
def _load_alerts(spark: SparkSession, sf: str) -> DataFrame:
    table = warehouse.read_table(spark, _loaded(spark, sf), "fraud_alerts")
    return table.select(
        "alert_id", "transaction_id", "user_id", F.col("risk_score").cast("double").alias("risk_score"), "risk_level"
    )


@register("warehouse_daily_metrics")
def _daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    root = _loaded(spark, sf)
    warehouse.refresh_daily_metrics(spark, root, "2024-01-01", "2024-01-20")
    table = warehouse.refresh_daily_metrics(spark, root, "2024-01-15", "2024-02-28")  # overlaps: replaced, not doubled
    table = warehouse.read_table(spark, root, "daily_fraud_metrics")
    doubles = [F.col(c).cast("double").alias(c) for c in ("total_volume", "avg_risk_score", "fraud_alert_rate")]
    return table.select(
        F.date_format("metric_date", "yyyy-MM-dd").alias("metric_date"), "total_transactions", "high_risk_count",
        "medium_risk_count", "low_risk_count", *doubles,
    )


@register("backfill_range")
def _backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Balances of all days are stored once; the backfill reads those before its range, its range and the hour before."""
    root = scratch(spark)
    jobs.update_balances(spark, root, transactions(spark, sf))
    opened = jobs.opening(spark, root, "2024-01-10")
    return score_view(jobs.backfill(transactions(spark, sf), "2024-01-10", "2024-01-13", opening=opened))


# --- quality -------------------------------------------------------------------------


@register("dq_audit")
def _audit(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.audit(spoiled.faulty_staging(transactions(spark, sf)))
    return report.withColumn("issues", F.array_join("issues", "; "))


@register("dq_audit_clean")
def _audit_clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.audit(transactions(spark, sf)).withColumn("issues", F.array_join("issues", "; "))


QUERIES["dq_duplicates"] = lambda s, sf: quality.duplicate_ids(spoiled.faulty_staging(transactions(s, sf)))
QUERIES["dq_extended"] = lambda s, sf: quality.extended_checks(
    spoiled.faulty_staging(transactions(s, sf)), "2024-01-30 00:00:00"
)


# --- evaluation and registry ---------------------------------------------------------


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(score, label) by joining scores and labels on the transaction id."""
    tx = transactions(spark, sf)
    scores = tx.select("transaction_id", "event_time", supplied_ml().alias("score"))
    labels = spoiled.labelled(tx).select("transaction_id", F.col("is_fraud").alias("label"))
    return scores.join(labels, "transaction_id").select("event_time", "score", "label")


QUERIES["confusion_matrix"] = lambda s, sf: evaluate.confusion(pairs(s, sf), 0.55)
QUERIES["eval_metrics"] = lambda s, sf: evaluate.evaluate(pairs(s, sf), 0.55)
QUERIES["roc_auc"] = lambda s, sf: evaluate.roc_auc(pairs(s, sf))
QUERIES["best_threshold"] = lambda s, sf: evaluate.best_threshold(pairs(s, sf)).select(
    rounded(F.col("threshold"), 6).alias("threshold"), "f1_score", "precision", "recall"
)
QUERIES["threshold_sweep"] = lambda s, sf: evaluate.threshold_sweep(pairs(s, sf)).select(
    rounded(F.col("threshold"), 6).alias("threshold"), "true_positives", "false_positives", "false_negatives",
    "true_negatives", "precision", "recall", "f1_score", "false_positive_rate",
)
QUERIES["score_percentiles"] = lambda s, sf: evaluate.percentiles(scored(s, sf), "risk_score")


@register("normalize_score")
def _normalize(spark: SparkSession, sf: str) -> DataFrame:
    from tollgate.operators.iforest import normalize

    raw = F.col("event_id") % 1300 / 1000.0 - 0.6
    return transactions(spark, sf).select("transaction_id", rounded(normalize(raw), 4).alias("anomaly_score"))


def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per day: the supplied score evaluated on that day's labels."""
    daily = pairs(spark, sf).withColumn("day", F.to_date("event_time"))
    rates = evaluate.with_rates(evaluate.confusion(daily, 0.55, ("day",)))
    return rates.select(
        F.concat(F.lit("iforest_"), F.date_format("day", "yyyyMMdd")).alias("model_version"),
        F.lit("IsolationForest").alias("algorithm"),
        F.lit("{}").alias("hyperparameters_json"),
        "f1_score", F.col("precision").alias("precision_score"), F.col("recall").alias("recall_score"),
        registry.initial_status(F.col("f1_score")).alias("status"),
        F.col("day").cast("timestamp").alias("trained_at"),
    )


QUERIES["latest_approved_model"] = lambda s, sf: registry.latest_approved(model_runs(s, sf)).select(
    "model_version", "f1_score", "status"
)
QUERIES["model_gate"] = lambda s, sf: registry.gate(model_runs(s, sf))


@register("model_registry_status")
def _registry_status(spark: SparkSession, sf: str) -> DataFrame:
    runs = model_runs(spark, sf)
    again = runs.filter(F.col("f1_score") < 0.6).withColumn("f1_score", F.lit(0.6))  # re-registered versions
    merged = registry.register(runs, again)
    return registry.update_status(merged, "iforest_20240105", "RETIRED").select(
        "model_version", "f1_score", "status"
    )
