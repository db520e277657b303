"""Scheduled jobs as plain functions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, Config
from tollgate.operators import balances, evaluate, iforest, quality, scoring
from tollgate.operators.features import add_features
from tollgate.operators.timeline import MICROS, Opening
from tollgate.plans import registry, warehouse


def update_balances(spark: SparkSession, root: str, tx: DataFrame) -> None:
    """Summarise the days that `tx` holds (whole days) and replace them in the stored balances."""
    for table, rows in (("user_days", balances.user_days(tx)), ("sight_days", balances.sight_days(tx))):
        spread = rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        spread.partitionBy("day").parquet(f"{root}/balances/{table}")


def opening(spark: SparkSession, root: str, day: str) -> Opening:
    """The stored balances' opening of a day; only the folders of earlier days are read."""
    users, sights = (spark.read.parquet(f"{root}/balances/{table}") for table in ("user_days", "sight_days"))
    return balances.opening(users, sights, day)


def backfill(
    tx: DataFrame, start: str, end: str, cfg: Config = DEFAULT, history_days: int | None = None, opening: Opening | None = None
) -> DataFrame:
    """Rules-only scores of the events in [start, end), seen against their past.

    With the `opening` of the day of `start`, only the events since an hour before that day are read. Without one, all
    earlier history is, because z-score and novelty look back without limit; `history_days` trades that for a smaller scan.
    """
    first, stop = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    past = tx.filter(F.col("event_time") < stop)
    if opening is not None:
        past = past.filter(F.col("event_time") >= F.timestamp_micros(F.lit(opening.since - 3600 * MICROS)))
    elif history_days is not None:
        past = past.filter(F.col("event_time") >= first - F.make_dt_interval(F.lit(history_days)))
    return scoring.score(add_features(past, cfg, opening=opening), cfg).filter(F.col("event_time") >= first)


def run_backfill(
    spark: SparkSession, root: str, tx: DataFrame, start: str, end: str, run_ts: str, cfg: Config = DEFAULT,
    opening: Opening | None = None,
) -> DataFrame:
    """Score a range, load it and return a one-row summary; safe to run again."""
    warehouse.load_scored(spark, root, backfill(tx, start, end, cfg, opening=opening), run_ts, days_fixed=True)
    loaded = warehouse.read_table(spark, root, "transaction_scores").filter(
        (F.col("event_date") >= F.lit(start).cast("date")) & (F.col("event_time") >= F.lit(start).cast("timestamp"))
        & (F.col("event_time") < F.lit(end).cast("timestamp"))
    )
    return loaded.agg(F.count("*").alias("num_events_backfilled")).select(
        "num_events_backfilled", F.lit(start).alias("start_time"), F.lit("SUCCESS").alias("status")
    )


def retrain(
    spark: SparkSession, train_features: DataFrame, eval_features: DataFrame, labels: DataFrame, runs: DataFrame,
    *, version: str, trained_at: str, model_dir: str, cfg: Config = DEFAULT,
) -> tuple[DataFrame, dict]:
    """Train, evaluate on labels joined by transaction id, save, register and gate a model.

    `runs` is the registry table; the updated one is returned with the decision. The
    candidate is compared with the latest model approved before it, never with itself.
    """
    forest = iforest.train(train_features, cfg, version)
    iforest.save(forest, f"{model_dir}/{version}")
    judged = iforest.with_anomaly_score(eval_features, forest)
    pairs = judged.select("transaction_id", F.col("anomaly_score").alias("score")).join(
        labels.select("transaction_id", F.col("is_fraud").alias("label")), "transaction_id"
    ).persist()
    best = evaluate.best_threshold(pairs).first().asDict()
    best["roc_auc"] = evaluate.roc_auc(pairs).first()["roc_auc"]
    pairs.unpersist()

    previous = registry.latest_approved(runs, exclude=version).first()
    previous_f1 = float(previous["f1_score"]) if previous else 0.0
    passed = best["f1_score"] >= cfg.min_f1 and best["f1_score"] >= previous_f1 - cfg.f1_tolerance
    status = "APPROVED" if passed else "REJECTED"
    settings = {
        "n_estimators": cfg.n_trees, "max_samples": cfg.sample_size, "contamination": cfg.contamination,
        "seed": cfg.seed, "optimal_threshold": best["threshold"],
    }
    row = spark.range(1).select(
        F.lit(version).alias("model_version"), F.lit("IsolationForest").alias("algorithm"),
        F.lit(json.dumps(settings)).alias("hyperparameters_json"), F.lit(best["f1_score"]).alias("f1_score"),
        F.lit(best["precision"]).alias("precision_score"), F.lit(best["recall"]).alias("recall_score"),
        F.lit(status).alias("status"), F.lit(trained_at).cast("timestamp").alias("trained_at"),
    )
    typed = row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in runs.schema])
    return registry.register(runs, typed), {
        "model_version": version, "status": status, "candidate_f1": best["f1_score"], "previous_f1": previous_f1,
        "metrics": best,
    }


def data_quality(spark: SparkSession, root: str) -> DataFrame:
    """Audit of the stored staging table."""
    return quality.audit(warehouse.read_table(spark, root, "stg_transactions"))
