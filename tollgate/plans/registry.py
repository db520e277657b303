"""Model runs: registration, status, latest approved model and the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, Config
from tollgate.operators.dedup import latest_per_key

STATUSES = ("CANDIDATE", "APPROVED", "REJECTED", "RETIRED")


def register(runs: DataFrame, new: DataFrame) -> DataFrame:
    """Add runs; a version that exists already is replaced."""
    both = runs.withColumn("_order", F.lit(0)).unionByName(new.withColumn("_order", F.lit(1)))
    return latest_per_key(both, ["model_version"], ["_order"]).drop("_order")


def update_status(runs: DataFrame, model_version: str, status: str) -> DataFrame:
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}, not {status!r}")
    if runs.filter(F.col("model_version") == model_version).isEmpty():
        raise KeyError(f"unknown model version {model_version!r}")
    return runs.withColumn(
        "status", F.when(F.col("model_version") == model_version, status).otherwise(F.col("status"))
    )


def latest_approved(runs: DataFrame, exclude: str | None = None) -> DataFrame:
    """At most one row: the most recently trained approved run."""
    approved = runs.filter(F.col("status") == "APPROVED")
    if exclude is not None:
        approved = approved.filter(F.col("model_version") != exclude)
    return approved.orderBy(F.desc("trained_at"), F.desc("model_version")).limit(1)


def initial_status(f1, cfg: Config = DEFAULT):
    return F.when(f1 >= cfg.min_f1, "APPROVED").otherwise("CANDIDATE")


def gate(runs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Decision for every run against the latest run approved before it.

    A run is never its own predecessor. One row per trained model; ordered per algorithm.
    """
    before = (
        Window.partitionBy("algorithm").orderBy("trained_at", "model_version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    approved_f1 = F.when(F.col("status") == "APPROVED", F.col("f1_score"))
    previous = F.coalesce(F.last(approved_f1, ignorenulls=True).over(before), F.lit(0.0))
    passes = (F.col("f1_score") >= cfg.min_f1) & (F.col("f1_score") >= F.col("previous_f1") - cfg.f1_tolerance)
    return runs.withColumn("previous_f1", previous).select(
        "model_version",
        F.col("f1_score").alias("candidate_f1"),
        "previous_f1",
        F.when(passes, "APPROVED").otherwise("REJECTED").alias("final_status"),
    )
