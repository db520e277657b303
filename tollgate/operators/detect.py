"""Detectors for the fraud shapes that occur in transaction streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, HIGH_RISK_CATEGORIES, Config
from tollgate.functions import rounded
from tollgate.operators.features import distance_from_last
from tollgate.operators.timeline import MICROS, count_rows, find_hot_users, micros, prior_profile, with_lookback


def velocity_escalation(tx: DataFrame, max_gap_s: int = 45, cfg: Config = DEFAULT) -> DataFrame:
    """Third or later payment of a run of growing amounts at most `max_gap_s` apart."""
    hot = find_hot_users(tx, cfg)
    rows, keys = with_lookback(tx.withColumn("_us", micros()), hot, 2 * max_gap_s)
    order = Window.partitionBy(*keys).orderBy("_us", "transaction_id")
    seen = rows.select(
        "*",
        F.lag("amount", 1).over(order).alias("_a1"), F.lag("amount", 2).over(order).alias("_a2"),
        F.lag("_us", 1).over(order).alias("_t1"), F.lag("_us", 2).over(order).alias("_t2"),
    )
    gap = max_gap_s * MICROS
    run = (
        (F.col("amount") > F.col("_a1")) & (F.col("_a1") > F.col("_a2"))
        & (F.col("_us") - F.col("_t1") <= gap) & (F.col("_t1") - F.col("_t2") <= gap)
    )
    return seen.filter(F.col("_own") & run).select(
        *tx.columns, F.col("_a1").alias("previous_amount"), F.col("_a2").alias("amount_before_that")
    )


def amount_spike(features: DataFrame, min_amount: float = 95_000.0, min_ratio: float = 3.0) -> DataFrame:
    """A large amount that is also far above what the user did before."""
    unusual = (F.col("amount_vs_user_avg") >= min_ratio) | (F.col("amount_zscore") >= min_ratio)
    return features.filter((F.col("amount") >= min_amount) & unusual)


def impossible_travel(tx: DataFrame, max_kmh: float = 900.0, cfg: Config = DEFAULT) -> DataFrame:
    """Faster than any flight since the previous transaction."""
    hot, rows = count_rows(tx, cfg)
    known = prior_profile(tx, hot=hot, rows=rows, last=True)
    seconds = (F.col("_us") + F.col("_last.neg_us")) / float(MICROS)
    moved = known.filter(F.col("_n") > 0).select(
        *tx.columns, distance_from_last().alias("km"), seconds.alias("seconds")
    )
    speed = F.col("km") / (F.col("seconds") / 3600.0)
    return moved.withColumn("kmh", rounded(speed, 1)).filter(speed > max_kmh)


def new_device_high_value(features: DataFrame, min_amount: float = 65_000.0) -> DataFrame:
    return features.filter((F.col("new_device") == 1.0) & (F.col("amount") >= min_amount))


def merchant_shift(tx: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """First visit of a user with a past to a high-risk category."""
    hot, rows = count_rows(tx, cfg)
    known = prior_profile(tx, hot=hot, rows=rows, novelty=("merchant_category",))
    risky = F.lower("merchant_category").isin(*HIGH_RISK_CATEGORIES)
    return known.filter((F.col("_new_merchant_category") == 1.0) & risky).select(*tx.columns)


def burst(
    tx: DataFrame, max_amount: float = 100.0, seconds: int = 60, min_count: int = 10, cfg: Config = DEFAULT
) -> DataFrame:
    """A micro-payment that is at least the `min_count`-th within the time span."""
    small = tx.filter(F.col("amount") < max_amount)
    hot, rows = count_rows(small, cfg)
    known = prior_profile(small, hot=hot, rows=rows, count_spans=(seconds,))
    count = F.col(f"_cnt_{seconds}") + 1
    return known.select(*tx.columns, count.alias("payments_in_span")).filter(
        F.col("payments_in_span") >= min_count
    )


def sessions(tx: DataFrame, gap_s: int = 60, min_count: int = 1, cfg: Config = DEFAULT) -> DataFrame:
    """Runs of a user's transactions with no pause longer than `gap_s`.

    A run is named by its first time, carried forward as a running maximum; counting it is
    an ordinary aggregation, so even one huge run is combined before its shuffle.
    """
    hot = find_hot_users(tx, cfg)
    rows, keys = with_lookback(tx.select("user_id", "amount", micros().alias("_us")), hot, gap_s)
    order = Window.partitionBy(*keys).orderBy("_us")
    before = F.lag("_us").over(order)
    starts = F.when(before.isNull() | (F.col("_us") - before > gap_s * MICROS), F.col("_us"))
    marked = rows.withColumn("_start", starts).filter(F.col("_own")).withColumn("_opening", F.lit(False))
    if hot is not None:
        chunks = marked.filter(F.col("_width").isNotNull()).groupBy("user_id", "_width", "_chunk").agg(
            F.max("_start").alias("_start")
        )
        earlier = Window.partitionBy("user_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        marked = marked.unionByName(
            chunks.select(
                "user_id", "_width", "_chunk", F.max("_start").over(earlier).alias("_start"),
                (F.col("_chunk") * F.col("_width") - 1).alias("_us"), F.lit(True).alias("_opening"),
            ),
            allowMissingColumns=True,
        )
    running = Window.partitionBy(*keys).orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    named = marked.withColumn("_session", F.max("_start").over(running)).filter(~F.col("_opening"))
    return (
        named.groupBy("user_id", "_session")
        .agg(
            F.count("*").alias("tx_count"),
            F.sum(F.col("amount").cast("decimal(28,8)")).cast("double").alias("_total"),
            F.max("_us").alias("_end"),
        )
        .filter(F.col("tx_count") >= min_count)
        .select(
            "user_id", F.timestamp_micros("_session").alias("session_start"),
            F.timestamp_micros("_end").alias("session_end"), "tx_count", rounded(F.col("_total"), 2).alias("total_amount"),
        )
    )
