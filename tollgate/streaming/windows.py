"""Event-time window aggregates per user, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Frame
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, Config
from tollgate.operators.timeline import micros


def sliding_aggregates(
    events: DataFrame, duration: str = "5 minutes", slide: str = "1 minute", *, label: str = "5m",
    exact_merchants: bool = False, cfg: Config = DEFAULT,
) -> DataFrame:
    """Count, sum, mean, maximum and distinct merchants per user and sliding window.

    Partial aggregates are built before the shuffle, so a hot user sends one row per
    window and task. Distinct merchants are approximate unless asked otherwise.
    """
    merchants: Column = (
        F.size(F.collect_set("merchant_id")).cast("bigint") if exact_merchants
        else F.approx_count_distinct("merchant_id")
    )
    exact_sum = F.sum(F.col("amount").cast("decimal(28,8)")).cast("double")
    return (
        events.withWatermark("event_time", f"{cfg.watermark_minutes} minutes")
        .groupBy(F.window("event_time", duration, slide), "user_id")
        .agg(
            F.count("transaction_id").alias(f"tx_count_{label}"),
            exact_sum.alias(f"amount_sum_{label}"),
            (exact_sum / F.count("amount")).alias(f"avg_amount_{label}"),
            F.max("amount").alias(f"max_amount_{label}"),
            merchants.alias(f"unique_merchants_{label}"),
        )
    )


def burst_sessions(events: DataFrame, gap: str = "60 seconds", cfg: Config = DEFAULT) -> DataFrame:
    """Session windows per user on a stream."""
    return (
        events.withWatermark("event_time", f"{cfg.watermark_minutes} minutes")
        .groupBy(F.session_window("event_time", gap).alias("session"), "user_id")
        .agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"))
    )


def dedup(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """First arrival of each id within the watermark delay."""
    return events.withWatermark("event_time", f"{cfg.watermark_minutes} minutes").dropDuplicatesWithinWatermark(
        ["transaction_id"]
    )


def late_events(events: DataFrame, arrival: str, cfg: Config = DEFAULT, block_rows: int = 1_000_000) -> DataFrame:
    """Rows of a table that arrived after the watermark had passed them.

    The newest time seen so far runs over all users in arrival order. It is taken inside
    blocks of arrivals; each opens with the maximum of the blocks before it.
    """
    rows = events.withColumn("_us", micros()).withColumn("_block", F.floor(F.col(arrival) / block_rows))
    earlier = Frame.orderBy("_block").rowsBetween(Frame.unboundedPreceding, -1)
    opening = rows.groupBy("_block").agg(F.max("_us").alias("_us")).select(
        "_block", F.max("_us").over(earlier).alias("_us"), (F.col("_block") * block_rows - 1).alias(arrival)
    ).withColumn("_opening", F.lit(True))
    inside = Frame.partitionBy("_block").orderBy(arrival).rowsBetween(Frame.unboundedPreceding, -1)
    seen = rows.withColumn("_opening", F.lit(False)).unionByName(opening, allowMissingColumns=True)
    newest = seen.withColumn("_newest", F.max("_us").over(inside)).filter(~F.col("_opening"))
    limit = F.col("_newest") - F.lit(cfg.watermark_minutes * 60_000_000)
    return newest.filter(F.col("_us") < limit).select(
        *events.columns, ((limit - F.col("_us")) / 1e6).alias("seconds_late")
    )
