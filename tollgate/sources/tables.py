"""Readers for the driver's tables and the transactions derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Places used by the derived transactions.
PLACES = (
    (0, "Delhi", 28.6139, 77.209, "IN"),
    (1, "Mumbai", 19.076, 72.8777, "IN"),
    (2, "Chennai", 13.0827, 80.2707, "IN"),
    (3, "Bengaluru", 12.9716, 77.5946, "IN"),
    (4, "London", 51.5074, -0.1278, "GB"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index, position: int):
    """Value of a place attribute chosen by the row's place number."""
    return F.element_at(F.array(*[F.lit(place[position]) for place in PLACES]), (index + 1).cast("int"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Payment transactions derived row by row from `events` (see FIXTURES.md).

    Time of day is compressed 200-fold and shifted by a per-user hour so that velocity
    windows have something to count; the date is kept. No join: the five places are a
    case expression. `event_id` stays available as the arrival sequence.
    """
    day = 86_400_000_000
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    in_day = F.pmod(ts, F.lit(day))
    eid, uid = F.col("event_id"), F.col("user_id")
    place = F.when(eid % 13 == 0, (uid + eid) % 5).otherwise(uid % 4)
    text = lambda c: c.cast("string")
    kind = F.col("event_type")
    category = (
        F.when((kind == "purchase") & (eid % 3 == 0), "electronics")
        .when((kind == "signup") & (eid % 5 == 0), "jewelry")
        .when(kind == "click", "groceries")
        .when(kind == "view", "coffee")
        .when(kind == "error", "fuel")
        .otherwise("food_delivery")
    )
    pay = (
        F.when(eid % 4 == 0, "UPI").when(eid % 4 == 1, "CREDIT_CARD").when(eid % 4 == 2, "DEBIT_CARD")
        .otherwise("NETBANKING")
    )
    device = uid * 100 + F.when(eid % 17 == 0, eid % 97 + 1).otherwise(0)
    shifted = ts - in_day + F.floor(in_day / 200) + (uid % 24) * 3_600_000_000
    return events.select(
        F.concat(F.lit("tx_"), text(eid)).alias("transaction_id"),
        F.timestamp_micros(shifted).alias("event_time"),
        F.concat(F.lit("usr_"), text(uid)).alias("user_id"),
        F.concat(F.lit("acc_"), text(uid)).alias("account_id"),
        F.round(F.col("value") * 250, 2).alias("amount"),
        F.lit("INR").alias("currency"),
        F.concat(F.lit("m_"), text((eid * 7) % 23)).alias("merchant_id"),
        category.alias("merchant_category"),
        pay.alias("payment_method"),
        F.concat(F.lit("dev_"), text(device)).alias("device_id"),
        F.concat(F.lit("10.20."), text(eid % 254 + 1), F.lit("."), text(uid % 254 + 1)).alias("ip_address"),
        _pick(place, 2).alias("latitude"),
        _pick(place, 3).alias("longitude"),
        _pick(place, 4).alias("country"),
        _pick(place, 1).alias("city"),
        "event_id",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 contract columns plus `event_id` for the whole `events` table."""
    return transactions_from_events(table(spark, sf_dir, "events"))
