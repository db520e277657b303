"""Data-quality audit of the staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import compact, fill

# The sentence for each kind of issue.
SENTENCES = {
    "null_ids": "Found {n} transactions with null or empty IDs",
    "negative_amounts": "Found {n} transactions with invalid negative amounts",
    "invalid_coordinates": "Found {n} transactions with out-of-bounds lat/lon coordinates",
    "duplicate_ids": "Found {n} duplicate transaction ID entries",
}

IDS = ("transaction_id", "user_id", "account_id")


def _any_null() -> Column:
    return F.greatest(*[F.col(c).isNull().cast("int") for c in IDS]) == 1


def _off_map() -> Column:
    return (F.abs("latitude") > 90) | (F.abs("longitude") > 180)


def fault_counts(staging: DataFrame) -> DataFrame:
    """One row: total, null ids, negative amounts, bad coordinates, repeated ids.

    The first aggregation is per id (combined before its shuffle); the second adds up.
    """
    per_id = staging.groupBy("transaction_id").agg(
        F.count("*").alias("rows"),
        F.count_if(_any_null()).alias("null_ids"),
        F.count_if(F.col("amount") < 0).alias("negative"),
        F.count_if(_off_map()).alias("off_map"),
    )
    zero = F.lit(0).cast("bigint")
    return per_id.agg(
        F.coalesce(F.sum("rows"), zero).alias("total_records_checked"),
        F.coalesce(F.sum("null_ids"), zero).alias("null_ids"),
        F.coalesce(F.sum("negative"), zero).alias("negative_amounts"),
        F.coalesce(F.sum("off_map"), zero).alias("invalid_coordinates"),
        F.count_if(F.col("rows") > 1).alias("duplicate_ids"),
    )


def audit(staging: DataFrame) -> DataFrame:
    """Status, counts and one sentence per kind of issue found."""
    issues = compact(
        *[
            F.when(F.col(c) > 0, fill(text, {"n": F.col(c).cast("string")}))
            for c, text in SENTENCES.items()
        ]
    )
    return fault_counts(staging).withColumn("issues", issues).select(
        F.when(F.size("issues") == 0, "PASSED").otherwise("FAILED").alias("status"),
        "total_records_checked",
        F.size("issues").cast("bigint").alias("issues_count"),
        "issues",
        *SENTENCES,
    )


def duplicate_ids(staging: DataFrame) -> DataFrame:
    return staging.groupBy("transaction_id").agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def extended_checks(staging: DataFrame, now: str) -> DataFrame:
    """Further validity counters: empty texts, currency code, times after `now`."""
    blank = lambda c: F.trim(F.col(c)) == ""
    return staging.agg(
        F.count_if(blank("transaction_id") | blank("user_id") | blank("account_id")).alias("empty_ids"),
        F.count_if(~F.col("currency").rlike("^[A-Z]{3}$")).alias("bad_currency"),
        F.count_if(F.col("merchant_id").isNull() | blank("merchant_id")).alias("bad_merchant"),
        F.count_if(F.col("device_id").isNull() | blank("device_id")).alias("bad_device"),
        F.count_if(F.col("event_time").isNull() | (F.col("event_time") > F.lit(now).cast("timestamp"))).alias(
            "bad_event_time"
        ),
    )
