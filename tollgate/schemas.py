"""Explicit schemas of the event stream and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

TEXT_FIELDS = (
    "transaction_id",
    "user_id",
    "account_id",
    "currency",
    "merchant_id",
    "merchant_category",
    "payment_method",
    "device_id",
    "ip_address",
    "country",
    "city",
)
NUMBER_FIELDS = ("amount", "latitude", "longitude")

# Optional on the wire: a missing field takes the default, an explicit null does not.
DEFAULTS = {"currency": "INR", "country": "IN"}

_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()

TXN_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", _S, False),
        T.StructField("event_time", _TS, False),
        T.StructField("user_id", _S, False),
        T.StructField("account_id", _S, False),
        T.StructField("amount", _D, False),
        T.StructField("currency", _S, False),
        T.StructField("merchant_id", _S, False),
        T.StructField("merchant_category", _S, False),
        T.StructField("payment_method", _S, False),
        T.StructField("device_id", _S, False),
        T.StructField("ip_address", _S, False),
        T.StructField("latitude", _D, False),
        T.StructField("longitude", _D, False),
        T.StructField("country", _S, False),
        T.StructField("city", _S, False),
    ]
)
TXN_COLUMNS = TXN_SCHEMA.fieldNames()

LABEL_COLUMNS = ("is_fraud", "scenario", "reason")

# Warehouse tables: DDL column list, key column, and the partition column for the
# tables that grow with the stream.
TABLES = {
    "raw_transactions": (
        "transaction_id STRING, event_time TIMESTAMP, user_id STRING, raw_payload STRING, "
        "ingested_at TIMESTAMP, event_date DATE",
        "transaction_id",
        "event_date",
    ),
    "stg_transactions": (
        "transaction_id STRING, event_time TIMESTAMP, user_id STRING, account_id STRING, "
        "amount DECIMAL(15,2), currency STRING, merchant_id STRING, merchant_category STRING, "
        "payment_method STRING, device_id STRING, ip_address STRING, latitude DECIMAL(9,6), "
        "longitude DECIMAL(9,6), country STRING, city STRING, event_date DATE",
        "transaction_id",
        "event_date",
    ),
    "transaction_scores": (
        "transaction_id STRING, event_time TIMESTAMP, user_id STRING, amount DECIMAL(15,2), "
        "risk_score DECIMAL(5,4), risk_level STRING, rule_score DECIMAL(5,4), "
        "ml_anomaly_score DECIMAL(5,4), model_version STRING, reasons_json STRING, "
        "scored_at TIMESTAMP, event_date DATE",
        "transaction_id",
        "event_date",
    ),
    "fraud_alerts": (
        "alert_id STRING, transaction_id STRING, user_id STRING, amount DECIMAL(15,2), "
        "risk_score DECIMAL(5,4), risk_level STRING, reasons_json STRING, alert_time TIMESTAMP, "
        "event_date DATE",
        "alert_id",
        "event_date",
    ),
    "daily_fraud_metrics": (
        "metric_date DATE, total_transactions BIGINT, total_volume DECIMAL(18,2), "
        "high_risk_count BIGINT, medium_risk_count BIGINT, low_risk_count BIGINT, "
        "avg_risk_score DECIMAL(5,4), fraud_alert_rate DECIMAL(5,4)",
        "metric_date",
        "metric_date",
    ),
    "model_runs": (
        "model_version STRING, algorithm STRING, hyperparameters_json STRING, "
        "f1_score DECIMAL(5,4), precision_score DECIMAL(5,4), recall_score DECIMAL(5,4), "
        "status STRING, trained_at TIMESTAMP",
        "model_version",
        None,
    ),
}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name][0])


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Declare the six warehouse tables as Parquet tables, if they are absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (ddl, _, partition) in TABLES.items():
        clause = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet {clause} "
            f"LOCATION '{location}/{name}'"
        )
