"""Input of the registered queries: payloads, replays, faults and labels made from every row of the events table.

Which rows are spoiled follows from the event id, so that the outcome is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Payload text by kind of damage (k = event_id % 40); plain SQL, the same on any engine.
PAYLOAD_SQL = """
CASE WHEN k = 1 THEN concat('{"transaction_id":"', transaction_id) WHEN k = 13 THEN '[1,2]' ELSE
concat('{"transaction_id":"', transaction_id,
  '","event_time":"', CASE WHEN k = 9 THEN 'yesterday' WHEN k = 14 THEN concat(event_text, 'Z') WHEN k = 15 THEN concat(event_text, '+05:30') ELSE event_text END,
  '","user_id":', CASE WHEN k = 4 THEN '77' ELSE concat('"', user_id, '"') END,
  ',"account_id":"', account_id,
  '","amount":', CASE WHEN k = 2 THEN '-17.25' WHEN k = 7 THEN concat('"', cast(cast(amount AS decimal(15,2)) AS varchar(30)), '"') WHEN k = 12 THEN '"plenty"' ELSE cast(cast(amount AS decimal(15,2)) AS varchar(30)) END,
  CASE WHEN k = 5 THEN ',"currency":null' WHEN k = 6 THEN '' ELSE concat(',"currency":"', currency, '"') END,
  CASE WHEN k = 10 THEN '' ELSE concat(',"merchant_id":"', merchant_id, '"') END,
  ',"merchant_category":"', merchant_category, '","payment_method":"', payment_method,
  '","device_id":"', device_id, '","ip_address":"', ip_address,
  '","latitude":', CASE WHEN k = 3 THEN '91' ELSE cast(cast(latitude AS decimal(9,6)) AS varchar(30)) END,
  ',"longitude":', CASE WHEN k = 11 OR k = 3 THEN '-200.5' ELSE cast(cast(longitude AS decimal(9,6)) AS varchar(30)) END,
  ',"country":"', country, '","city":"', city, '"',
  CASE WHEN k = 8 THEN ',"extra":[1,{"a":null}]' ELSE '' END, '}') END
"""


def payloads(tx: DataFrame) -> DataFrame:
    """(value, partition, offset): JSON text of every transaction, one in forty kinds spoiled."""
    prepared = tx.withColumn("k", F.col("event_id") % 40).withColumn(
        "event_text", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    return prepared.select(
        F.expr(PAYLOAD_SQL).alias("value"),
        F.pmod(F.col("event_id"), F.lit(6)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def replayed(tx: DataFrame) -> DataFrame:
    """Every transaction, and every tenth once more with a corrected amount, in arrival order."""
    first = tx.withColumn("seq", F.col("event_id"))
    again = tx.filter(F.col("event_id") % 10 == 0).withColumn("amount", F.col("amount") + 1.0)
    return first.unionByName(again.withColumn("seq", F.col("event_id") + 1_000_000_000_000))


def faulty_staging(tx: DataFrame) -> DataFrame:
    """Staging rows with null ids, negative amounts, bad coordinates and repeated ids."""
    eid = F.col("event_id")
    spoiled = tx.select(
        F.when(eid % 101 == 7, F.concat(F.lit("tx_"), (eid - 1).cast("string"))).otherwise(F.col("transaction_id"))
        .alias("transaction_id"),
        "event_time",
        F.when(eid % 89 != 5, F.col("user_id")).alias("user_id"),
        "account_id",
        F.when(eid % 97 == 3, -F.col("amount") - 1.0).otherwise(F.col("amount")).alias("amount"),
        F.when(eid % 83 == 2, "inr").otherwise(F.col("currency")).alias("currency"),
        F.when(eid % 79 == 1, "").otherwise(F.col("merchant_id")).alias("merchant_id"),
        "merchant_category", "payment_method", "device_id", "ip_address",
        F.when(eid % 103 == 9, F.lit(91.5)).otherwise(F.col("latitude")).alias("latitude"),
        "longitude", "country", "city",
    )
    return spoiled


def labelled(tx: DataFrame) -> DataFrame:
    """Transactions with evaluation labels that mostly, not always, follow the model score."""
    eid = F.col("event_id")
    ml = (eid * 7919) % 1000 / 1000.0
    noisy_day = F.dayofmonth("event_time") % 6 == 0
    fraud = F.when(noisy_day, eid % 3 == 0).otherwise(((ml >= 0.62) & (eid % 7 != 0)) | (eid % 23 == 0))
    return tx.select(
        *tx.columns, fraud.alias("is_fraud"),
        F.when(fraud, "SCENARIO_2_LARGE_AMOUNT_ANOMALY").otherwise("NORMAL").alias("scenario"),
        F.when(fraud, "label by rule").alias("reason"),
    )
