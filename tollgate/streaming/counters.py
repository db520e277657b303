"""Counters of a running stream: what each micro-batch consumed, failed and predicted, kept per batch.

The contract's counts are observed inside the stream's own plan and come with its progress; a listener stores them as batches
finish, and `record` stores those of a query that has ended. Predictions are counted where they are stored. A batch's
counters replace what was stored under its number, so a repeated batch counts once, across restarts too.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tollgate.plans import warehouse

CONTRACT = "contract"
_ONE_AT_A_TIME = threading.Lock()


def observed(checked: DataFrame) -> DataFrame:
    """Checked events whose numbers are observed as they pass."""
    failed = F.count_if(F.size("errors") > 0).alias("events_failed")
    return checked.observe(CONTRACT, F.count("*").alias("events_consumed"), failed)


def store(spark: SparkSession, root: str, kind: str, batch_id: int, totals: dict[str, int]) -> None:
    """A few rows (metric, total) in the batch's own folder."""
    rows = spark.createDataFrame(sorted(totals.items()), "metric string, total long").coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/counters/{kind}-{batch_id}")


def store_predictions(spark: SparkSession, root: str, batch_id: int, scored: DataFrame) -> None:
    levels = scored.groupBy(F.concat(F.lit("risk_predictions_"), F.lower("risk_level")).alias("metric")).agg(F.count("*").alias("total"))
    store(spark, root, "predictions", batch_id, {r["metric"]: r["total"] for r in levels.collect()})  # a row per level


def store_progress(spark: SparkSession, root: str, progress) -> None:
    """The observed counts of one progress report, if it has any. Only batches that finished are reported, so what is stored stays."""
    row = (progress.observedMetrics or {}).get(CONTRACT)
    if row is None or not progress.numInputRows:
        return
    with _ONE_AT_A_TIME:  # the listener runs in its own thread
        if not warehouse.exists(spark, f"{root}/counters/{CONTRACT}-{progress.batchId}/_SUCCESS"):
            store(spark, root, CONTRACT, progress.batchId, {k: int(v or 0) for k, v in row.asDict().items()})


def record(spark: SparkSession, root: str, query: StreamingQuery) -> None:
    """Store what a query still reports of its latest batches."""
    for progress in query.recentProgress:
        store_progress(spark, root, progress)


class CounterListener(StreamingQueryListener):
    """Stores the counters of every batch that the query of this name finishes."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            store_progress(self.spark, self.root, event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read(spark: SparkSession, root: str) -> DataFrame:
    """(metric, total) over all batches so far."""
    rows = spark.read.schema("metric string, total long").parquet(f"{root}/counters/*")
    return rows.groupBy("metric").agg(F.sum("total").alias("total"))
