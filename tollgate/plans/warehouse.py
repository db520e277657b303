"""Warehouse tables on Parquet: shaping, appended batches, merge on read, compaction, daily overwrite.

A table is a base, partitioned by day, and a log of deltas. A batch is appended to the log as one folder, so what it writes is
its own size; a delta counts once its folder is complete, and a batch that is repeated under its name replaces its folder.
Reading takes each key from the latest delta that has it, else from the base; a deleted key is a row marked so. `compact` merges the
log into the days concerned: it writes the merged days and the list of days aside, installs them and then drops the deltas,
and `recover` finishes what a crash left. Deltas stay until their rows are installed, and while an installation is
unfinished its days are read from the rows set aside, so every state in between reads as the same table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.dedup import latest_per_key
from tollgate.plans import marts
from tollgate.schemas import TABLES, table_schema

# Stand-ins for columns a scored row may lack.
_STAGING_DEFAULTS = {
    "currency": "INR", "merchant_id": "", "merchant_category": "", "payment_method": "",
    "device_id": "", "ip_address": "", "country": "IN", "city": "",
}
_STAGING_NUMBERS = ("amount", "latitude", "longitude")
COMPACT_AT = 16  # deltas in the log at which an upsert compacts it


def _or_default(df: DataFrame, column: str, default):
    return F.coalesce(F.col(column), F.lit(default)) if column in df.columns else F.lit(default)


def _fit(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's types, in its column order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(table)])


def raw_rows(checked: DataFrame, run_ts: str) -> DataFrame:
    """Landing rows of the messages that could be keyed (valid id and time)."""
    keyed = checked.filter(F.col("transaction_id").isNotNull() & F.col("event_time").isNotNull())
    return _fit(
        keyed.select(
            "transaction_id", "event_time", "user_id", F.col("value").cast("string").alias("raw_payload"),
            F.lit(run_ts).alias("ingested_at"), F.to_date("event_time").alias("event_date"),
        ),
        "raw_transactions",
    )


def staging_rows(events: DataFrame) -> DataFrame:
    out = events
    for column, default in _STAGING_DEFAULTS.items():
        out = out.withColumn(column, _or_default(events, column, default))
    for column in _STAGING_NUMBERS:
        out = out.withColumn(column, _or_default(events, column, 0.0))
    return _fit(out.withColumn("event_date", F.to_date("event_time")), "stg_transactions")


def score_rows(scored: DataFrame, run_ts: str) -> DataFrame:
    reasons = F.coalesce(F.col("reasons"), F.array().cast("array<string>"))
    return _fit(
        scored.select(
            "transaction_id", "event_time", "user_id", "amount",
            _or_default(scored, "risk_score", 0.0).alias("risk_score"),
            _or_default(scored, "risk_level", "LOW").alias("risk_level"),
            _or_default(scored, "rule_score", 0.0).alias("rule_score"),
            _or_default(scored, "ml_anomaly_score", 0.0).alias("ml_anomaly_score"),
            _or_default(scored, "model_version", "v1.0").alias("model_version"),
            F.to_json(reasons).alias("reasons_json"),
            F.lit(run_ts).alias("scored_at"),
            F.to_date("event_time").alias("event_date"),
        ),
        "transaction_scores",
    )


def alert_rows(scored: DataFrame, run_ts: str) -> DataFrame:
    high = score_rows(scored, run_ts).filter(F.col("risk_level") == "HIGH")
    return _fit(
        high.select(
            F.concat(F.lit("alt_"), F.col("transaction_id")).alias("alert_id"),
            "transaction_id", "user_id", "amount", "risk_score", "risk_level", "reasons_json",
            F.col("scored_at").alias("alert_time"), "event_date",
        ),
        "fraud_alerts",
    )


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete folders in a folder: those that a finished job has marked."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []
    return sorted(n for n in names if exists(spark, f"{path}/{n}/_SUCCESS"))


def _log(root: str, table: str) -> str:
    return f"{root}/_deltas/{table}"


def _latest_deltas(spark: SparkSession, root: str, table: str, names: list[str]) -> DataFrame:
    """Per key the row of its latest delta, with `_deleted`."""
    schema = table_schema(table).add("_deleted", "boolean")
    rows = spark.read.schema(schema).parquet(*[f"{_log(root, table)}/{n}" for n in names])
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"/_deltas/{table}/(\d+)", 1).cast("bigint")
    return latest_per_key(rows.withColumn("_age", number), [TABLES[table][1]], ["_age"]).drop("_age")


def _read_base(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The compacted table; days of an unfinished installation come from the rows set aside."""
    _, _, partition = TABLES[table]
    empty = spark.createDataFrame([], table_schema(table))
    base = spark.read.schema(table_schema(table)).parquet(f"{root}/{table}") if exists(spark, f"{root}/{table}") else empty
    if exists(spark, f"{_pending(root, table)}/_SUCCESS"):
        waiting = spark.read.schema(table_schema(table)).parquet(_pending(root, table))
        days = waiting.select(partition).distinct()
        if exists(spark, f"{_touched(root, table)}/_SUCCESS"):
            days = days.union(spark.read.schema("day date").parquet(_touched(root, table))).distinct()
        base = base.join(days, partition, "left_anti").select(base.columns).unionByName(waiting)
    return base


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table, empty if nothing was written yet: the base without the keys of the log, and the log's latest rows."""
    base, names = _read_base(spark, root, table), _folders(spark, _log(root, table))
    if not names:
        return base
    key, changed = TABLES[table][1], _latest_deltas(spark, root, table, names)
    kept = base.join(changed.select(key), key, "left_anti").select(base.columns)
    return kept.unionByName(changed.filter("not _deleted").select(base.columns))


def _replace_days(rows: DataFrame, root: str, table: str) -> None:
    """Overwrite exactly the partitions present in `rows`."""
    partition = TABLES[table][2]
    # rebalance: big days are split over several writers, small ones share one
    (
        rows.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(f"{root}/{table}")
    )


def _pending(root: str, table: str) -> str:
    return f"{root}/_pending/{table}"


def _drop(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _touched(root: str, table: str) -> str:
    return f"{root}/_pending/{table}_days"


def recover(spark: SparkSession, root: str, table: str) -> None:
    """Finish a compaction that an earlier run wrote out but did not install, and drop the deltas it merged.

    The days and deltas concerned are written before the rows, so a finished rows folder always has its lists, and days
    that the replacement leaves empty are removed here as well. Every step may be repeated.
    """
    pending, merged = _pending(root, table), f"{_pending(root, table)}_deltas"
    if exists(spark, f"{pending}/_SUCCESS"):
        written = spark.read.schema(table_schema(table)).parquet(pending)
        _replace_days(written, root, table)
        if exists(spark, f"{_touched(root, table)}/_SUCCESS"):
            days = [row[0] for row in spark.read.schema("day date").parquet(_touched(root, table)).collect()]
            _drop_emptied(spark, root, table, days, written)
        if exists(spark, f"{merged}/_SUCCESS"):
            listed = spark.read.schema("name string, number bigint").parquet(merged).collect()
            numbers = spark.createDataFrame([(max(row["number"] for row in listed),)], "number bigint").coalesce(1)
            numbers.write.mode("overwrite").parquet(f"{_log(root, table)}_compacted")
            for row in listed:
                _drop(spark, f"{_log(root, table)}/{row['name']}")
    for folder in (pending, _touched(root, table), merged):
        _drop(spark, folder)


def _replace(spark: SparkSession, root: str, table: str, days: list, rows: DataFrame, deltas: list[str], last: int) -> None:
    """Make `rows` the content of the given days, through the pending folder, and drop the deltas they hold."""
    spark.createDataFrame([(day,) for day in days], "day date").coalesce(1).write.mode("overwrite").parquet(_touched(root, table))
    listed = spark.createDataFrame([(name, last) for name in deltas], "name string, number bigint").coalesce(1)
    listed.write.mode("overwrite").parquet(f"{_pending(root, table)}_deltas")
    rows.write.mode("overwrite").parquet(_pending(root, table))
    recover(spark, root, table)


def append(spark: SparkSession, root: str, table: str, rows: DataFrame, batch: str | None = None) -> None:
    """Add rows (the table's columns, and `_deleted` if any are deletions) to the log, one per key.

    Under the name of a `batch` they replace what was appended under it before. Numbers grow, also across compactions.
    """
    deleted = F.col("_deleted") if "_deleted" in rows.columns else F.lit(False)
    log, names = _log(root, table), _folders(spark, _log(root, table))
    same = [n for n in names if batch and n.partition("-")[2] == batch]
    last = max([int(n.partition("-")[0]) for n in names], default=0)
    if exists(spark, f"{log}_compacted/_SUCCESS"):
        last = max(last, spark.read.schema("number bigint").parquet(f"{log}_compacted").first()[0])
    name = same[-1] if same else f"{last + 1:012d}" + (f"-{batch}" if batch else "")
    whole = rows.select(*table_schema(table).fieldNames(), deleted.alias("_deleted"))
    whole.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{log}/{name}")


def upsert(
    spark: SparkSession, root: str, table: str, batch: DataFrame, *, version: list[str] | None = None,
    days_fixed: bool = False, unique: bool = False, name: str | None = None, compact_at: int = COMPACT_AT,
) -> None:
    """Insert or replace by the table's key; running it again changes nothing.

    Within the batch the greatest `version` wins; `unique` says that it holds each key once. The batch is appended to the
    log under its `name`; at `compact_at` deltas the log is merged into the table.
    """
    _, key, partition = TABLES[table]
    order = [*(version or []), partition]
    append(spark, root, table, batch if unique else latest_per_key(batch, [key], order), name)
    if len(_folders(spark, _log(root, table))) >= compact_at:
        compact(spark, root, table, days_fixed=days_fixed)


def compact(spark: SparkSession, root: str, table: str, *, days_fixed: bool = False) -> None:
    """Merge the log into the days concerned: those of its rows, and those where one of its keys is stored already.

    With `days_fixed` (the event time of an id never changes, and nothing is deleted) the search for the latter, which reads
    all keys, is left out.
    """
    _, key, partition = TABLES[table]
    recover(spark, root, table)
    names = _folders(spark, _log(root, table))
    if not names:
        return
    changed, base = _latest_deltas(spark, root, table, names).persist(), _read_base(spark, root, table)
    days = changed.select(partition)
    if not days_fixed:
        days = days.unionByName(base.select(key, partition).join(changed.select(key), key, "left_semi").select(partition))
    # one row per calendar day: bounded by the time span of the table
    wanted = [row[0] for row in days.distinct().collect() if row[0] is not None]
    touched = base.filter(F.col(partition).isin(wanted)) if wanted else base.limit(0)
    kept = touched.join(changed.select(key), key, "left_anti").select(base.columns)
    last = int(names[-1].partition("-")[0])
    _replace(spark, root, table, wanted, kept.unionByName(changed.filter("not _deleted").select(base.columns)), names, last)
    changed.unpersist()


def _drop_emptied(spark: SparkSession, root: str, table: str, wanted: list, written: DataFrame) -> None:
    """A day whose every row moved elsewhere has no replacement: remove its folder."""
    partition = TABLES[table][2]
    left = {row[0] for row in written.select(partition).distinct().collect()}
    for day in wanted:
        if day not in left:
            _drop(spark, f"{root}/{table}/{partition}={day}")


def load_scored(
    spark: SparkSession, root: str, scored: DataFrame, run_ts: str, *, retract_alerts: bool = False,
    days_fixed: bool = False, version: list[str] | None = None, name: str | None = None,
) -> int:
    """Staging, scores and alerts of one batch; returns the number of rows taken.

    A row scored again below HIGH keeps its earlier alert unless `retract_alerts`. Of rows with one id in the batch the
    one with the greatest `version` (arrival columns such as an offset) is stored; without it, that of the latest time.
    A batch loaded again under its `name` replaces what it appended.
    """
    # one row per id is found once and read by every table below; spills to disk
    latest = latest_per_key(scored, ["transaction_id"], version or ["event_time"], "_copies").persist()
    try:
        taken = latest.agg(F.sum("_copies")).first()[0] or 0
        _load(spark, root, latest.drop("_copies"), run_ts, retract_alerts, days_fixed, name)
        return taken
    finally:
        latest.unpersist()


def _load(spark: SparkSession, root: str, scored: DataFrame, run_ts: str, retract_alerts: bool, days_fixed: bool, name: str | None) -> None:
    upsert(spark, root, "stg_transactions", staging_rows(scored), days_fixed=days_fixed, unique=True, name=name)
    upsert(spark, root, "transaction_scores", score_rows(scored, run_ts), days_fixed=days_fixed, unique=True, name=name)
    alerts = alert_rows(scored, run_ts)
    if retract_alerts:  # a deletion per lowered row; those that had no alert delete nothing
        lowered = score_rows(scored, run_ts).filter(F.col("risk_level") != "HIGH")
        gone = lowered.select(F.concat(F.lit("alt_"), F.col("transaction_id")).alias("alert_id"), F.lit(True).alias("_deleted"))
        alerts = alerts.withColumn("_deleted", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    upsert(spark, root, "fraud_alerts", alerts, days_fixed=days_fixed and not retract_alerts, unique=True, name=name)


def write_daily_metrics(spark: SparkSession, root: str, rollup: DataFrame) -> None:
    """Insert or replace days of the metrics table."""
    _replace_days(_fit(rollup, "daily_fraud_metrics"), root, "daily_fraud_metrics")


def refresh_daily_metrics(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Roll up the given days of the score table (partition-pruned) into the metrics table."""
    scores = read_table(spark, root, "transaction_scores").filter(F.col("event_date").between(first, last))
    rollup = marts.daily_rollup(scores)
    write_daily_metrics(spark, root, rollup)
    return read_table(spark, root, "daily_fraud_metrics").filter(F.col("metric_date").between(first, last))
