"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dynamic: a daily write replaces only the days it contains
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # JSON with a repeated field: the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: A feature task sorts its partition several times at once, some 20 bytes of memory for each that was shuffled. A task that
#: reads files holds what it deals to more than 200 partitions, some 40 bytes for each of the file.
TASK_BYTES = 16 << 20
_SIZES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * ("kmgtp".index(unit) + 1 if unit else 0)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session someone else created; partitions it wants smaller stay smaller."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key in _SIZES:
        if _bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")
    return spark


def local_session(cpus: str | None = None, shuffle_partitions: int = 8, app: str = "tollgate") -> SparkSession:
    """A local session for tests and the bench."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for written intermediates: the cluster's checkpoint folder.

    A local fallback is only accepted when the session runs in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if fallback is None or not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return fallback
