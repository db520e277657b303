"""Streaming sources and sinks behind one function each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # a count of all rows costs a look-up for each row written
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # a batch uploads its changes, not the files of the state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams: state outside the heap, one state partition per core.

    The number of state partitions is fixed when a stream first starts, and AQE does not
    change it later.
    """
    from tollgate.session import configure

    session = configure(spark.newSession())
    for key, value in STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def source(spark: SparkSession, fmt: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """Any streaming source, e.g. `source(spark, "parquet", schema, path=..., maxFilesPerTrigger="1")`."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def kafka_source(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None) -> DataFrame:
    """A topic from its beginning; the position is kept in the query's checkpoint."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return source(spark, "kafka", **options)


def sink(
    df: DataFrame, fmt: str, checkpoint: str, *, mode: str = "append", every: str | None = "1 second", **options: str
) -> DataStreamWriter:
    """A configured writer; `every=None` drains what is available and stops."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = "1 second") -> DataStreamWriter:
    """Write (key, value) rows to a topic."""
    return sink(messages, "kafka", checkpoint, every=every, **{"kafka.bootstrap.servers": servers, "topic": topic})
