"""Named queries that run a Structured Streaming job to its end and read its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.config import FEATURE_NAMES
from tollgate.functions import rounded, utc_text
from tollgate.operators import validate
from tollgate.operators.timeline import DAY
from tollgate.plans import jobs, warehouse
from tollgate.plans.catalog import QUERIES, register
from tollgate.plans.catalog_data import RUN_TS, scratch
from tollgate.schemas import TXN_COLUMNS
from tollgate.plans import spoiled
from tollgate.sources.streams import sink, source, stream_session
from tollgate.sources.tables import table, transactions, transactions_from_events
from tollgate.streaming import counters, features, pipeline, windows


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of transactions."""
    schema = table(spark, sf, "events").schema
    return transactions_from_events(source(spark, "parquet", schema, path=sf, pathGlobFilter="events.parquet"))


def drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream over everything available into Parquet and read the result."""
    root = scratch(spark)
    sink(stream, "parquet", f"{root}/checkpoint", every=None, path=f"{root}/out").start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def _sliding(label: str, duration: str, slide: str, closed_only: bool = True):
    """Sliding windows: those a stream has closed, or all of a table (what a final flush would add)."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        session = stream_session(spark)
        events = event_stream(session, sf) if closed_only else transactions(session, sf)
        out = windows.sliding_aggregates(events, duration, slide, label=label, exact_merchants=True)
        out = drain(session, out) if closed_only else out
        return out.select(
            "user_id", utc_text(F.col("window.start")).alias("window_start"),
            utc_text(F.col("window.end")).alias("window_end"), f"tx_count_{label}", f"max_amount_{label}",
            f"unique_merchants_{label}",
            *[rounded(F.col(c), 2).alias(c) for c in (f"amount_sum_{label}", f"avg_amount_{label}")],
        )

    return query


QUERIES["stream_sliding_5m"] = _sliding("5m", "5 minutes", "1 minute")
QUERIES["stream_sliding_1m"] = _sliding("1m", "1 minute", "10 seconds")
QUERIES["stream_sliding_1h"] = _sliding("1h", "1 hour", "5 minutes")
QUERIES["sliding_5m_all"] = _sliding("5m", "5 minutes", "1 minute", closed_only=False)
QUERIES["sliding_1m_all"] = _sliding("1m", "1 minute", "10 seconds", closed_only=False)
QUERIES["sliding_1h_all"] = _sliding("1h", "1 hour", "5 minutes", closed_only=False)


@register("stream_sliding_5m_approx")
def _approx(spark: SparkSession, sf: str) -> DataFrame:
    session = stream_session(spark)
    out = drain(session, windows.sliding_aggregates(event_stream(session, sf)))
    return out.select("user_id", utc_text(F.col("window.start")).alias("window_start"), "tx_count_5m", "unique_merchants_5m")


@register("stream_dedup")
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth message is delivered three times."""
    session = stream_session(spark)
    copies = F.when(F.col("event_id") % 4 == 0, F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1)))
    repeated = event_stream(session, sf).withColumn("copy", F.explode(copies))
    return drain(session, windows.dedup(repeated).select("transaction_id", "user_id", "amount"))


def _bounds(tx: DataFrame) -> tuple[int, int]:
    """First and last time, in microseconds; 0 and 0 of no rows."""
    first, last = tx.agg(F.min(F.unix_micros("event_time")), F.max(F.unix_micros("event_time"))).first()
    return first or 0, last or 0


def in_slices(session: SparkSession, tx: DataFrame, slices: int, stream_of) -> DataFrame:
    """The stream over slices that arrive in order of event time; each arrival is a run that resumes the last."""
    root, (first, last) = scratch(session), _bounds(tx)
    raw = source(session, "parquet", tx.schema, path=f"{root}/in/*")
    stream = stream_of(raw)
    for number in range(slices):
        tx.filter(F.floor((F.unix_micros("event_time") - first) * slices / (last + 1 - first)) == number).write.parquet(f"{root}/in/slice-{number}")
        sink(stream, "parquet", f"{root}/checkpoint", every=None, path=f"{root}/out").start().awaitTermination()
    return session.read.schema(stream.schema).parquet(f"{root}/out")


@register("stream_features")
def _features(spark: SparkSession, sf: str) -> DataFrame:
    """All events in four arrivals."""
    session = stream_session(spark)
    out = in_slices(session, transactions(session, sf), 4, lambda raw: features.stream_features(raw, arrival="event_id"))
    return out.filter(~F.col("is_late")).select("transaction_id", *FEATURE_NAMES)


@register("stream_features_seeded")
def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    """The first half of the days as batch history, stored as balances; the second half as a stream that starts from them."""
    session = stream_session(spark)
    tx = transactions(session, sf)
    day = sum(_bounds(tx)) // 2 // DAY * DAY
    past, coming = tx.filter(F.unix_micros("event_time") < day), tx.filter(F.unix_micros("event_time") >= day)
    root = scratch(session)
    jobs.update_balances(session, root, past)
    opened = jobs.opening(session, root, session.range(1).select(F.date_format(F.timestamp_micros(F.lit(day)), "yyyy-MM-dd")).first()[0])
    out = in_slices(session, coming, 4, lambda raw: features.stream_features(raw, arrival="event_id", opening=opened, recent=past))
    return out.filter(~F.col("is_late")).select("transaction_id", *FEATURE_NAMES)


@register("stream_to_warehouse")
def _to_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """Spoiled JSON messages through validation, dedup, features and scoring into the warehouse."""
    session = stream_session(spark)
    root = scratch(session)
    raw = spoiled.payloads(event_stream(session, sf))
    query = pipeline.start_scoring(raw, root, f"{root}/checkpoint", run_ts=RUN_TS, every=None)
    query.awaitTermination()
    scores = warehouse.read_table(session, root, "transaction_scores")
    return scores.select(
        "transaction_id", "user_id", "risk_level", "model_version",
        *[F.col(c).cast("double").alias(c) for c in ("risk_score", "rule_score")],
    )


@register("stream_counters")
def _counters(spark: SparkSession, sf: str) -> DataFrame:
    """Messages consumed and failed, and predictions per level, of a stream that is stopped and started again twice."""
    session = stream_session(spark)
    root, messages_of = scratch(session), spoiled.payloads(transactions(session, sf))
    checked = validate.check_events(messages_of)
    first, last = _bounds(checked)
    # in order of the times the messages tell; those that tell none come first
    part = F.coalesce(F.floor((F.unix_micros("event_time") - first) * 3 / (last + 1 - first)), F.lit(0))
    raw = source(session, "parquet", messages_of.schema, path=f"{root}/in/*")
    for number in range(3):
        checked.filter(part == number).select(messages_of.columns).write.parquet(f"{root}/in/slice-{number}")
        query = pipeline.start_scoring(raw, root, f"{root}/checkpoint", run_ts=RUN_TS, every=None)
        query.awaitTermination()
        counters.record(session, root, query)  # the listener may still be on its way
    return counters.read(session, root)


@register("stream_dead_letters")
def _dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    session = stream_session(spark)
    root = scratch(session)
    raw = spoiled.payloads(event_stream(session, sf))
    pipeline.start_dead_letters(raw, root, f"{root}/checkpoint", every=None).awaitTermination()
    return session.read.parquet(f"{root}/dead_letters").select("raw_payload", "error_message", "error_type", "source_topic")


@register("late_events")
def _late(spark: SparkSession, sf: str) -> DataFrame:
    late = windows.late_events(transactions(spark, sf).select(*TXN_COLUMNS, "event_id"), "event_id", block_rows=1000)
    return late.select("transaction_id", "user_id", rounded(F.col("seconds_late"), 4).alias("seconds_late"))


@register("stream_late_events")
def _late_in_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Where each message of four arrival slices ends: scored, late or dead. Every slice is a run that resumes the last."""
    session = stream_session(spark)
    root = scratch(session)
    messages_of = spoiled.payloads(transactions(session, sf))
    last = messages_of.agg(F.max("offset")).first()[0] or 0
    raw = source(session, "parquet", messages_of.schema, path=f"{root}/in/*")
    for number in range(4):
        arrived = messages_of.filter(F.floor(F.col("offset") * 4 / (last + 1)) == number)
        arrived.write.parquet(f"{root}/in/slice-{number}")
        pipeline.start_scoring(raw, root, f"{root}/checkpoint", every=None).awaitTermination()
    pipeline.start_dead_letters(raw, root, f"{root}/checkpoint-dead", every=None).awaitTermination()
    scores = warehouse.read_table(session, root, "transaction_scores")
    late = session.read.schema("transaction_id string").parquet(f"{root}/late_events")
    dead = session.read.schema("offset long").parquet(f"{root}/dead_letters")
    number_of = F.substring_index("transaction_id", "_", -1).cast("long").alias("event_id")
    return (
        scores.select(number_of, F.lit("scored").alias("outcome"))
        .unionByName(late.select(number_of, F.lit("late").alias("outcome")))
        .unionByName(dead.select(F.col("offset").alias("event_id"), F.lit("dead").alias("outcome")))
    )
