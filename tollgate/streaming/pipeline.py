"""From raw messages to warehouse tables, continuously."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollgate.config import DEFAULT, Config
from tollgate.functions import rounded
from tollgate.operators import iforest, scoring, validate
from tollgate.operators.timeline import Opening
from tollgate.plans import warehouse
from tollgate.streaming import counters
from tollgate.streaming.features import stream_features


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _trigger(writer, every: str | None):
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def start_dead_letters(raw: DataFrame, root: str, checkpoint: str, every: str | None = "1 second") -> StreamingQuery:
    """Write failed payloads, one folder per micro-batch: a repeated batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        failed = validate.dead_letters(validate.check_events(batch))
        failed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{root}/dead_letters/batch_id={batch_id}"
        )

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def scored_stream(raw: DataFrame, cfg: Config = DEFAULT, opening: Opening | None = None, recent: DataFrame | None = None) -> DataFrame:
    """Validated, deduplicated, featurised events of a raw message stream.

    Nothing before the keyed state may drop rows below the watermark: late rows have to reach it to be marked.
    """
    checked = counters.observed(validate.check_events(raw))
    return stream_features(validate.valid_events(checked), cfg, opening=opening, recent=recent)


def start_scoring(
    raw: DataFrame, root: str, checkpoint: str, *, run_ts: str | None = None, ml_score: Column | None = None,
    model_version: str = scoring.RULES_ONLY_VERSION, forest: iforest.Forest | None = None,
    every: str | None = "1 second", cfg: Config = DEFAULT, opening: Opening | None = None, recent: DataFrame | None = None,
) -> StreamingQuery:
    """Score the stream and upsert staging, scores and alerts.

    With an `opening` and the `recent` events of the hour before it (stored staging rows will do), users are known from
    the start, as the batch that loaded the warehouse left them.

    Rows are stamped with `run_ts`, by default with the time of their micro-batch. The model score comes from `forest`, or from any column over the feature rows.

    Counters of every batch are stored beside the tables (`counters`). Progress is kept in the checkpoint and advances only after a batch is loaded; a batch is appended under its
    number and merged by key, so one that is repeated after a failure changes nothing. Late rows go to their own folder.
    """

    if forest is not None:  # broadcast once, for all batches
        value = iforest.score_samples(forest.nodes, forest.nodes, forest.sample_size)
        ml_score = rounded(iforest.normalize(value - F.lit(forest.offset)), 4)
        model_version = forest.version

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():  # as the closing batch of a drained stream is
                store(batch, batch_id)
        finally:
            batch.unpersist()

    def store(batch: DataFrame, batch_id: int) -> None:
        # the session of the batch carries the stream's settings
        spark: SparkSession = batch.sparkSession
        stamp = run_ts or utc_now()
        late = batch.filter("is_late")
        late.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{root}/late_events/batch_id={batch_id}"
        )
        scored = scoring.score(
            batch.filter(~F.col("is_late")).drop("is_late"), cfg, ml_score=ml_score, model_version=model_version
        )
        warehouse.load_scored(spark, root, scored, stamp, days_fixed=True, name=f"stream{batch_id}")
        counters.store_predictions(spark, root, batch_id, scored)

    name = f"scoring-{uuid.uuid4().hex}"
    raw.sparkSession.streams.addListener(counters.CounterListener(raw.sparkSession, root, name))
    writer = scored_stream(raw, cfg, opening, recent).writeStream.queryName(name).foreachBatch(load).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()
