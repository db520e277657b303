"""Message-shaped views of the transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import utc_text
from tollgate.schemas import TXN_COLUMNS


def strip_labels(labelled_events: DataFrame) -> DataFrame:
    """Only the contract columns may go online: an allow-list, not a drop-list."""
    return labelled_events.select(*TXN_COLUMNS)


def to_messages(events: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, value) rows for a keyed topic."""
    time = utc_text(F.col("event_time"))
    fields = [time.alias(c) if c == "event_time" else F.col(c) for c in events.columns]
    return events.select(F.col(key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))
