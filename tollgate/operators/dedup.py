"""One row per key, the last write winning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], version: list[str], copies: str | None = None) -> DataFrame:
    """Keep, per key, the row with the greatest version; `copies` names a further column with the number of its rows.

    An aggregation, not a ranking window: copies of one key are reduced before the
    shuffle, so a key that holds a third of the table is no hot partition.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    chosen = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    counted = [F.count("*").alias(copies)] if copies else []
    return df.groupBy(*keys).agg(chosen, *counted).select(*[c if c in keys else f"_row.{c}" for c in columns], *([copies] if copies else []))
