"""The fourteen behavioural features, leakage-free, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, FEATURE_NAMES, Config
from tollgate.functions import haversine_km, ratio_or, rounded
from tollgate.operators.timeline import Opening, count_rows, prior_profile

# below this spread a user's amounts count as constant
FLAT_STD = 1e-5


def hour_of_day() -> Column:
    return F.hour("event_time").cast("double")


def day_of_week() -> Column:
    """Monday is 0."""
    return F.weekday("event_time").cast("double")


def distance_from_last() -> Column:
    km = haversine_km(
        F.col("_last.latitude"), F.col("_last.longitude"), F.col("latitude"), F.col("longitude")
    )
    return F.coalesce(rounded(km, 2), F.lit(0.0))


def _mean_or_own(span: int) -> Column:
    count = F.col(f"_cnt_{span}")
    mean = F.col(f"_sum_{span}").cast("double") / count
    return F.when(count > 0, mean).otherwise(F.col("amount"))


def add_features(
    tx: DataFrame, cfg: Config = DEFAULT, *, arrival: str = "transaction_id", split_hot_users: bool = True,
    opening: Opening | None = None,
) -> DataFrame:
    """`tx` (unique ids) plus the feature columns; `amount` is itself the first feature.

    With an `opening`, `tx` needs the rows since its moment and those of the hour before it, which come back as well.
    """
    hot, rows = count_rows(tx, cfg) if split_hot_users else (None, None)
    known = prior_profile(
        tx,
        hot=hot,
        rows=rows,
        count_spans=(60, 300, 3600),
        sum_spans=(300, 3600),
        distinct_span=3600,
        novelty=("device_id", "city"),
        moments=True,
        last=True,
        arrival=arrival,
        opening=opening,
    )
    mean_1h = _mean_or_own(3600)
    zscore = F.when(F.col("_std") > FLAT_STD, (F.col("amount") - F.col("_mean")) / F.col("_std"))
    return known.select(
        *tx.columns,
        F.coalesce(rounded(zscore, 4), F.lit(0.0)).alias("amount_zscore"),
        F.col("_cnt_60").cast("double").alias("tx_count_1m"),
        F.col("_cnt_300").cast("double").alias("tx_count_5m"),
        F.col("_cnt_3600").cast("double").alias("tx_count_1h"),
        rounded(F.col("_sum_300").cast("double"), 2).alias("amount_sum_5m"),
        rounded(mean_1h, 2).alias("avg_amount_1h"),
        # the divisor is the unrounded mean
        rounded(ratio_or(F.col("amount"), mean_1h, 1.0), 4).alias("amount_vs_user_avg"),
        F.col("_distinct").cast("double").alias("unique_merchants_1h"),
        F.col("_new_device_id").alias("new_device"),
        F.col("_new_city").alias("new_location"),
        distance_from_last().alias("distance_from_last_tx"),
        hour_of_day().alias("hour_of_day"),
        day_of_week().alias("day_of_week"),
    )


def feature_vector() -> Column:
    """The features as one ordered array, the model's input."""
    return F.array(*[F.col(name) for name in FEATURE_NAMES])


def bounded_window_features(tx: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Six window features whose history also ends at the watermark.

    In event-time order the newest time seen is the row's own, so a window reaches back
    by the smaller of its length and the watermark delay.
    """
    reach = cfg.watermark_minutes * 60
    one, five, hour = (min(span, reach) for span in (60, 300, 3600))
    hot, rows = count_rows(tx, cfg)
    known = prior_profile(
        tx,
        hot=hot,
        rows=rows,
        count_spans=sorted({one, five, hour}),
        sum_spans=sorted({five, hour}),
        distinct_span=hour,
    )
    return known.select(
        *tx.columns,
        F.col(f"_cnt_{one}").cast("double").alias("tx_count_1m"),
        F.col(f"_cnt_{five}").cast("double").alias("tx_count_5m"),
        F.col(f"_cnt_{hour}").cast("double").alias("tx_count_1h"),
        rounded(F.col(f"_sum_{five}").cast("double"), 2).alias("amount_sum_5m"),
        rounded(_mean_or_own(hour), 2).alias("avg_amount_1h"),
        F.col("_distinct").cast("double").alias("unique_merchants_1h"),
    )
