"""All tunable values in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# The categories the merchant rule treats as high risk.
HIGH_RISK_CATEGORIES = (
    "electronics",
    "jewelry",
    "crypto_exchange",
    "luxury_goods",
    "wire_transfer",
)

# Order of the model's input columns.
FEATURE_NAMES = (
    "amount",
    "amount_zscore",
    "tx_count_1m",
    "tx_count_5m",
    "tx_count_1h",
    "amount_sum_5m",
    "avg_amount_1h",
    "amount_vs_user_avg",
    "unique_merchants_1h",
    "new_device",
    "new_location",
    "distance_from_last_tx",
    "hour_of_day",
    "day_of_week",
)


@dataclass(frozen=True)
class Config:
    # hybrid score
    w_rules: float = 0.35
    w_ml: float = 0.35
    w_velocity: float = 0.15
    w_behavior: float = 0.15
    high_threshold: float = 0.70
    medium_threshold: float = 0.40
    # explanations; the severe cut-off is independent of a model's tuned threshold
    ml_severe: float = 0.65
    ml_elevated: float = 0.50
    # streams
    watermark_minutes: int = 10
    # model
    n_trees: int = 200
    sample_size: int = 256
    contamination: float = 0.05
    seed: int = 42
    min_f1: float = 0.50
    f1_tolerance: float = 0.05
    # A user with more rows than this is processed in time chunks of about
    # `chunk_rows` rows, so that no single task receives a whole hot user.
    hot_user_rows: int = 2_000_000
    chunk_rows: int = 1_000_000
    # The hot-user table holds at most rows / hot_user_rows users; it is
    # broadcast only up to this many.
    broadcast_users: int = 100_000


DEFAULT = Config()
