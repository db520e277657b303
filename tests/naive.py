"""The feature definitions as a plain loop, for comparison on small inputs."""

from __future__ import annotations

import math
from datetime import timedelta


def km(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(
        math.radians(lat2)
    ) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0)))


def features(target: dict, events: list[dict]) -> dict:
    """`events` in arrival order; only those of the same user before the target count."""
    past = [e for e in events if e["user_id"] == target["user_id"] and e["event_time"] < target["event_time"]]
    amounts = [e["amount"] for e in past]
    mean = sum(amounts) / len(amounts) if amounts else 0.0
    std = math.sqrt(sum((a - mean) ** 2 for a in amounts) / len(amounts)) if amounts else 0.0

    def within(seconds):
        return [e for e in past if e["event_time"] >= target["event_time"] - timedelta(seconds=seconds)]

    hour = within(3600)
    mean_1h = math.fsum(e["amount"] for e in hour) / len(hour) if hour else target["amount"]
    latest = max(past, key=lambda e: e["event_time"]) if past else None
    return {
        "amount": target["amount"],
        "amount_zscore": round((target["amount"] - mean) / std, 4) if std > 1e-5 else 0.0,
        "tx_count_1m": float(len(within(60))),
        "tx_count_5m": float(len(within(300))),
        "tx_count_1h": float(len(hour)),
        "amount_sum_5m": round(math.fsum(e["amount"] for e in within(300)), 2),
        "avg_amount_1h": round(mean_1h, 2),
        "amount_vs_user_avg": round(target["amount"] / mean_1h, 4) if mean_1h > 0 else 1.0,
        "unique_merchants_1h": float(len({e["merchant_id"] for e in hour})),
        "new_device": float(bool(past) and target["device_id"] not in {e["device_id"] for e in past}),
        "new_location": float(bool(past) and target["city"] not in {e["city"] for e in past}),
        "distance_from_last_tx": round(
            km(latest["latitude"], latest["longitude"], target["latitude"], target["longitude"]), 2
        ) if latest else 0.0,
        "hour_of_day": float(target["event_time"].hour),
        "day_of_week": float(target["event_time"].weekday()),
    }
