"""Column expressions; no UDFs."""

from tollgate.functions.columns import (
    clip01,
    compact,
    fill,
    haversine_km,
    ratio_or,
    rounded,
    utc_text,
)

__all__ = ["clip01", "compact", "fill", "haversine_km", "ratio_or", "rounded", "utc_text"]
