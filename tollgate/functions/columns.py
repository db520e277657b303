"""Scalar building blocks, all evaluated inside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_dlat = F.radians(lat2 - lat1) / 2.0
    half_dlon = F.radians(lon2 - lon1) / 2.0
    a = F.pow(F.sin(half_dlat), F.lit(2.0)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), F.lit(2.0))
    )
    # rounding can push `a` a hair above 1 for antipodes
    angle = 2.0 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1.0 - a, F.lit(0.0))))
    return F.lit(EARTH_RADIUS_KM) * angle


def clip01(value: Column) -> Column:
    """Clamp to [0, 1]. Mentions its argument once: filters on it must stay small code."""
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def ratio_or(numerator: Column, denominator: Column, fallback: float) -> Column:
    """numerator / denominator, or the fallback unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(fallback))


def rounded(value: Column, digits: int) -> Column:
    """Round to the nearest decimal of the exact binary value, ties to even.

    `round` goes by the shortest decimal text instead and lands one unit higher on values
    such as 2.675; `format_number` decides on the exact value, except for half a unit in
    the last place itself. Adding zero turns -0.0 to 0.0.
    """
    text = F.call_function("format_number", value, F.lit("0." + "0" * digits))
    half = 0.5 / 10**digits
    return (
        F.when(F.abs(value) == half, F.signum(value) * round(half, digits)).otherwise(text.try_cast("double"))
        + F.lit(0.0)
    )


def compact(*candidates: Column) -> Column:
    """Array of the candidates that are not null, in the given order."""
    return F.filter(F.array(*candidates), lambda item: item.isNotNull())


def fill(text: str, values: dict[str, Column]) -> Column:
    """Text with the columns named in braces put in."""
    parts = re.split(r"\{(\w+)\}", text)
    return F.concat(*[values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if i % 2 or part])


def utc_text(ts: Column) -> Column:
    """ISO-like text with microseconds (session time zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
