"""Drift between a reference period and a current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import rounded

# Right-open borders of the amount bands.
AMOUNT_BORDERS = (1_000.0, 5_000.0, 10_000.0, 20_000.0, 40_000.0, 80_000.0)


def _band(amount: Column) -> Column:
    return F.size(F.filter(F.array(*[F.lit(b) for b in AMOUNT_BORDERS]), lambda b: b <= amount))


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(28,8)")


def drift_report(scored: DataFrame, is_reference: Column) -> DataFrame:
    """(metric, reference, current, shift) in one pass over `scored`.

    The amount shape is compared by the population stability index over fixed bands, with
    half a row added to empty ones.
    """
    side = scored.select(
        is_reference.alias("_ref"), "amount", "risk_score", "risk_level", "tx_count_5m", "new_device",
        _band(F.col("amount")).alias("_band"),
    )
    bands = len(AMOUNT_BORDERS) + 1
    aggs = []
    for name, on in (("ref", F.col("_ref")), ("cur", ~F.col("_ref"))):
        n = F.count_if(on).cast("double")
        aggs.append(n.alias(f"rows_{name}"))
        for column in ("amount", "risk_score", "tx_count_5m", "new_device"):
            aggs.append(F.try_divide(F.sum(F.when(on, _exact(column))).cast("double"), n).alias(f"{column}_{name}"))
        aggs.append(F.try_divide(F.count_if(on & (F.col("risk_level") == "HIGH")).cast("double"), n).alias(f"alerts_{name}"))
        aggs += [F.count_if(on & (F.col("_band") == b)).cast("double").alias(f"band{b}_{name}") for b in range(bands)]
    one = side.agg(*aggs)

    def share(b: int, name: str) -> Column:
        return F.greatest(F.col(f"band{b}_{name}"), F.lit(0.5)) / F.greatest(F.col(f"rows_{name}"), F.lit(1.0))

    psi = sum(((share(b, "cur") - share(b, "ref")) * F.ln(share(b, "cur") / share(b, "ref")) for b in range(bands)), F.lit(0.0))
    means = {
        "volume": "rows", "mean_amount": "amount", "mean_risk_score": "risk_score",
        "mean_tx_count_5m": "tx_count_5m", "new_device_rate": "new_device", "alert_rate": "alerts",
    }
    lines = [
        F.struct(
            F.lit(metric).alias("metric"), rounded(F.col(f"{c}_ref"), 4).alias("reference"),
            rounded(F.col(f"{c}_cur"), 4).alias("current"),
            rounded(F.try_divide(F.col(f"{c}_cur"), F.col(f"{c}_ref")) - 1.0, 4).alias("shift"),
        )
        for metric, c in means.items()
    ]
    lines.append(
        F.struct(
            F.lit("amount_psi").alias("metric"), F.lit(0.0).alias("reference"), F.lit(0.0).alias("current"),
            rounded(psi, 4).alias("shift"),
        )
    )
    return one.select(F.inline(F.array(*lines)))
