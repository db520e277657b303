"""Deterministic rules: a score and the sentences that justify it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.config import HIGH_RISK_CATEGORIES
from tollgate.functions import compact, fill

# One sentence per rule; names in braces are filled in.
SENTENCES = {
    "velocity": "High transaction velocity detected ({count} transactions in 5 minutes)",
    "amount": "Transaction amount ₹{amount} is significantly above historical user baseline ({ratio}x average)",
    "device": "Transaction originated from an unrecognized new device",
    "distance": "Impossible travel speed / large location shift detected ({km} km from prior transaction)",
    "merchant": "Transaction at high-risk merchant category '{category}'",
}


def feature(name: str, default: float) -> Column:
    """A feature column; an absent value takes the neutral default."""
    return F.coalesce(F.col(name), F.lit(default))


def _parts() -> dict[str, Column]:
    return {
        "count": feature("tx_count_5m", 0.0),
        "ratio": feature("amount_vs_user_avg", 1.0),
        "amount": feature("amount", 0.0),
        "device": feature("new_device", 0.0),
        "km": feature("distance_from_last_tx", 0.0),
        "category": F.lower(F.coalesce(F.col("merchant_category"), F.lit(""))),
    }


def _tests() -> dict[str, Column]:
    """The conditions under which a rule also states a reason."""
    p = _parts()
    return {
        "velocity": p["count"] >= 5.0,
        "amount": (p["ratio"] >= 5.0) | (p["amount"] >= 80000.0),
        "device": p["device"] == 1.0,
        "distance": p["km"] >= 500.0,
        "merchant": p["category"].isin(*HIGH_RISK_CATEGORIES),
    }


def rule_score() -> Column:
    """Highest score of the rules that fire, 0 if none does."""
    p, fires = _parts(), _tests()
    arms = [
        F.when(fires["velocity"], 1.0).when(p["count"] >= 3.0, 0.5),
        F.when(fires["amount"], 1.0).when((p["ratio"] >= 3.0) | (p["amount"] >= 40000.0), 0.6),
        F.when(fires["device"], 0.7),
        F.when(fires["distance"], 1.0).when(p["km"] >= 150.0, 0.5),
        F.when(fires["merchant"], 0.6),
    ]
    return F.greatest(F.lit(0.0), *arms)  # greatest skips nulls


def rule_reasons() -> Column:
    """Sentences of the fully triggered rules, in rule order."""
    p, fires = _parts(), _tests()
    shown = {
        "count": p["count"].cast("bigint").cast("string"),
        "amount": F.format_number(p["amount"], 2),
        "ratio": F.expr("format_number(coalesce(amount_vs_user_avg, 1.0D), '0.0')"),
        "km": F.expr("format_number(coalesce(distance_from_last_tx, 0.0D), '0.0')"),
        "category": F.col("merchant_category"),
    }
    return compact(*[F.when(fires[rule], fill(text, shown)) for rule, text in SENTENCES.items()])
