"""Opening balances: what is known of each user before a day, from small mergeable summaries per user and day.

A day's summary holds the count, mean and spread (sum of squared deviations) of a user's amounts and the
latest event; a second table the first sight of each value of the novelty columns. Days merge by pairwise formulas
that add only non-negative terms. Summaries of a day don't depend on other days, so a day that gets late rows is
summarised again and replaced, and any moment's opening is a merge of the days before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.operators.timeline import Opening, micros, position

NOVELTY = ("device_id", "city")


def user_days(tx: DataFrame, arrival: str = "transaction_id") -> DataFrame:
    """(user_id, day, n, mean, m2, last); copies of a user's rows are reduced before the shuffle."""
    place = position(micros(), F.col(arrival), F.col("latitude"), F.col("longitude"))
    amount = F.col("amount")
    return tx.groupBy("user_id", F.to_date("event_time").alias("day")).agg(
        F.count("*").alias("n"), F.avg(amount).alias("mean"), (F.var_pop(amount) * F.count(amount)).alias("m2"),
        F.min(place).alias("last"),
    )


def sight_days(tx: DataFrame, columns: tuple[str, ...] = NOVELTY) -> DataFrame:
    """(user_id, day, kind, value, first_us): a row per value and day, however many values a user has."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns]))
    sights = tx.select("user_id", F.to_date("event_time").alias("day"), micros().alias("_us"), pairs)
    return sights.groupBy("user_id", "day", "kind", "value").agg(F.min("_us").alias("first_us"))


def _merge(days: Column) -> Column:
    """(n, mean, m2) of an array of (day, n, mean, m2)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(past: Column, day: Column) -> Column:
        n, apart = past["n"] + day["n"], day["mean"] - past["mean"]
        return F.struct(
            n.alias("n"), (past["mean"] + apart * day["n"] / n).alias("mean"),
            (past["m2"] + day["m2"] + apart * apart * past["n"] * day["n"] / n).alias("m2"),
        )

    return F.aggregate(F.array_sort(days), start, add)


def opening(users: DataFrame, sights: DataFrame, day: str) -> Opening:
    """What the summaries of all days before `day` (yyyy-MM-dd, UTC) know.

    A user's days are merged in one array: one entry per calendar day with events.
    """
    first = F.lit(day).cast("date")
    merged = users.filter(F.col("day") < first).groupBy("user_id").agg(
        _merge(F.collect_list(F.struct("day", "n", "mean", "m2"))).alias("past"), F.min("last").alias("last")
    )
    seen = sights.filter(F.col("day") < first).groupBy("user_id", "kind", "value").agg(F.min("first_us").alias("first_us"))
    since = users.sparkSession.range(1).select(F.unix_micros(first.cast("timestamp"))).first()[0]
    return Opening(since, merged.select("user_id", "past.*", "last"), seen)
