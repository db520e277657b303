"""Evaluation of anomaly scores against labels.

Everything starts from counts per distinct score, so a score shared by a third of the
rows is one row after the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions import rounded

# The threshold grid.
SWEEP_FROM, SWEEP_TO, SWEEP_STEPS = 0.35, 0.85, 50
_BINS = 65_536


def _int(flag: Column) -> Column:
    return F.sum(flag.cast("bigint"))


def score_histogram(pairs: DataFrame) -> DataFrame:
    """(score, label) to (score, pos, neg)."""
    return pairs.groupBy("score").agg(
        F.count_if(F.col("label")).alias("pos"), F.count_if(~F.col("label")).alias("neg")
    )


def confusion(pairs: DataFrame, threshold: float, keys: tuple[str, ...] = ()) -> DataFrame:
    hit, label = F.col("score") >= threshold, F.col("label")
    return pairs.groupBy(*keys).agg(
        F.count_if(~hit & ~label).alias("true_negatives"),
        F.count_if(hit & ~label).alias("false_positives"),
        F.count_if(~hit & label).alias("false_negatives"),
        F.count_if(hit & label).alias("true_positives"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and false-positive rate, 0 on an empty denominator."""
    tp, fp, fn, tn = (
        F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")
    )
    return counts.select(
        "*",
        rounded(_share(tp, tp + fp), 4).alias("precision"),
        rounded(_share(tp, tp + fn), 4).alias("recall"),
        rounded(_share(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"),
        rounded(_share(fp, fp + tn), 4).alias("false_positive_rate"),
        (tp + fp + fn + tn).alias("total_samples"),
        (tp + fn).alias("positive_count"),
    )


def roc_auc(pairs: DataFrame) -> DataFrame:
    """Area under the ROC curve from ranks; 0.5 when one class is absent.

    The running count of negatives is taken inside score bins, each of which opens with
    the count of all lower bins: no window spans the whole histogram.
    """
    hist = score_histogram(pairs).withColumn(
        "bin", F.least(F.floor(F.col("score") * _BINS), F.lit(_BINS)).cast("bigint")
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    opening = hist.groupBy("bin").agg(F.sum("neg").alias("bin_neg")).select(
        "bin",
        F.lit(-1.0).alias("score"),  # sorts before every score of its bin
        F.lit(0).cast("bigint").alias("pos"),
        F.coalesce(F.sum("bin_neg").over(below), F.lit(0)).alias("neg"),
        F.lit(True).alias("opening"),
    )
    lines = hist.withColumn("opening", F.lit(False)).unionByName(opening)
    inside = Window.partitionBy("bin").orderBy(F.desc("opening"), "score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = lines.withColumn("lower", F.coalesce(F.sum("neg").over(inside), F.lit(0))).filter(~F.col("opening"))
    sums = ranked.agg(
        F.sum(F.col("pos").cast("double") * (F.col("lower") + F.col("neg") / 2.0)).alias("wins"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    )
    area = F.coalesce(F.try_divide(F.col("wins"), F.col("p") * F.col("n")), F.lit(0.5))
    return sums.select(rounded(area, 4).alias("roc_auc"))


def sweep_threshold(index: Column) -> Column:
    return F.lit(SWEEP_FROM) + index.cast("double") * ((SWEEP_TO - SWEEP_FROM) / (SWEEP_STEPS - 1))


def threshold_sweep(pairs: DataFrame) -> DataFrame:
    """Rates at every grid threshold, from one pass over the pairs.

    Each row is reduced to the highest grid index it passes (51 groups); the counts at a
    threshold are then suffix sums over at most 51 rows.
    """
    step = (SWEEP_TO - SWEEP_FROM) / (SWEEP_STEPS - 1)
    guess = F.least(
        F.greatest(F.floor((F.col("score") - SWEEP_FROM) / step), F.lit(-1)), F.lit(SWEEP_STEPS - 1)
    ).cast("int")
    # the division may be off by one at a grid point: decide with the real thresholds
    exact = (
        F.when((guess < SWEEP_STEPS - 1) & (F.col("score") >= sweep_threshold(guess + 1)), guess + 1)
        .when((guess >= 0) & (F.col("score") < sweep_threshold(guess)), guess - 1)
        .otherwise(guess)
    )
    passed = pairs.groupBy(exact.alias("i")).agg(
        F.count_if(F.col("label")).alias("pos"), F.count_if(~F.col("label")).alias("neg")
    )
    every = pairs.sparkSession.range(-1, SWEEP_STEPS).select(F.col("id").cast("int").alias("i"))
    filled = every.join(passed, "i", "left").select(
        "i", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")
    )
    up = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    counts = filled.select(
        "i",
        F.sum("pos").over(up).alias("true_positives"), F.sum("neg").over(up).alias("false_positives"),
        F.coalesce(F.sum("pos").over(down), F.lit(0)).alias("false_negatives"),
        F.coalesce(F.sum("neg").over(down), F.lit(0)).alias("true_negatives"),
    ).filter(F.col("i") >= 0)
    return with_rates(counts).withColumn("threshold", sweep_threshold(F.col("i"))).drop("i")


def best_threshold(pairs: DataFrame) -> DataFrame:
    """The sweep row with the highest rounded F1; the lowest threshold wins ties."""
    swept = threshold_sweep(pairs)
    best = F.max_by(F.struct(*swept.columns), F.struct("f1_score", -F.col("threshold"))).alias("b")
    return swept.agg(best).select("b.*")


def evaluate(pairs: DataFrame, threshold: float = 0.55) -> DataFrame:
    """One row with threshold, rates, ROC-AUC and the confusion matrix."""
    rates = with_rates(confusion(pairs, threshold)).withColumn("threshold", F.lit(threshold))
    # two single rows: joined on a constant key
    return (
        rates.withColumn("_one", F.lit(1))
        .join(roc_auc(pairs).withColumn("_one", F.lit(1)), "_one")
        .drop("_one")
    )


def percentiles(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Exact p50/p95/p99 of a column with few distinct values (scores with four decimals)."""
    cuts = F.percentile(rounded(F.col(column), digits), F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return df.agg(cuts.alias("p")).select(
        *[rounded(F.element_at("p", i), 6).alias(name) for i, name in ((1, "p50"), (2, "p95"), (3, "p99"))]
    )


def approx_percentiles(df: DataFrame, column: str) -> DataFrame:
    """p50/p95/p99 of any column, by a mergeable sketch."""
    cuts = F.percentile_approx(column, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), 100_000)
    return df.agg(cuts.alias("p")).select(
        *[F.element_at("p", i).alias(name) for i, name in ((1, "p50"), (2, "p95"), (3, "p99"))]
    )
