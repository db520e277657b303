"""Quality rules with risk-controlled cutoffs, in DataFrame functions alone.

Each rule rejects a document whose measure is above a cutoff. Labelled good documents are the holdout: for every stratum
(language), rule and cutoff of a fixed grid, the exact binomial tail P(Bin(n, risk) <= rejected) says how surprising so
few false rejections would be if the true rate were `risk`. A cutoff is admissible when this is at most `delta` divided
by the number of tests (Bonferroni over strata, rules and cutoffs). The least cutoff down to which all are admissible
becomes the stratum's. Rules share the risk, so with probability 1 - delta every stratum loses at most `risk` of its
good documents. A stratum with too few labels gets no cutoff and rejects nothing by the method.

Null texts have no words. A null language is a stratum of its own. Several labels of one document count once, good if
any says so; labels without a document don't count. Repeated rows are judged alike and, if labelled, each is a holdout
row. An empty table gives an empty result; without labels only the base rules reject.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import SPACE, stored

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP, WORD_CHAR = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
WINDOW = 5

#: The rules' measures; a document above the cutoff is rejected.
RULES = {
    "symbol_ratio": "n_symbols / greatest(word_chars, 1)",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
    "capital_ratio": "n_capitals / greatest(word_chars, 1)",
}
CUTOFFS = tuple(i / 40 for i in range(1, 33))
RISK, DELTA = 0.04, 0.05


def occurrences(text: str, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def covered(starts: Column) -> Column:
    """Words in windows that begin at the given ascending places."""
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts, begin,
        lambda s, x: F.struct(x.alias("last"), (s["n"] + F.least(F.lit(WINDOW), x - s["last"])).alias("n")),
        lambda s: s["n"],
    )


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Per row: doc_id, stratum, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words.

    Five-word windows are hashed in place (64 bits, within one document) and only documents in which two hashes are
    equal sort them; nothing is exploded or shuffled.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.coalesce(text, F.lit("")).alias("t"))
    trimmed = F.btrim("t", F.lit(SPACE))
    split = base.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP)))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD_CHAR))
    hashed = split.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACE, "")).cast("long").alias("word_chars"),
        occurrences("t", SYMBOLS).alias("n_symbols"), occurrences("t", CAPITALS).alias("n_capitals"), lines.alias("lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
            ),
        ).alias("windows"),
    )
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn("pairs", F.when(some, F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    again = F.transform(
        "pairs",
        lambda p, j: F.when(
            (p["w"] == F.get(F.col("pairs"), j - 1)["w"]) | (p["w"] == F.get(F.col("pairs"), j + 1)["w"]), p["i"]
        ),
    )
    starts = F.array_sort(F.array_compact(again))
    return ordered.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_capitals", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered(starts), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def log_factorial(n: Column) -> Column:
    """ln n!: a table up to 19, Stirling's series beyond (error below 1e-14)."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(20)])
    x = n.cast("double")
    series = x * F.log(x) - x + F.log(2 * math.pi * x) / 2 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n < 20, F.get(small, n.cast("int"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below the mean, 1 at or above it.

    Terms are summed downwards from k, where they are largest; past fifty times the square root they are below what a
    double can show.
    """
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    begin = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.least(k, (50 * F.sqrt(k + 1)).cast("long") + 50)), begin,
        lambda s, i: F.struct(
            (s["term"] * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("term"), (s["sum"] + s["term"]).alias("sum")
        ),
        lambda s: s["sum"],
    )
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(top) * total)).otherwise(F.lit(1.0))


def last_bad(name: str, risk: float, delta: float) -> Column:
    """Place of the laxest cutoff that is not admissible, -1 if all are; cutoffs go from strict to lax."""
    bad = F.transform(name, lambda k: binomial_tail(k, F.col("n"), risk / len(RULES)) * F.col("m") > delta)
    places = F.sequence(F.lit(0), F.lit(len(CUTOFFS) - 1))
    return F.aggregate(places, F.lit(-1), lambda last, i: F.when(F.get(bad, i), i).otherwise(last))


def cutoffs(holdout: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, <rule>_cutoff...) from the good documents' measures; null where nothing is guaranteed."""
    counts = holdout.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.array(*[F.count_if(F.expr(rule) > cut) for cut in CUTOFFS]).alias(name) for name, rule in RULES.items()],
    )
    tests = counts.withColumn("m", F.expr("count(*) over ()") * len(RULES) * len(CUTOFFS))
    grid = F.array(*[F.lit(c) for c in CUTOFFS])
    chosen = [F.get(grid, last_bad(name, risk, delta) + 1).alias(f"{name}_cutoff") for name in RULES]
    return tests.select("stratum", *chosen)


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The measures of every row with base_failed and kept."""
    measured = stored(measures(docs), "rule-measures")
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1").select("doc_id")
    holdout = measured.join(good, "doc_id", "left_semi")
    limits = cutoffs(holdout, risk, delta).withColumnRenamed("stratum", "of")
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left")
    above = [F.coalesce(F.expr(rule) > F.col(f"{name}_cutoff"), F.lit(False)) for name, rule in RULES.items()]
    rejected = F.lit(False)
    for one in above:
        rejected = rejected | one
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected)
