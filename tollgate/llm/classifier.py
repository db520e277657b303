"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features serves all grades; ordered thresholds cut its score into grades:
P(grade <= k) = sigmoid(threshold_k - score). From it come the expected grade and the tail probability of the top grade
that selection uses. Features are which words occur (stripped of punctuation, lower case, hashed), which beginnings of
words occur (so that inflected forms share a weight), and how the text looks (steps of its shares of capitals, symbols,
digits, bars, exclamation marks, different words and repeats of the word before).

The model is fitted on at most `max_labels` labelled documents, those least by a hash of their id (the bound of what
comes to the driver and of the broadcast); every document is scored. Words in fewer than `min_docs` of the sample carry no
weight. Fitting starts from zeros and is deterministic.

Null texts are empty. A document's several labels count as the worst of them; null labels count as not given. Repeated
rows get equal results. Without labels of at least two grades nothing can be learned: every document then has the
expected grade of the labels there are (top grade if none) and is kept or rejected accordingly.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import keep_rows, map_rows

BUCKETS = 1 << 20
MAX_LABELS, MIN_DOCS = 10_000, 8
PREFIXES = (4, 5)  # bytes of a longer word
PUNCTUATION = b".,;:!?\"'()[]{}*#$%&|<>=~^_-"
CAPITALS, SYMBOLS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>", b"0123456789"
STEPS = 20
TOP = 2  # grades: 0 toxic, 1 poor, 2 good


def features(text: str) -> np.ndarray:
    """Distinct buckets of a text."""
    raw = text.encode()
    words = raw.lower().split()
    kinds = {w.strip(PUNCTUATION) for w in set(words)}
    found = {zlib.crc32(w) % BUCKETS for w in kinds}
    for n in PREFIXES:
        found.update([zlib.crc32(b"<" + w[:n]) % BUCKETS for w in kinds if len(w) > n])
    length = max(len(raw), 1)
    shares = [(length - len(raw.translate(None, c))) / length if raw else 0.0 for c in (CAPITALS, SYMBOLS, DIGITS, b"|", b"!")]
    shares.append(len(kinds) / max(len(words), 1))
    shares.append(sum(map(eq, words, words[1:])) / max(len(words), 1))
    for place, share in enumerate(shares):
        found.add(zlib.crc32(b"share %d %d" % (place, int(share * STEPS))) % BUCKETS)
    found.add(zlib.crc32(b"length %d" % len(words).bit_length()) % BUCKETS)
    return np.fromiter(found, dtype=np.int32, count=len(found))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Ordinal:
    """Weights and ascending thresholds; grade k lies between threshold k-1 and threshold k."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, buckets: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 - sigmoid(self.thresholds - float(self.weights[buckets].sum()))


def fit(grades: np.ndarray, rows: np.ndarray, buckets: np.ndarray, steps: int = 250, rate: float = 0.1, ridge: float = 1.5e-3, min_docs: int = MIN_DOCS) -> Ordinal:
    """Full-batch Adam on the likelihood; `rows` and `buckets` are the features' coordinates."""
    present = np.unique(grades)
    if len(present) < 2:
        only = int(present[0]) if len(present) else TOP
        return Ordinal(np.zeros(BUCKETS, np.float32), np.where(np.arange(TOP) < only, -20.0, 20.0))
    used = np.bincount(buckets, minlength=BUCKETS) >= min_docs
    rows, buckets = rows[used[buckets]], buckets[used[buckets]].astype(np.int64)
    n = len(grades)
    below = np.array([max((grades <= k).mean(), 1e-4) for k in range(TOP)])
    start = np.log(below / np.maximum(1 - below, 1e-4))
    params = np.zeros(BUCKETS + TOP)
    params[BUCKETS] = start[0]
    params[BUCKETS + 1 :] = np.log(np.maximum(np.diff(start), 0.1))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        first, gaps = params[BUCKETS], np.exp(params[BUCKETS + 1 :])
        cuts = np.concatenate([[-np.inf], first + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(rows, weights=params[buckets], minlength=n)
        high, low = sigmoid(cuts[grades + 1] - score), sigmoid(cuts[grades] - score)
        mass = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / mass, low * (1 - low) / mass  # slope of the log-likelihood by either cut
        grad = np.zeros_like(params)
        grad[:BUCKETS] = np.bincount(buckets, weights=(d_high - d_low)[rows], minlength=BUCKETS) / n + ridge * params[:BUCKETS]
        by_cut = np.array([(d_low[grades == k + 1].sum() - d_high[grades == k].sum()) / n for k in range(TOP)])
        grad[BUCKETS] = by_cut.sum()
        grad[BUCKETS + 1 :] = [by_cut[k + 1 :].sum() * gaps[k] for k in range(TOP - 1)]
        mean += 0.1 * (grad - mean)
        square += 0.001 * (grad**2 - square)
        params -= rate * (1 - (step - 1) / steps) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    cuts = params[BUCKETS] + np.concatenate([[0], np.cumsum(np.exp(params[BUCKETS + 1 :]))])
    return Ordinal(params[:BUCKETS].astype(np.float32), cuts)


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, doc_id: str = "doc_id", text: str = "text") -> Ordinal:
    """Model of the labelled documents' grades: toxic 0, else low quality 1, else 2."""
    graded = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.when(F.max(F.coalesce("toxic", F.lit(0))) > 0, 0).when(F.min("quality") < 1, 1).otherwise(TOP).alias("grade")
    )
    sample = graded.orderBy(F.xxhash64("labelled"), "labelled").limit(max_labels)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
    once = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("grade").alias("grade"))

    def run(rows):
        for key, content, grade in rows:
            yield key, grade, features(content or "").tolist()

    found = map_rows(once, run, "doc_id long, grade int, buckets array<int>").toArrow().combine_chunks()
    if not found.num_rows:
        return fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    lists = found["buckets"].combine_chunks().take(order)
    counts = np.diff(lists.offsets.to_numpy())
    return fit(found["grade"].to_numpy()[order], np.repeat(np.arange(len(order)), counts), lists.flatten().to_numpy())


def score(docs: DataFrame, model: Ordinal, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: doc_id, expected_grade, p_top (of the top grade), kept (p_top >= least)."""

    def run(rows):
        for key, content in rows:
            tails = model.tails(features(content or ""))
            yield key, float(tails.sum()), float(tails[-1]), bool(tails[-1] >= least)

    return map_rows(docs.select(doc_id, text), run, "doc_id long, expected_grade double, p_top double, kept boolean", limit=8192)


def select(docs: DataFrame, model: Ordinal, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows that `score` keeps, with all their columns."""
    return keep_rows(docs, text, lambda: lambda content: bool(model.tails(features(content))[-1] >= least))
