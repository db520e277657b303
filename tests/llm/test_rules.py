from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tollgate.llm import rules

LABELS = "doc_id long, quality int, toxic int"


def brute(text: str | None) -> tuple:
    words = (text or "").encode().split()
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def test_measures(clashing, documents):
    texts = ["", " ", "a b c d e", "a b c d e a b c d e", "x x x x x x x", "a\n\na\n b\na\n", "# % <b>\x0b\x1c\x85 z", "é É ß " * 40, "1 2 3 4 5 6 1 2 3 4 5 9 2 3 4 5 6"]
    for frame in (clashing, documents(list(enumerate(texts)))):
        pairs = frame.select("doc_id", "text").collect()
        got = rules.measures(frame).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
        assert Counter(map(tuple, got)) == Counter(brute(r["text"]) for r in pairs)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 0, 0.01), (0, 500, 0.01), (3, 1000, 0.01), (9, 1000, 0.01), (10, 1000, 0.01), (70, 10_000, 0.01), (0, 5, 0.3), (19, 40, 0.5)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("t")).first()["t"]
    exact = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert got == (pytest.approx(exact, rel=1e-9) if k < n * p else 1.0)


def test_cutoffs_follow_the_labels(documents, spark):
    """Symbols are harmless in one language and unseen among the good of another, which has labels enough."""
    clean = "plain words that never repeat themselves at all in here {}"
    symbols = "## %% ** $$ && plain words that look odd to all of us {}"
    rows = [(i, clean.format(i), "en") for i in range(1500)] + [(2000 + i, symbols.format(i), "fr") for i in range(1500)]
    rows += [(5000, symbols, "en"), (5001, symbols, "fr"), (5002, symbols, "xx"), (5003, symbols, None), (5004, clean, "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3500)] + [(None, 1, 0), (99_999, 1, 0)], LABELS)
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(documents(rows), labels).filter("doc_id >= 5000").collect()}
    assert kept == {5000: False, 5001: True, 5002: True, 5003: True, 5004: True}


def test_guarantee(documents, spark):
    """No more than the allowed share of the good is rejected by any cutoff."""
    rows = [(i, "word " * 3 + "#" * (i % 200 == 0) * 20 + f" a{i} b c d e f g h", "en") for i in range(3000)]
    judged = rules.judge(documents(rows), spark.createDataFrame([(i, 1, 0) for i in range(3000)], LABELS))
    assert judged.filter("not kept").count() <= 0.04 * 3000


def test_odd_rows(clashing, documents, spark):
    none = spark.createDataFrame([], LABELS)
    got = rules.judge(clashing, none).collect()
    assert len(got) == clashing.count() and all(r["kept"] == (not r["base_failed"]) for r in got)
    assert rules.judge(documents([]), none).count() == 0
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (2, None, None)], LABELS)
    assert rules.judge(clashing, labels).count() == clashing.count()


def test_native(clashing, spark):
    plan = rules.judge(clashing, spark.createDataFrame([], LABELS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
