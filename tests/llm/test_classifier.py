from __future__ import annotations

import random

import numpy as np
import pytest

from tollgate.llm import classifier as c

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fit on four fifths of the labels, judge the rest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = c.train(docs, labels.filter("doc_id % 5 <> 0"))
    judged = c.score(docs, model).join(labels.filter("doc_id % 5 = 0"), "doc_id").collect()
    toxic, poor = [r for r in judged if r["toxic"]], [r for r in judged if not r["quality"] and not r["toxic"]]
    good = [r for r in judged if r["quality"] and not r["toxic"]]
    assert sum(not r["kept"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(not r["kept"] for r in poor) >= 0.7 * len(poor)
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    mean = lambda rows: np.mean([r["expected_grade"] for r in rows])
    assert mean(toxic) < mean(poor) < mean(good)


def test_gradient_and_order():
    """The fit beats its start and keeps its thresholds in order on data with a known latent score."""
    rng = np.random.default_rng(0)
    rows, buckets, grades = [], [], []
    for i in range(600):
        own = rng.choice(40, 8, replace=False)
        score = (own < 10).sum() - (own >= 30).sum()
        grades.append(0 if score < -1 else 1 if score < 1 else 2)
        rows += [i] * 8
        buckets += own.tolist()
    model = c.fit(np.array(grades), np.array(rows), np.array(buckets))
    assert model.thresholds[0] < model.thresholds[1]
    weights = model.weights[:40]
    assert weights[:10].mean() > weights[10:30].mean() > weights[30:].mean()
    expected = [model.tails(np.array(buckets[8 * i : 8 * i + 8])).sum() for i in range(600)]
    assert np.corrcoef(expected, grades)[0, 1] > 0.85


def test_same_model_whatever_the_partitions(documents, spark):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["good", "fine", "bad", "ugly"][: 2 + 2 * (i % 2)]) + str(rng.randint(0, 3)) for _ in range(20))) for i in range(80)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(80)], LABELS)
    one, two = (c.train(documents(texts, n), labels) for n in (1, 7))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


@pytest.mark.parametrize(("labels", "kept"), [([], True), ([(1, 1, 0)], True), ([(1, 0, 0), (2, 0, None)], False), ([(None, 1, 1), (77, 1, 1), (1, None, 1)], True)])
def test_few_labels(documents, spark, labels, kept):
    docs = documents([(1, "a"), (2, None), (3, "")])
    model = c.train(docs, spark.createDataFrame(labels, LABELS))
    assert [r["kept"] for r in c.score(docs, model).collect()] == [kept] * 3


def test_odd_rows(clashing, documents, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 0, 0), (5, 1, 0)], LABELS)
    model = c.train(clashing, labels)
    assert c.score(clashing, model).count() == clashing.count()
    chosen = c.select(clashing, model)
    assert chosen.columns == clashing.columns
    assert chosen.count() == c.score(clashing, model).filter("kept").count()
    assert c.score(documents([]), c.train(documents([]), labels)).count() == 0
