from __future__ import annotations

import re

import corpus_pipeline
import pytest

from llm import test_decontaminate, test_mixing, test_simhash
from tollgate.llm import classifier, decontaminate, pii
from tollgate.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "personal data", "mixing sources"]


@pytest.fixture(scope="module")
def staged(spark):
    """Rows before each stage and after the last."""
    docs, rows = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        rows.append(docs.collect())
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
    return [*rows, docs.collect()]


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES


def test_columns(staged):
    for rows in staged[:5]:
        assert list(rows[0].asDict()) == corpus_pipeline.COLUMNS


def test_quality(spark, staged):
    docs = table(spark, SF, "documents")
    model = classifier.train(docs, table(spark, SF, "labels"))
    kept = [r for r in staged[0] if model.tails(classifier.features(r["text"] or ""))[-1] >= 0.5]
    assert sorted(kept) == sorted(staged[1]) and len(kept) < len(staged[0])


def test_rows_with_one_id_stay(spark, documents):
    """Unlike texts with one id are different documents; a repeated row and a near copy are not."""
    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    rows = [(5, texts["a"]), (5, texts["b"]), (6, texts["c"]), (5, texts["a"]), (9, texts["b"] + " end"), (4, texts["d"] + " end"), (5, texts["d"])]
    kept = corpus_pipeline.near_dedup(spark, documents(rows), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(4, texts["d"] + " end"), (5, texts["a"]), (5, texts["b"]), (6, texts["c"])])


def test_near_dedup_by_exact_jaccard(staged):
    expected = test_simhash.plain_kept([(r["doc_id"], r["text"]) for r in staged[1]])
    assert sorted(r["doc_id"] for r in staged[2]) == expected and len(expected) < len(staged[1])


def test_decontamination(spark, staged):
    items = [decontaminate.words_of(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    kept = {r["doc_id"] for r in staged[3]}
    for r in staged[2]:
        words = decontaminate.words_of(r["text"])
        if len(words) < 250:
            dirty = any(test_decontaminate.distance(i, words) <= int(0.2 * len(i)) for i in items)
            assert (r["doc_id"] in kept) != dirty


def test_personal_data(staged):
    before = {r["doc_id"]: r for r in staged[3]}
    assert len(before) == len(staged[4])
    for r in staged[4]:
        old = before[r["doc_id"]]
        spans = pii.find(old["text"])
        assert r["n_chars"] == len(r["text"]) and (bool(spans) == (r["text"] != old["text"]))
        assert not any(s.text in r["text"] for s in spans if len(s.text) > 8)
        assert (r["lang"], r["source"]) == (old["lang"], old["source"])


def test_mixing_stage(staged):
    sizes: dict = {}
    for r in staged[4]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    target = test_mixing.water(sizes)
    assert sorted(r["doc_id"] for r in staged[5]) == sorted(r["doc_id"] for r in staged[4])
    for source in sizes:
        own = [r for r in staged[5] if r["source"] == source]
        assert own[0]["target"] == pytest.approx(target[source])
        assert abs(sum(r["taken"] for r in own) - target[source]) <= max(r["size"] for r in own)


@pytest.mark.parametrize("step", range(5))
def test_odd_rows(spark, clashing, documents, step):
    _, stage = corpus_pipeline.STAGES[step]
    odd = stage(spark, clashing, SF)
    assert odd.count() >= 1
    if step < 4:
        assert odd.columns == corpus_pipeline.COLUMNS
    assert stage(spark, documents([]), SF).count() == 0


def test_run_writes_and_reads_every_stage(spark, staged):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, staged[5]))
