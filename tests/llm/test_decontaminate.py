from __future__ import annotations

import random

import pytest

from tollgate.llm import decontaminate as d
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"


def distance(pattern: list, text: list) -> int:
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1))
    return min(row)


@pytest.mark.parametrize("seed", range(60))
def test_myers(seed):
    rng = random.Random(seed)
    pattern = [rng.randint(1, 4) for _ in range(rng.randint(1, 80))]
    text = [rng.randint(0, 4) for _ in range(rng.randint(0, 90))]
    best, last = d.myers(pattern, text)
    if text:
        assert min(best, len(pattern)) == distance(pattern, text)
        if last >= 0:
            assert distance(pattern[::-1], text[: last + 1][::-1]) == best


@pytest.mark.parametrize("seed", range(40))
def test_pieces_lose_nothing(seed):
    rng = random.Random(seed)
    words = "the of and a in to is on".split()
    item = [rng.choice(words) + str(rng.randint(0, 3)) for _ in range(rng.randint(3, 40))]
    text = [rng.choice(words) for _ in range(30)]
    part = list(item)
    for _ in range(rng.randint(0, 10)):
        at = rng.randrange(len(part)) if part else 0
        change = rng.randint(0, 2)
        part[at : at + (change != 1)] = [] if change == 0 else ["new"]
    text[10:10] = part
    found = list(d.Pieces([(5, " ".join(item))]).matches(" ".join(text)))
    best = distance(item, text)
    assert bool(found) == (best <= int(0.2 * len(item)))
    if found:
        assert min(f[1] for f in found) == best


def test_places(spark, documents):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "...")], ITEMS)
    docs = documents([(1, "x ONE, two; three four five\nsix seven eight nine ten y"), (2, "one two three 4 five six seven eight nine ten"), (3, "one two three"), (4, None), (5, "")])
    got = {r["doc_id"]: (r["item_id"], r["distance"], r["first_word"], r["last_word"]) for r in d.find_matches(docs, items).collect()}
    assert got == {1: (1, 0, 1, 10), 2: (1, 1, 0, 9)}
    assert sorted(r["doc_id"] for r in d.without_matches(docs, items).collect()) == [3, 4, 5]


def test_blocks_agree(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, d.find_matches(docs, items).collect()))
    assert whole == sorted(map(tuple, d.find_matches(docs, items, block_bytes=2000).collect()))
    left = d.without_matches(docs, items, block_bytes=2000)
    assert left.columns == docs.columns and left.count() == docs.count() - len({r[0] for r in whole})


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 1500").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    for doc in docs[:25]:
        words = d.words_of(doc["text"])
        for item in items:
            pattern = d.words_of(item["text"])
            assert ((doc["doc_id"], item["item_id"]) in found) == (distance(pattern, words) <= int(0.2 * len(pattern)))


def test_odd_rows(clashing, spark):
    items = spark.createDataFrame([(1, "no id at all"), (1, "no id at all")], ITEMS)
    assert d.find_matches(clashing, items).count() == 2
    assert d.without_matches(clashing, items).count() == clashing.count() - 1
    nothing = spark.createDataFrame([], ITEMS)
    assert d.find_matches(clashing, nothing).count() == 0
    assert d.without_matches(clashing, nothing).columns == clashing.columns
    assert d.find_matches(clashing.limit(0), items).count() == 0
