from __future__ import annotations

import random
from collections import Counter

import pytest

from tollgate.llm import rindex, suffix_dedup
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def brute(texts: list[str | None], length: int):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.randint(10, 120))) for _ in range(6)]
    return ["".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdefg ") for _ in range(30)) for _ in range(rng.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(200))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab" if seed % 2 else b"abcdef") for _ in range(60))
    strings, length = [], rng.choice([2, 5, 9, 20])
    for _ in range(rng.randint(0, 6)):
        at = rng.randint(0, 50)
        string = bytearray(base[at : at + rng.randint(0, 60)])
        if string and rng.random() < 0.5:
            string[rng.randrange(len(string))] = 255
        strings.append(bytes(string))
    seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    for string, found in zip(strings, rindex.matching_statistics(strings), strict=True):
        for i in range(len(string) - length + 1):
            assert (found[i] >= length) == (seen[string[i : i + length]] > 1)


@pytest.mark.parametrize(("group_bytes", "cell_seed"), [(suffix_dedup.GROUP_BYTES, 1), (200, 2), (0, 3)])
def test_small_windows(documents, group_bytes, cell_seed, monkeypatch):
    texts = random_texts(cell_seed, 60) + [None, "", "aaaa" * 60, "abab" * 40]
    texts += texts[:5]
    docs = documents(list(enumerate(texts)))
    found = suffix_dedup.remove_repeats(docs, length=40, group_bytes=group_bytes).collect()
    assert len(found) == len(texts)
    expected = brute(texts, 40)
    for r in found:
        removed = sum(s["last"] - s["first"] + 1 for s in r["spans"])
        assert (r["n_bytes"], removed, len(r["spans"]), bytes(r["kept"])) == expected[r["doc_id"]], r["doc_id"]


def test_pieces_and_blocks(documents, monkeypatch):
    """Long texts in pieces, and many blocks, give the same."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 500)
    texts = random_texts(7, 40)
    occurrences = list(suffix_dedup.occurrences(40)((i, 0, t) for i, t in enumerate(texts)))
    windows = [(r[0], w) for r in occurrences for w in range(r[4], r[5] + 1)]
    assert sorted(windows) == [(i, w) for i, t in enumerate(texts) for w in range(len(t.encode()) - 39)]


def test_repeated_rows_and_clashes(clashing):
    found = suffix_dedup.remove_repeats(clashing, length=20).collect()
    assert len(found) == clashing.count()
    kept = {r["doc_id"]: r for r in found}
    assert bytes(kept[1]["kept"]) == b"" and kept[2]["n_bytes"] == 0 and bytes(kept[5]["kept"]) == b"word"
    assert bytes(kept[8]["kept"]) == b""


def test_query(spark):
    rows = QUERIES["op1_suffix_dedup"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    import hashlib

    ids = sorted(docs)
    expected = dict(zip(ids, brute([docs[i] for i in ids], 400), strict=True))
    for r in rows:
        n, gone, spans, kept = expected[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, hashlib.sha256(kept).hexdigest())
    assert len(rows) == len(docs)


def test_empty(documents):
    assert suffix_dedup.remove_repeats(documents([])).count() == 0
