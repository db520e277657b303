from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tollgate.llm import alignment, pieces
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(texts: list) -> list[tuple]:
    """Measures of each text by whole encodings and plain loops."""
    a, b = libraries()
    bytes_a, bytes_b = pieces.byte_tokens(a), alignment.sentence_tokens(b)
    found, held = [], Counter()
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = [b"".join(t[i] for i in own) for own, t in zip(ids, (bytes_a, bytes_b), strict=True)]
        if not text or whole != [b" " + text.encode()] * 2:
            found.append(None)
            continue
        ends = []
        for own, tokens in zip(ids, (bytes_a, bytes_b), strict=True):
            at, side = 0, []
            for i in own:
                at += len(tokens[i])
                side.append(at)
            ends.append(side)
        groups, start = [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            stop = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((ids[0][start[0] : stop[0]], ids[1][start[1] : stop[1]]))
            start = stop
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        found.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(shown.encode()).hexdigest()))
        held.update(links.keys())
    best: dict = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            links = f[3]
            out.append((*f[:3], links.total(), sum(n for k, n in links.items() if held[k] == best[k[0]]), sum(n * held[k] for k, n in links.items()), f[4]))
    return out


def measured(rows) -> list[tuple]:
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return [tuple(r[n] for n in names) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_query_against_plain_loops(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    got = QUERIES["op13_token_alignment"](spark, SF).collect()
    assert len(got) == len(docs) and measured(got) == plain([r["text"] for r in docs])


def test_strange_texts(documents):
    rng = random.Random(5)
    signs = [*"ab é漢字\n\t\x00'sll.,▁\xa0　\x85\x1c1２🎉", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "  ", "\n\n", " word", "don't "]
    texts = [None, "", " ", "  ", "a▁b c", "x", "a" * 5000, "漢字" * 700, "🎉" * 300, " lead", "trail ", "a\nb", "<|endoftext|>", "the same", "the same"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    expected = plain(texts)
    assert expected[4][0] == 0 and expected[9][0] > 0  # a sign for a space in the text is lost
    assert measured(alignment.align(documents(list(enumerate(texts))), A, B)[0].collect()) == expected


def test_pairs_count_documents(documents):
    docs = documents([(1, "one two"), (2, "one two"), (3, "one one"), (4, None)])
    found, pairs = alignment.align(docs, A, B)
    a, b = libraries()
    (one,), (eins,) = a.encode(" one", add_special_tokens=False).ids, b.encode("one")
    counts = {(r["a"], r["b"]): (r["count"], r["best"]) for r in pairs.collect()}
    assert counts[one, eins] == (3, 1) and found.count() == 4
    sums = {r["doc_id"]: r["count_sum"] for r in found.collect()}
    assert sums[1] == sums[2] == 3 + 2 and sums[3] == 6 and sums[4] == 0


@pytest.mark.parametrize("size", [0, 1, 2])
def test_large_groups(monkeypatch, size):
    """Groups over the limit are counted, with the same pairs."""
    listed = alignment.Aligner(A, B)
    words = ["a" * 30, "Ünïcödé", "xyzzyqwrtp", "plain"]
    expected = [dict(zip(*pairs_of(i), strict=True)) if i.times else Counter(pairs_of(i)[0]) for i in listed(words)]
    monkeypatch.setattr(alignment, "LARGE", size)
    again = [dict(zip(*pairs_of(i), strict=True)) if i.times else Counter(pairs_of(i)[0]) for i in listed(words)]
    assert again == expected


@pytest.mark.parametrize("size", [0, alignment.LARGE])
def test_words_of_a_call(monkeypatch, size):
    """Words laid end to end are aligned as each alone, and those whose tokens don't give their bytes stand apart."""
    monkeypatch.setattr(alignment, "LARGE", size)
    aligner = alignment.Aligner(A, B)
    words = ["plain", "a" * 30, "Ünïcödé", "no\u00a0 such", "", "xyzzyqwrtp", "two\nlines", "漢字🎉", "x"]
    together = aligner(words)
    assert together == [one for w in words for one in aligner([w])]
    assert None in together and aligner([]) == []
    assert all(i is None or len(i.sizes) == 32 for i in together)


def test_blocks_are_made_without_collection():
    import gc

    with alignment.uncollected():
        assert not gc.isenabled()
    assert gc.isenabled()


def pairs_of(item):
    import numpy as np

    return np.frombuffer(item.pairs, dtype="<i8").tolist(), np.frombuffer(item.times, dtype="<i8").tolist()


def test_pack():
    import numpy as np

    for pairs, times in (([], []), ([0], [1]), ([5, 300, 70_000, 2**33], [1, 2**40, 3, 255]), ([1, 2, 3], [256, 1, 1])):
        found = alignment.unpack(alignment.pack(np.array(pairs, dtype=np.int64), np.array(times, dtype=np.int64)))
        assert [x.tolist() for x in found] == [pairs, times]


def test_odd_rows(clashing, documents):
    got = alignment.align(clashing, A, B)[0].collect()
    assert len(got) == clashing.count()
    assert all((r["n_a"] > 0) == (r["groups_sha256"] != "") for r in got) and any(r["n_a"] for r in got)
    assert alignment.align(documents([]), A, B)[0].count() == 0
    assert measured(alignment.align(documents([(1, None), (2, "")]), A, B)[0].collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2
