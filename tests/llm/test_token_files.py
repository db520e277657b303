from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tollgate.llm import pieces, rans, token_files
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows: list[tuple], end: int = 2) -> list[tuple]:
    """(doc_id, start, n_tokens, crc32) by encoding whole texts one after the other."""
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def found(df) -> list[tuple]:
    return sorted((tuple(r[n] for n in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in df.collect()), key=lambda r: r[1])


def test_query_against_the_library(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert found(QUERIES["op12_token_files"](spark, SF)) == expected(docs)


@pytest.mark.parametrize(("block_ids", "block_docs"), [(7, 1000), (64, 3), (1 << 18, 1 << 14), (1, 1)])
def test_blocks_of_all_sizes(spark, documents, tmp_path, block_ids, block_docs):
    """Documents shorter and longer than a block, and a document that ends with one."""
    rng = random.Random(block_ids)
    rows = [(i, " ".join(rng.choice(["one", "two", "threefold", "Ünï", "\n"]) for _ in range(rng.choice([0, 1, 5, 6, 40])))) for i in range(60)]
    path = str(tmp_path / "files")
    token_files.write(documents(rows), PATH, path, block_ids=block_ids, block_docs=block_docs)
    assert found(token_files.documents(spark, path)) == expected(rows)
    library = Tokenizer.from_file(PATH)
    got: dict = {}
    for r in sorted(token_files.read_ids(spark, path, 10, 20).collect(), key=lambda r: (r["doc_id"], r["first"])):
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    assert got == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in rows if 10 <= i <= 20}


def test_words_give_the_ids_of_texts():
    """Cut at spaces and line ends, whatever stands around them."""
    library, encode = Tokenizer.from_file(PATH), token_files.text_encoder(PATH, "<u4")
    rng = random.Random(7)
    signs = [*"ab é漢\n\t \x00'sll.,▁\xa0　\x85\x1c1２", "<|endoftext|>", "  ", "\n\n", " 's", "don't ", " x", "word\nNext"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_generations(monkeypatch):
    asked: list[str] = []
    cache = pieces.Cache(lambda words: asked.extend(words) or {w: w.upper() for w in words}, most=3)
    for words in ({"a", "b"}, {"c", "d"}, {"a", "e"}, {"x" * 100}, {"y"}):
        known = cache.look_up(words)
        assert all(known[w] == w.upper() for w in words)
    assert asked.count("a") == 1 and "x" * 100 not in cache.newer and len(cache.newer) + len(cache.older) <= 8


def test_words_of_a_call_are_looked_up_once(monkeypatch):
    """However often words repeat, through changes of generation; long ones leave nothing behind."""
    asked: list[str] = []

    def ids_of(words):
        asked.extend(words)
        return {w: w.encode("utf-16-le") for w in words}

    class Counted(pieces.Numbers):
        def __getitem__(self, word):
            looked_up.extend([word] * (self is cache.newer))
            return super().__getitem__(word)

    monkeypatch.setattr(pieces, "Numbers", Counted)
    cache = pieces.IdCache(ids_of, "<u2", most=40)
    rng, long, looked_up = random.Random(3), "y" * 300, []
    for call in range(30):
        texts = [" ".join(rng.choice(["a", "bc", "é", long, *(f"w{call + i}" for i in range(9))]) for _ in range(rng.choice([1, 2, 200]))) for _ in range(7)]
        del looked_up[:]
        firsts, others = pieces.split_texts(texts, False)
        got = cache([" " + f for f in firsts], others)
        assert [g.decode("utf-16-le") for g in got] == [" " + "".join(t.split(" ")) for t in texts]
        assert len(looked_up) <= len(firsts) + len({w for t in texts for w in t.split(" ")[1:]})
        assert long not in cache.newer and cache.newer.used < 300 and len(cache.newer) <= 40 + 30
    assert asked.count("bc") < 5 and asked.count(long) > 5
    assert cache([], pieces.split_texts([], False)[1]) == []


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 1024, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n).clip(0, 50_000)
    table = rans.Table(rans.quantise(np.bincount(ids, minlength=50_001)))
    block = rans.encode(ids, table, lanes=64, check=256)
    assert rans.n_ids(block) == n and rans.decode(block, table).tolist() == ids.tolist()
    for first, stop in ((0, 1), (255, 257), (256, 300), (700, None), (n - 1, n)):
        assert rans.decode(block, table, max(first, 0), stop).tolist() == ids[max(first, 0) : stop].tolist()
    if n > 1000:
        p = np.bincount(ids) / n
        bits = -(p[p > 0] * np.log2(p[p > 0])).sum()
        assert len(block) * 8 < n * bits * 1.05 + 64 * 64 * (1 + n / 256) + 400
        broken = bytearray(block)
        broken[-7] ^= 1
        with pytest.raises((ValueError, IndexError)):
            rans.decode(bytes(broken), table)


@pytest.mark.parametrize("counts", [[0, 0], [1], [5, 0, 10**12], [1] * 5000, [10**9] + [1] * 60_000, list(range(1000))])
def test_quantise(counts):
    frequency = rans.quantise(np.array(counts))
    assert frequency.sum() == ((1 << rans.BITS) if sum(counts) else 0)
    assert all((f > 0) == (c > 0) for f, c in zip(frequency.tolist(), counts, strict=True))


def test_checksums_join():
    ids = np.arange(1000)
    for cut in (0, 1, 500, 1000):
        a, b = ids[:cut], ids[cut:]
        assert rans.join_checksums(rans.checksum(a), rans.checksum(b), len(b)) == rans.checksum(ids) == rans.checksum(b, rans.checksum(a))


def test_odd_rows(spark, clashing, documents, tmp_path):
    token_files.write(clashing, PATH, str(tmp_path / "a"))
    got = found(token_files.documents(spark, str(tmp_path / "a")))
    assert len(got) == clashing.count() and [r[0] is None for r in got[:2]] == [True, True]
    assert [r[0] for r in got[2:]] == sorted(r[0] for r in got[2:])
    starts = [r[1] for r in got]
    assert starts == [sum(r[2] for r in got[:i]) for i in range(len(got))]
    assert {r[2] for r in got if r[0] in (2, 3)} == {1}
    token_files.write(documents([]), PATH, str(tmp_path / "b"))
    assert token_files.documents(spark, str(tmp_path / "b")).count() == 0
    assert token_files.read_ids(spark, str(tmp_path / "b")).count() == 0
