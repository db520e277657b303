from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tollgate.llm import tokens
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def counted(monkeypatch, tmp_path):
    """Number of rows the cache has, by looking at it."""
    return lambda spark, path: spark.read.parquet(path).count()


def test_query_against_the_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in QUERIES["op10_token_counts"](spark, SF).collect():
        n = len(model.encode(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 4096)


def test_cache(spark, documents, counted, tmp_path):
    path = str(tmp_path / "cache")
    docs = documents([(1, "one"), (2, "one"), (3, "two <s> </s> <unk>"), (4, None), (5, ""), (1, "one")])
    first = sorted(tokens.count_tokens(docs, MODEL, path).select("doc_id", "n_bytes", "n_tokens").collect())
    assert counted(spark, path) == 3  # one, two, empty
    again = sorted(tokens.count_tokens(docs, MODEL, path).select("doc_id", "n_bytes", "n_tokens").collect())
    assert first == again and counted(spark, path) == 3
    tokens.count_tokens(documents([(9, "three"), (10, "two <s> </s> <unk>")]), MODEL, path)
    assert counted(spark, path) == 4
    other = public_tokenizers.path("byte_bpe_50k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, other, path).collect()}
    assert counted(spark, path) == 7
    library = Tokenizer.from_file(other)
    assert got[3] == len(library.encode("two <s> </s> <unk>", add_special_tokens=False).ids)


def test_stored_counts_are_used(spark, documents, tmp_path):
    """A count planted in the cache is what comes out: nothing was encoded."""
    path = str(tmp_path / "cache")
    docs = documents([(1, "one"), (2, "one")])
    digest = tokens.count_tokens(docs, MODEL, path).first()["digest"]
    planted = str(tmp_path / "planted")
    spark.createDataFrame([(digest, tokens.tokenizer_digest(MODEL), 77)], tokens.CACHE).write.parquet(planted)
    assert [r["n_tokens"] for r in tokens.count_tokens(docs, MODEL, planted).collect()] == [77, 77]


def test_odd_rows(clashing, documents, tmp_path):
    got = tokens.count_tokens(clashing, MODEL, str(tmp_path / "a")).collect()
    assert len(got) == clashing.count() and all(r["n_tokens"] is not None for r in got)
    assert tokens.count_tokens(documents([]), MODEL, str(tmp_path / "b")).count() == 0
