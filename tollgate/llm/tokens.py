"""Token counts through a digest cache.

A text's count depends on its normalised content and on the tokenizer alone, so counts are kept in a table keyed by
the two digests. A run looks its digests up, encodes one representative of each distinct miss, appends those counts
and reads the result from the cache. Copies, however many, cost one encoding; a second run over the same texts costs
none. Texts travel once, to meet the list of representatives; their digests are 32 bytes.

Null texts count as empty ones. Repeated rows and repeated ids each get their row back. An empty table gives an empty
result and leaves the cache as it was. Two runs that append the same digest do no harm: equal keys are read as one.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows

CACHE = "digest binary, tokenizer binary, n_tokens long"


def tokenizer_digest(path: str) -> bytes:
    """Version of a tokenizer: the library that reads it and every byte of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(os.path.splitext(path)[1].encode() + b"\0" + file.read()).digest()


def encoder(path: str):
    """Function from a list of texts to their numbers of tokens, as the file's library counts them."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def open_cache(spark: SparkSession, path: str, version: bytes) -> DataFrame:
    """Stored counts of one tokenizer version; the table is made when it isn't there."""
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(path)
    rows = spark.read.schema(CACHE).parquet(path).filter(F.col("tokenizer") == F.lit(version))
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    model_path: str,
    cache_path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    normalise: Column | None = None,
) -> DataFrame:
    """Every row's doc_id, n_bytes and n_tokens; counts of texts not yet in the cache are appended to it.

    `normalise` is the content that the digest covers. It must be something the tokenizer cannot tell from the text;
    by default it is the text itself, which holds for tokenizers that normalise nothing.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(model_path)
    content = F.coalesce(normalise if normalise is not None else F.col(text), F.lit(""))
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        content.alias("content"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    keys = texts.drop("content")

    known = open_cache(spark, cache_path, version)
    first = keys.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    misses = first.join(known, "digest", "left_anti")
    own = {"id_key": F.coalesce("doc_id", F.lit(0)), "no_id": F.col("doc_id").isNull()}
    lost = misses.withColumnRenamed("rep", "doc_id").withColumns(own).drop("doc_id")
    names = ["digest", "id_key", "no_id"]
    chosen = texts.withColumns(own).join(lost, names, "left_semi").dropDuplicates(names)  # of repeated rows; already dealt by these keys

    def encode(rows):
        count = encoder(model_path)
        held: list[tuple[bytes, str]] = []
        weight = 0
        for digest, content in rows:
            held.append((digest, content))
            weight += len(content)
            if weight > 1_000_000:
                yield from ((d, version, n) for (d, _), n in zip(held, count([t for _, t in held]), strict=True))
                held, weight = [], 0
        if held:
            yield from ((d, version, n) for (d, _), n in zip(held, count([t for _, t in held]), strict=True))

    map_rows(chosen.select("digest", "content"), encode, CACHE).write.mode("append").parquet(cache_path)
    counts = open_cache(spark, cache_path, version).withColumnRenamed("digest", "stored")
    return keys.join(counts, F.col("digest") == F.col("stored"), "left").select("doc_id", "n_bytes", "n_tokens", "digest")
