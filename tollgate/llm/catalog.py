"""The registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import alignment, classifier, decontaminate, mixing, multi_index, oracles, pii, rules, secrets, simhash, suffix_dedup, token_files, tokens, wrapper
from tollgate.llm.common import scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    lengths = F.transform("spans", lambda s: s["last"] - s["first"] + 1)
    return found.select(
        "doc_id", "n_bytes", F.aggregate(lengths, F.lit(0), lambda a, n: a + n).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        # what is left as text; where a cut parts a character, a replacement character stands
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["last"])), ",").alias("removed_spans"),
    )


@query("op2_wrapper_text")
def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")


@query("op3_mixing_pivotal")
def op3_mixing_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query("op4_quality_rules", oracles.QUALITY_RULES)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document, item and stretch of words that match; clean documents have none."""
    return decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_simhash_golay")
def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Key of the registered query; users bring their own.
SURROGATE_KEY = b"registered query"


@query("op7_pii_surrogates")
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY, count="n_entities")


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [F.size(secrets.of_kind("base", kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"), "n_live", "n_example",
    )


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.score(docs, classifier.train(docs, table(spark, sf_dir, "labels")))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document. Each call starts a cache of its own, so that it does the whole work."""
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), scratch(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids into a new folder and reads them back."""
    path = scratch(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.documents(spark, path)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)[0]


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
