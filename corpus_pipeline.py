"""A training corpus from raw documents: five stages, each one of the operators, each written before the next reads it.

Run it with `run(spark, sf_dir)`. Stage functions take (spark, docs, sf_dir); docs has the columns of `documents`
(doc_id, text, lang, source, n_chars) and so has what all but the last return. Each works for null, empty, repeated and
missing rows as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import classifier, decontaminate, mixing, pii, simhash
from tollgate.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SURROGATE_KEY = b"corpus pipeline"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    return classifier.select(docs.select(COLUMNS), classifier.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id."""
    return simhash.drop_near_duplicates(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_matches(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data; n_chars follows the text."""
    replaced = pii.replace(docs.select(COLUMNS), SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("mixing sources", mixing_weights),
]

#: SQL can't express the fitted classifier, the fingerprints or the random rounding; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
