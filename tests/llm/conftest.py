from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, lang, source]) tuples, over several partitions."""

    def make(rows, parts: int = 3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def clashing(documents):
    """Null, empty, blank, long, repeated and clashing input with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    rows = [
        (1, "One text of ten words that is there to be kept."), (1, "One text of ten words that is there to be kept."),
        (2, None), (3, ""), (4, " \t\n\x0b\f\r "), (None, None), (None, "no id at all"), (5, "word"),
        (6, "long text " * 30_000), (7, "ünïcödé — 漢字 🎉   ﻿", None, None), (8, "b" * 50_000), (9, "| " * 900),
    ]
    names = ("text_hash fp fps node key a b size row copies p taken digest anchor words windows lines t stratum span label repo owner"
             " content rep mapping units kind value html_hash").split()  # fmt: skip
    return documents(rows).withColumns({n: F.lit("x") for n in names})
