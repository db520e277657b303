from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import multi_index
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, is_anchor, low: int = 30, high: int = 90) -> set[tuple]:
    """By scoring every row against every anchor; rows are (vec_id, embedding, label)."""
    rows = [(i, [int(np.floor(256 * float(x))) for x in e], n) for i, e, n in rows if e is not None and n is not None and i is not None and all(x is not None and np.isfinite(x) for x in e)]
    found = set()
    for anchor, own, label in rows:
        if not is_anchor(anchor):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(own, e, strict=False)), i, n) for i, e, n in rows if i != anchor), key=lambda s: s[:2])
        for minus, positive, n in [s for s in scored if s[2] == label][:5]:
            fits = [(i, -m) for m, i, n in scored if n != label and low * -minus <= 100 * -m <= high * -minus][:10]
            found |= {(anchor, positive, rank, i, -minus, s) for rank, (i, s) in enumerate(fits, 1)}
    return found


def collected(df) -> set[tuple]:
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_query_against_all_scores(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert collected(QUERIES["op11_hard_negatives"](spark, SF)) == plain(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize(("chunk", "reach", "askers"), [(4096, 1024, 16_384), (16, 20, 3)])
def test_clusters_ties_and_a_common_vector(spark, monkeypatch, chunk, reach, askers):
    """Clustered rows let the bounds stop early; a third of the rows are one vector; scores tie. Chunks may be small."""
    monkeypatch.setattr(multi_index, "CHUNK", chunk)
    monkeypatch.setattr(multi_index, "ASKERS", askers)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(x) for x in np.round(centres[i % 6] + 0.2 * rng.normal(size=12), 1).astype(np.float32)], int(rng.integers(0, 4))) for i in range(300)]
    rows += [(1000 + i, [0.5] * 12, i % 3) for i in range(150)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = multi_index.hard_negatives(frame, F.col("vec_id") % 9 == 0, codes=4, reach=reach)
    assert collected(got) == plain(rows, lambda i: i % 9 == 0)


def test_bounds_and_order(spark):
    """Cells come by falling bounds, every cell once, and no row scores above its cell's bound."""
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=7)], 0) for i in range(400)], VECTORS)
    celled, index, size = multi_index.build(multi_index.vectors(rows, "vec_id", "label", "embedding"), 5, 100)
    own = [(r["cell"], np.frombuffer(r["vector"], dtype=index.kind).astype(float)) for r in celled.collect()]
    assert size == 7 and index.sizes.sum() == 400
    for _, anchor in own[:10]:
        visits = list(index.visits(anchor))
        bounds = [b for b, _, _ in visits]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c, _ in visits) == list(range(25))
        by_cell = {c: b for b, c, _ in visits}
        assert all(v @ anchor <= by_cell[c] + 1e-6 for c, v in own)


def test_visits_stop(spark):
    """In separated clusters an anchor is certified before it has seen all cells."""
    rng = np.random.default_rng(4)
    centres = np.eye(8) * 3
    rows = [(i, [float(x) for x in centres[i % 8] + 0.01 * rng.normal(size=8)], 0) for i in range(800)]
    celled, index, _ = multi_index.build(multi_index.vectors(spark.createDataFrame(rows, VECTORS), "vec_id", "label", "embedding"), 4, 800)
    one = [r for r in celled.collect() if r["vec_id"] == 0][0]
    ask = multi_index.ask(index, 5)
    window = [{"slot": 0, "low": -(1 << 62), "high": 1 << 62}]
    scores = sorted((int(np.frombuffer(r["vector"], dtype=index.kind).astype(int) @ np.frombuffer(one["vector"], dtype=index.kind).astype(int)) for r in celled.collect()), reverse=True)[:5]
    found = [{"slot": 0, "score": s, "id": i} for i, s in enumerate(scores)]
    asked = [c for row in ask([(0, 0, one["vector"], 0, 10**9, window, found)]) if row[4] is not None for c in row[5]]
    assert len(asked) < (index.sizes > 0).sum()


def test_odd_rows(spark):
    """Nulls, infinite values, other lengths, huge values, repeated ids, one label alone, extra columns."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (2, [0.5, 0.6], 2), (3, [0.9], 2), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 2.0], 1), (9, [], 2), (100, [1e30, 1.0], 3), (200, [-0.1, -0.2], 4),
    ]
    frame = spark.createDataFrame(rows, VECTORS)
    for name in ("cell", "q", "row", "vector", "windows", "bucket", "_label"):
        frame = frame.withColumn(name, F.lit("x"))
    got = collected(multi_index.hard_negatives(frame, F.col("vec_id") % 100 == 0))
    expected = {(0, 1, r, n, p, s) for a, b, r, n, p, s in plain(rows[1:], lambda i: i == 0)}
    assert {g for g in got if g[0] == 0} == expected and {g[0] for g in got} <= {0, 100}
    assert multi_index.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).count() == 0
    assert multi_index.hard_negatives(frame, F.col("vec_id") == 77).count() == 0
