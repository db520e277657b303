import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.config import FEATURE_NAMES, Config
from tollgate.operators import evaluate, iforest
from tollgate.plans import jobs

CFG = Config(n_trees=60, sample_size=128)
OUTLIERS = 60


@pytest.fixture(scope="module")
def table(spark):
    """2000 ordinary rows and 60 planted ones, far off in several features."""
    rng = np.random.default_rng(3)
    values = rng.normal(0, 1, (2000 + OUTLIERS, len(FEATURE_NAMES)))
    values[2000:, :6] += rng.choice([-1, 1], (OUTLIERS, 6)) * 7
    rows = [(f"t{i:05d}", *map(float, v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "transaction_id string, " + ", ".join(f"{n} double" for n in FEATURE_NAMES))
    return df.withColumn("is_fraud", F.col("transaction_id") >= "t02000").persist()


@pytest.fixture(scope="module")
def forest(table):
    return iforest.train(table, CFG)


def nodes(df):
    return [tuple(r) for r in df.orderBy("tree_id", "node_id").collect()]


def test_same_seed_same_trees_whatever_the_partitions(table, forest):
    again = iforest.grow_forest(table.repartition(7, "amount"), CFG)
    assert nodes(again) == nodes(forest.nodes)
    other = iforest.grow_forest(table, Config(n_trees=60, sample_size=128, seed=43))
    assert nodes(other) != nodes(forest.nodes)


def test_trees_are_full(forest):
    roots = forest.nodes.filter("depth = 0").collect()
    assert len(roots) == 60 and {r["size"] for r in roots} == {128}
    assert forest.nodes.agg(F.max("depth")).first()[0] <= 7


@pytest.mark.parametrize(("trees", "size"), [(3, 16), (200, 16), (5, 5000)])
def test_one_law_of_sampling(table, trees, size):
    """Every tree gets its sample, whether rows are many or few; a small table joins every tree."""
    rows = table.count()
    drawn = iforest.draw_samples(table, rows, Config(n_trees=trees, sample_size=size)).groupBy("tree_id").count().collect()
    assert len(drawn) == trees and {r["count"] for r in drawn} == {min(size, rows)}


def test_draws_are_independent(spark):
    """Shares of rows in a tree, and of rows in two trees at once, are those of independent draws."""
    wide = spark.range(40_000).select(F.concat(F.lit("r"), "id").alias("transaction_id"), *[F.lit(0.0).alias(n) for n in FEATURE_NAMES])
    cfg = Config(n_trees=4, sample_size=8000)
    rate = (8000 + 6 * 8000**0.5) / 40_000
    sets = [set() for _ in range(4)]
    for r in iforest.draw_samples(wide, 40_000, cfg).select("tree_id", "transaction_id").collect():
        sets[r["tree_id"]].add(r["transaction_id"])
    for i in range(4):
        for j in range(i):
            assert len(sets[i] & sets[j]) == pytest.approx(8000 * 8000 / 40_000, rel=0.1)
    assert rate < 0.25


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.777, 1.0])
def test_exact_quantile(spark, q):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=500), np.full(300, 0.25), [1e9]])
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert iforest.exact_quantile(frame, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)
    for rank in (0, 17, 500, 800):
        assert iforest.order_statistic(frame, "v", rank, bins=7, few=3) == np.sort(values)[rank]


def test_scores(table, forest):
    judged = iforest.with_anomaly_score(table, forest).persist()
    low, high = judged.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0.0 <= low and high <= 1.0
    share = judged.agg(F.avg((F.col("raw_decision") < 0).cast("double"))).first()[0]
    assert share == pytest.approx(CFG.contamination, abs=2 / 2060)
    pairs = judged.select(F.col("anomaly_score").alias("score"), F.col("is_fraud").alias("label"))
    assert evaluate.roc_auc(pairs).first()["roc_auc"] >= 0.9


def test_save_and_load(spark, table, forest, tmp_path):
    iforest.save(forest, f"{tmp_path}/m")
    back = iforest.load(spark, f"{tmp_path}/m")
    assert (back.version, back.offset, back.sample_size) == (forest.version, forest.offset, forest.sample_size)
    a = iforest.with_anomaly_score(table, forest).select("transaction_id", "anomaly_score")
    b = iforest.with_anomaly_score(table, back).select("transaction_id", "anomaly_score")
    assert a.exceptAll(b).isEmpty()
    with pytest.raises(FileNotFoundError):
        iforest.load(spark, f"{tmp_path}/absent")


@pytest.mark.parametrize("raw, want", [(0.4, 0.1), (0.5, 0.0), (0.0, 0.5), (-0.3, 0.8), (-0.6, 1.0)])
def test_normalize(spark, raw, want):
    assert spark.range(1).select(iforest.normalize(F.lit(raw))).first()[0] == pytest.approx(want)


def test_retrain_and_gate(spark, table, tmp_path):
    from tollgate.schemas import table_schema

    runs = spark.createDataFrame([], table_schema("model_runs"))
    labels = table.select("transaction_id", "is_fraud")
    kw = dict(model_dir=str(tmp_path), cfg=CFG)
    runs, first = jobs.retrain(spark, table, table, labels, runs, version="v1", trained_at="2026-01-01", **kw)
    assert first["status"] == "APPROVED" and first["previous_f1"] == 0.0 and first["metrics"]["roc_auc"] > 0.9
    flipped = labels.withColumn("is_fraud", F.col("transaction_id").endswith("7"))
    runs, second = jobs.retrain(spark, table, table, flipped, runs, version="v2", trained_at="2026-01-02", **kw)
    assert second["status"] == "REJECTED" and second["previous_f1"] == pytest.approx(first["candidate_f1"])
    assert {r["model_version"]: r["status"] for r in runs.collect()} == {"v1": "APPROVED", "v2": "REJECTED"}


# --- evaluation --------------------------------------------------------------------------

SCORES = [0.03, 0.11, 0.18, 0.34, 0.71, 0.77, 0.88, 0.99]


def pairs_of(spark, scores, labels):
    return spark.createDataFrame(list(zip(scores, labels)), "score double, label boolean")


def test_separable(spark):
    pairs = pairs_of(spark, SCORES, [False] * 4 + [True] * 4)
    row = evaluate.evaluate(pairs, 0.5).first()
    assert [row[c] for c in ("precision", "recall", "f1_score", "roc_auc")] == [1.0] * 4
    assert row["total_samples"] == 8 and row["positive_count"] == 4
    best = evaluate.best_threshold(pairs).first()
    assert 0.35 <= best["threshold"] <= 0.7 and best["f1_score"] == 1.0


def test_degenerate(spark):
    pairs = pairs_of(spark, [0.9, 0.1], [False, False])
    row = evaluate.evaluate(pairs, 0.5).first()
    assert row["roc_auc"] == 0.5 and row["precision"] == 0.0 and row["recall"] == 0.0 and row["f1_score"] == 0.0
    assert row["false_positive_rate"] == 0.5


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_sweep_against_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    grid = [0.35 + i * (0.5 / 49) for i in range(50)]
    scores = [float(s) for s in rng.choice(np.r_[np.round(rng.random(30), 2), grid, [0.0, 1.0]], 300)]
    labels = [bool(x) for x in rng.random(300) < 0.3]
    pairs = pairs_of(spark, scores, labels)
    pos, neg = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(pairs).first()["roc_auc"] == pytest.approx(wins, abs=5.1e-5)
    swept = evaluate.threshold_sweep(pairs).orderBy("threshold").collect()
    assert [r["threshold"] for r in swept] == grid
    for row in swept:
        assert row["true_positives"] == sum(p >= row["threshold"] for p in pos)
        assert row["false_positives"] == sum(n >= row["threshold"] for n in neg)
