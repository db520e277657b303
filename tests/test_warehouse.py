import pytest
from conftest import T0, txn
from pyspark.sql import functions as F

from tollgate.operators import dedup, quality, scoring
from tollgate.operators.features import add_features
from tollgate.plans import jobs, marts, registry, warehouse
from tollgate.schemas import TABLES, create_tables

TS = "2026-08-12 00:00:00"


@pytest.fixture()
def scored(frame):
    def make(rows, ml=None):
        features = add_features(frame(rows))
        return scoring.score(features, ml_score=None if ml is None else F.lit(ml), model_version="m")

    return make


def ids(df, column="transaction_id"):
    return sorted(r[column] for r in df.collect())


def fraud_rows():
    return [txn(f"t{i}", 10 * i, amount=90000.0, merchant_category="jewelry") for i in range(8)]


def test_load_is_idempotent(spark, scored, tmp_path):
    root, batch = str(tmp_path), scored(fraud_rows(), 0.9)
    for _ in range(2):
        warehouse.load_scored(spark, root, batch, TS)
    for table in ("stg_transactions", "transaction_scores"):
        assert warehouse.read_table(spark, root, table).count() == 8
    high = warehouse.read_table(spark, root, "transaction_scores").filter("risk_level = 'HIGH'")
    assert ids(warehouse.read_table(spark, root, "fraud_alerts")) == ids(high) != []


def test_last_write_wins(spark, frame, tmp_path):
    root = str(tmp_path)
    warehouse.upsert(spark, root, "stg_transactions", warehouse.staging_rows(frame([txn("a", amount=1.0), txn("b")])))
    warehouse.upsert(spark, root, "stg_transactions", warehouse.staging_rows(frame([txn("a", amount=2.0)])))
    rows = {r["transaction_id"]: float(r["amount"]) for r in warehouse.read_table(spark, root, "stg_transactions").collect()}
    assert rows == {"a": 2.0, "b": 100.0}


def test_key_that_moves_to_another_day_is_not_doubled(spark, frame, tmp_path):
    root, table = str(tmp_path), "stg_transactions"
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a"), txn("b", 86400)])))
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", 86400 * 3)])))
    rows = {r["transaction_id"]: str(r["event_date"]) for r in warehouse.read_table(spark, root, table).collect()}
    assert rows == {"a": "2026-08-14", "b": "2026-08-12"}


def stored(spark, root, table):
    rows = warehouse.read_table(spark, root, table).collect()
    return sorted((r["transaction_id"], str(r["event_date"]), float(r["amount"])) for r in rows)


def test_interrupted_compaction_is_finished(spark, frame, tmp_path, monkeypatch):
    root, table = str(tmp_path), "stg_transactions"
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", amount=1.0)])))
    warehouse.compact(spark, root, table)
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", amount=5.0), txn("c")])))
    with monkeypatch.context() as patch:  # a run that wrote the merged day aside and then died
        crash_at(patch, "_replace_days")
        with pytest.raises(RuntimeError):
            warehouse.compact(spark, root, table)
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("d")])))
    warehouse.compact(spark, root, table)
    assert ids(warehouse.read_table(spark, root, table)) == ["a", "c", "d"] and stored(spark, root, table)[0][2] == 5.0


def crash_at(monkeypatch, step):
    """The warehouse with one of its steps failing before it does anything."""
    def boom(*args, **kwargs):
        raise RuntimeError("crash")

    monkeypatch.setattr(warehouse, step, boom)


@pytest.mark.parametrize("step", ["_replace_days", "_drop_emptied", "_drop", "recover", "_replace", "half"])
def test_crash_at_any_step_leaves_each_key_once(spark, frame, tmp_path, monkeypatch, step):
    """Whatever step of a compaction fails, the table reads the same, at once and after the next run."""
    root, table = str(tmp_path), "stg_transactions"
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", amount=1.0), txn("b", 86400), txn("e")])))
    warehouse.compact(spark, root, table)
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", 86400 * 3, amount=2.0)])))
    expected = [("a", "2026-08-14", 2.0), ("b", "2026-08-12", 100.0), ("e", "2026-08-11", 100.0)]
    with monkeypatch.context() as patch:
        if step == "half":  # some days are installed, others not, and a day's folder is gone
            patch.setattr(warehouse, "_replace_days", lambda *args: (warehouse._drop(spark, f"{root}/{table}/event_date=2026-08-11"), 1 / 0))
        else:
            crash_at(patch, step)
        with pytest.raises((RuntimeError, ZeroDivisionError)):
            warehouse.compact(spark, root, table)
    assert stored(spark, root, table) == expected
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("c")])))
    assert stored(spark, root, table) == sorted([*expected, ("c", "2026-08-11", 100.0)])
    for _ in range(2):
        warehouse.compact(spark, root, table)
        assert stored(spark, root, table) == sorted([*expected, ("c", "2026-08-11", 100.0)])
    base = spark.read.parquet(f"{root}/{table}")
    assert base.count() == 4 and warehouse._folders(spark, f"{root}/_deltas/{table}") == []


def test_unfinished_delta_does_not_count(spark, frame, tmp_path):
    root, table = str(tmp_path), "stg_transactions"
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("a", amount=1.0)])), name="x1")
    broken = warehouse.staging_rows(frame([txn("a", amount=9.0)])).withColumn("_deleted", F.lit(False))
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/_deltas/{table}/000000000009-x2")
    assert stored(spark, root, table) == [("a", "2026-08-11", 1.0)]


def test_batch_loaded_again_replaces_its_delta(spark, frame, tmp_path):
    """Also after a later batch, which still wins; numbers go on after a compaction."""
    root, table = str(tmp_path), "stg_transactions"
    rows = lambda amount: warehouse.staging_rows(frame([txn("a", amount=amount)]))
    warehouse.upsert(spark, root, table, rows(1.0), name="s1")
    warehouse.upsert(spark, root, table, rows(2.0), name="s2")
    warehouse.upsert(spark, root, table, rows(1.5), name="s1")
    assert stored(spark, root, table) == [("a", "2026-08-11", 2.0)]
    assert warehouse._folders(spark, f"{root}/_deltas/{table}") == ["000000000001-s1", "000000000002-s2"]
    warehouse.compact(spark, root, table)
    warehouse.upsert(spark, root, table, rows(3.0), name="s3")
    assert warehouse._folders(spark, f"{root}/_deltas/{table}") == ["000000000003-s3"]
    assert stored(spark, root, table) == [("a", "2026-08-11", 3.0)]


def test_bytes_follow_the_batch(spark, frame, tmp_path):
    """A batch of one row writes one small folder and leaves the files of a large table as they are."""
    root, table = str(tmp_path), "stg_transactions"
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn(f"t{i}", 60 * i) for i in range(3000)])))
    warehouse.compact(spark, root, table)
    files = lambda: {p: (p.stat().st_mtime_ns, p.stat().st_size) for p in tmp_path.rglob("*.parquet")}
    before = files()
    warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("t5", 300, amount=7.0)])))
    after = files()
    assert all(after[p] == before[p] for p in before)
    assert sum(size for p, (_, size) in after.items() if p not in before) < 10_000
    assert warehouse.read_table(spark, root, table).count() == 3000


def test_log_is_compacted_in_time(spark, frame, tmp_path):
    root, table = str(tmp_path), "stg_transactions"
    for i in range(5):
        warehouse.upsert(spark, root, table, warehouse.staging_rows(frame([txn("same", amount=float(i)), txn(f"t{i}", i)])), compact_at=3)
        assert len(warehouse._folders(spark, f"{root}/_deltas/{table}")) < 3
    assert len(stored(spark, root, table)) == 6 and stored(spark, root, table)[0] == ("same", "2026-08-11", 4.0)


def test_greatest_version_wins_over_partitions(spark, scored, tmp_path):
    root, rows = str(tmp_path), [txn("same", amount=float(i)) for i in range(40)] + [txn("one")]
    batch = scored(rows).withColumn("offset", F.when(F.col("transaction_id") == "one", -1).otherwise((F.col("amount") * 7) % 40)).repartition(8)
    assert warehouse.load_scored(spark, root, batch, TS, version=["offset"]) == 41
    got = {r["transaction_id"]: float(r["amount"]) for r in warehouse.read_table(spark, root, "stg_transactions").collect()}
    assert got == {"same": next(float(i) for i in range(40) if i * 7 % 40 == 39), "one": 100.0}


def test_lowered_row_keeps_its_alert_unless_retracted(spark, scored, tmp_path):
    root = str(tmp_path)
    warehouse.load_scored(spark, root, scored(fraud_rows(), 0.9), TS)
    before = ids(warehouse.read_table(spark, root, "fraud_alerts"))
    assert before
    warehouse.load_scored(spark, root, scored(fraud_rows(), 0.0), TS)
    assert ids(warehouse.read_table(spark, root, "fraud_alerts")) == before
    warehouse.load_scored(spark, root, scored(fraud_rows(), 0.0), TS, retract_alerts=True)
    assert warehouse.read_table(spark, root, "fraud_alerts").isEmpty()


def test_daily_metrics_replace_days(spark, scored, tmp_path):
    root = str(tmp_path)
    rows = [txn("a"), txn("b", 86400), txn("c", 86400 + 5)]
    warehouse.load_scored(spark, root, scored(rows), TS)
    for _ in range(2):
        warehouse.refresh_daily_metrics(spark, root, "2026-08-01", "2026-08-31")
    out = {str(r["metric_date"]): r["total_transactions"] for r in warehouse.read_table(spark, root, "daily_fraud_metrics").collect()}
    assert out == {"2026-08-11": 1, "2026-08-12": 2}


def test_empty_tables(spark, tmp_path):
    scores = warehouse.read_table(spark, str(tmp_path), "transaction_scores")
    row = marts.summary(scores).first()
    assert tuple(row) == (0, 0.0, 0.0, 0, 0, 0)
    assert marts.rollup_snapshot(scores, "2026-08-11").first()["fraud_alert_rate"] == 0.0
    audit = quality.audit(warehouse.read_table(spark, str(tmp_path), "stg_transactions")).first()
    assert audit["status"] == "PASSED" and audit["total_records_checked"] == 0


def test_backfill_sees_the_past_and_can_repeat(spark, frame, tmp_path):
    rows = [txn("old", -30 * 86400), txn("near", -60), txn("in", 0), txn("after", 86400 * 2)]
    tx = frame(rows)
    for _ in range(2):
        summary = jobs.run_backfill(
            spark, str(tmp_path), tx, T0.strftime("%Y-%m-%d %H:%M:%S"), "2026-08-12", TS
        ).first()
    assert summary["num_events_backfilled"] == 1 and summary["status"] == "SUCCESS"
    day = jobs.backfill(tx, "2026-08-11 10:00:00", "2026-08-12").first()
    assert day["transaction_id"] == "in" and day["tx_count_1m"] == 1.0


def test_audit_finds_each_fault(frame):
    rows = [txn("a", amount=-100.0), txn("b", latitude=91.0), txn("b"), txn("c")]
    tx = frame(rows)
    with_null = tx.withColumn("user_id", F.when(F.col("transaction_id") != "c", F.col("user_id")))
    row = quality.audit(with_null).first()
    assert row["status"] == "FAILED" and row["issues_count"] == 4 and row["total_records_checked"] == 4
    assert row["issues"][0] == "Found 1 transactions with null or empty IDs"
    assert quality.audit(frame([txn("a")])).first()["status"] == "PASSED"


def test_dedup_keeps_the_greatest_version(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "w")], "id string, v int, p string")
    assert {tuple(r) for r in dedup.latest_per_key(df, ["id"], ["v"]).collect()} == {("a", 3, "z"), ("b", 1, "w")}


def test_ddl(spark, tmp_path):
    create_tables(spark, "fraud_dw", str(tmp_path))
    create_tables(spark, "fraud_dw", str(tmp_path))
    assert {r["tableName"] for r in spark.sql("SHOW TABLES IN fraud_dw").collect()} == set(TABLES)
    spark.sql("DROP DATABASE fraud_dw CASCADE")


RUNS = "model_version string, algorithm string, f1_score double, status string, trained_at string"


def test_registry_and_gate(spark):
    runs = spark.createDataFrame(
        [("v1", "IF", 0.9, "APPROVED", "2026-01-01"), ("v2", "IF", 0.86, "CANDIDATE", "2026-01-02"),
         ("v3", "IF", 0.84, "CANDIDATE", "2026-01-03"), ("v4", "IF", 0.3, "CANDIDATE", "2026-01-04")], RUNS,
    )
    decided = {r["model_version"]: r["final_status"] for r in registry.gate(runs).collect()}
    assert decided == {"v1": "APPROVED", "v2": "APPROVED", "v3": "REJECTED", "v4": "REJECTED"}
    assert registry.latest_approved(runs).first()["model_version"] == "v1"
    approved = registry.update_status(runs, "v2", "APPROVED")
    assert registry.latest_approved(approved).first()["model_version"] == "v2"
    assert registry.latest_approved(approved, exclude="v2").first()["model_version"] == "v1"
    again = registry.register(runs, runs.filter("model_version = 'v4'").withColumn("f1_score", F.lit(0.95)))
    assert again.count() == 4 and again.filter("f1_score = 0.95").count() == 1
    with pytest.raises(ValueError):
        registry.update_status(runs, "v1", "BEST")
    with pytest.raises(KeyError):
        registry.update_status(runs, "v9", "RETIRED")


def test_ids_are_made_unique_once(spark, frame, tmp_path, monkeypatch):
    """What the three tables are written from is read from the cache, with no shuffle of its own."""
    plans = []
    monkeypatch.setattr(warehouse, "upsert", lambda spark, root, table, batch, **kw: plans.append(batch._jdf.queryExecution().executedPlan().toString()))
    rows = scoring.score(add_features(frame([txn("a", 0), txn("b", 5)]))).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert warehouse.load_scored(spark, str(tmp_path), rows, "2026-08-11 10:00:00", version=["copy"]) == 4
    assert len(plans) == 3 and not any("Exchange" in plan.split("InMemoryRelation")[0] for plan in plans)
