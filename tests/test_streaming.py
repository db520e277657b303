import json
import os
import random
from datetime import timedelta

import pandas as pd
import pytest
from conftest import T0, txn
from naive import features
from pyspark.sql import functions as F

from tollgate.config import FEATURE_NAMES
from tollgate.operators.features import add_features
from tollgate.plans import jobs, warehouse
from tollgate.schemas import TXN_COLUMNS, TXN_SCHEMA
from tollgate.sources.streams import sink, source, stream_session
from tollgate.streaming import pipeline, windows
from tollgate.streaming.features import stream_features

CITIES = [("Delhi", 28.6139, 77.209), ("Mumbai", 19.076, 72.8777), ("London", 51.5074, -0.1278)]


@pytest.fixture(scope="module")
def streams(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


def put(folder, number, rows):
    """One file per arrival slice, in order."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{number:03d}.parquet"
    data = pd.DataFrame(rows)[TXN_COLUMNS]
    data["event_time"] = data["event_time"].astype("datetime64[us, UTC]")
    data.to_parquet(path, index=False)
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def put_text(folder, number, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{number:03d}.txt"
    with open(path, "w") as file:
        file.write("\n".join(lines))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def one_by_one(session, folder):
    return source(session, "parquet", TXN_SCHEMA, path=folder, maxFilesPerTrigger="1")


def run(stream, root, mode="append"):
    query = sink(stream, "parquet", f"{root}/ckpt", mode=mode, every=None, path=f"{root}/out").start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def random_slices(seed, slices=4, per_slice=40):
    """Arrival slices that move forward in time, shuffled inside, with some stragglers."""
    rng = random.Random(seed)
    out, n = [], 0
    for s in range(slices):
        rows = []
        for _ in range(per_slice):
            city, lat, lon = rng.choice(CITIES)
            at = s * 1500 + rng.choice([rng.uniform(0, 1500), rng.randint(0, 25) * 60, rng.uniform(-2500, 0)])
            rows.append(txn(
                f"t{n:04d}", round(at, 3), user_id=rng.choice(["u1", "u2"]), amount=round(rng.uniform(0, 5000), 2),
                merchant_id=f"m{rng.randint(0, 4)}", device_id=f"d{rng.randint(0, 9)}", city=city, latitude=lat, longitude=lon,
            ))
            n += 1
        out.append(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_state_equals_loop_over_what_has_arrived(streams, tmp_path, seed):
    slices = random_slices(seed)
    for i, rows in enumerate(slices):
        put(f"{tmp_path}/in", i, rows)
    got = {r["transaction_id"]: r for r in run(stream_features(one_by_one(streams, f"{tmp_path}/in")), tmp_path).collect()}

    known, watermark, late, newest = [], None, set(), None
    for rows in slices:
        fresh = [r for r in rows if watermark is None or r["event_time"] >= watermark]
        late |= {r["transaction_id"] for r in rows} - {r["transaction_id"] for r in fresh}
        known += fresh
        for row in fresh:
            want = features(row, known)
            mine = got[row["transaction_id"]]
            for name in FEATURE_NAMES:
                assert mine[name] == pytest.approx(want[name], abs=1.01e-4 if "zscore" in name else 1e-9), (name, row)
        newest = max([r["event_time"] for r in rows] + ([newest] if newest else []))
        watermark = newest - timedelta(minutes=10)
    assert late and late == {t for t, r in got.items() if r["is_late"]}
    assert len(got) == sum(map(len, slices))
    assert all(got[t]["amount_zscore"] is None for t in late)


@pytest.mark.parametrize("seed", [3, 4])
def test_stream_goes_on_where_the_batch_ended(spark, streams, frame, tmp_path, seed):
    """Five arrivals after a day of batch history, one user with a third of all rows: as the batch features of everything."""
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        city, lat, lon = rng.choice(CITIES)
        # much of it within the hours around midnight, where the stream takes over
        seconds = rng.choice([rng.uniform(-36_000, 65_000), rng.uniform(46_000, 56_000), rng.randrange(47_000, 53_000, 60)])
        rows.append(txn(
            f"t{i:04d}", round(seconds, 3), user_id="hot" if rng.random() < 0.34 else f"u{rng.randrange(8)}", amount=round(rng.uniform(1, 5000), 2),
            merchant_id=f"m{rng.randrange(5)}", device_id=f"d{rng.randrange(9)}", city=city, latitude=lat, longitude=lon,
        ))
    everything = frame(rows)
    midnight = T0.replace(day=12, hour=0)
    past = everything.filter(F.col("event_time") < F.lit(midnight))
    jobs.update_balances(spark, str(tmp_path), past)
    coming = sorted((r for r in rows if r["event_time"] >= midnight), key=lambda r: r["event_time"])
    for number in range(5):
        put(f"{tmp_path}/in", number, coming[len(coming) * number // 5 : len(coming) * (number + 1) // 5])
    stream = stream_features(one_by_one(streams, f"{tmp_path}/in"), opening=jobs.opening(streams, str(tmp_path), "2026-08-12"), recent=past)
    got = {r["transaction_id"]: r for r in run(stream, tmp_path).collect()}
    want = {r["transaction_id"]: r for r in add_features(everything).collect()}
    assert set(got) == {r["transaction_id"] for r in coming} and not any(r["is_late"] for r in got.values())
    assert sum(r["user_id"] == "hot" for r in rows) > 120
    for tid, mine in got.items():
        for name in FEATURE_NAMES:
            assert mine[name] == pytest.approx(want[tid][name], abs=1.01e-4 if "zscore" in name else 1e-9), (name, tid)


def test_only_the_minutes_needed_are_read(monkeypatch):
    """Old minutes are merged into the user's summary; an event reads and writes its own hour, not all that is kept."""
    from pyspark.sql import Row

    from tollgate.streaming import features as keyed

    class State(dict):
        def __init__(self):
            super().__init__()
            self.reads, self.writes = 0, 0

        def exists(self):
            return "v" in self

        def get(self, key="v", default=None):
            return dict.get(self, key, default)

        def update(self, value):
            self["v"] = value

        def getValue(self, key):
            self.reads += 1
            return dict.get(self, key)

        def updateValue(self, key, value):
            self.writes += 1
            self[key] = value

        def removeKey(self, key):
            del self[key]

    processor = keyed.KeyedFeatures()
    processor.past, processor.minutes, processor.seen = State(), State(), State()
    clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: self.ms})()
    fields = ["_us", "_arrival", *TXN_COLUMNS]
    for n in range(300):  # one event a minute, one micro-batch each
        row = txn(f"t{n:03d}", 60 * n)
        us = round(row["event_time"].timestamp() * 1e6)
        clock.ms = us // 1000 - 600_000
        processor.minutes.reads = processor.minutes.writes = 0
        (out,) = processor.handleInputRows(("u1",), iter([Row(*fields)(us, row["transaction_id"], *(row[c] for c in TXN_COLUMNS))]), clock)
        assert out["tx_count_1h"] == min(n, 60) and out["is_late"] is False
        assert processor.minutes.writes == 1 and processor.minutes.reads <= 62 and len(processor.minutes) <= 73
    assert processor.past["v"][0] + sum(m[1] for m in processor.past["v"][-1]) == 300


@pytest.mark.parametrize(("run", "sights"), [(128, 64), (3, 2)])
def test_calls_of_the_state(monkeypatch, run, sights):
    """A user with few events needs few calls, whatever the minutes; small runs and first sights in the map give the same."""
    from pyspark.sql import Row

    from tollgate.streaming import features as keyed

    class State(dict):
        calls = 0

        def exists(self):
            State.calls += 1
            return "v" in self

        def get(self, key="v"):
            return self.getValue(key)

        def update(self, value):
            self.updateValue("v", value)

        def getValue(self, key):
            State.calls += 1
            return dict.get(self, key)

        def updateValue(self, key, value):
            State.calls += 1
            self[key] = tuple(list(v) if isinstance(v, list) else v for v in value)

        def removeKey(self, key):
            State.calls += 1
            del self[key]

    def answers() -> tuple[list, list]:
        processor, rng, rows, calls = keyed.KeyedFeatures(), random.Random(8), [], []
        processor.past, processor.minutes, processor.seen = State(), State(), State()
        clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: self.ms})()
        fields = ["_us", "_arrival", *TXN_COLUMNS]
        for batch in range(6):  # twenty minutes each, ten hours apart; some ids twice, some rows at one time, some late
            given = [txn(f"t{batch}-{rng.randint(0, 17)}", 36_000 * batch + 60 * rng.randint(-700 if batch == 3 else 0, 59), amount=rng.randint(1, 999) / 4,
                         device_id=f"d{rng.randint(0, 4)}", city=rng.choice("ABC"), latitude=float(rng.randint(0, 50))) for _ in range(20)]
            stamped = [Row(*fields)(round(r["event_time"].timestamp() * 1e6), n, *(r[c] for c in TXN_COLUMNS)) for n, r in enumerate(given)]
            clock.ms = 0 if not batch else round((T0 + timedelta(seconds=36_000 * (batch - 1) + 2940)).timestamp() * 1000)
            State.calls = 0
            rows += [tuple(r) for r in processor.handleInputRows(("u1",), iter(stamped), clock)]
            calls.append(State.calls)
        return rows, calls

    want, calls = answers()
    assert max(calls) <= 5 and any(r[-1] for r in want) and len(want) < 120
    monkeypatch.setattr(keyed, "RUN", run)
    monkeypatch.setattr(keyed, "SIGHTS", sights)
    assert answers()[0] == want


def test_sliding_windows_equal_batch(spark, streams, tmp_path):
    slices = random_slices(5)
    for i, rows in enumerate(slices):
        put(f"{tmp_path}/in", i, rows)
    # no lateness limit reached: everything counts, as in batch
    from tollgate.config import Config

    wide = Config(watermark_minutes=60 * 24)
    slices.append([txn("end", 86400 * 3, user_id="zz")])
    put(f"{tmp_path}/in", 9, slices[-1])
    streamed = run(windows.sliding_aggregates(one_by_one(streams, f"{tmp_path}/in"), exact_merchants=True, cfg=wide), tmp_path)
    batch = windows.sliding_aggregates(spark.read.schema(TXN_SCHEMA).parquet(f"{tmp_path}/in"), exact_merchants=True)
    batch = batch.filter(F.col("user_id") != "zz")
    assert streamed.count() == batch.count() > 100
    assert streamed.exceptAll(batch).isEmpty()


def test_dedup_first_arrival_wins(streams, tmp_path):
    put(f"{tmp_path}/in", 0, [txn("a", 0, amount=1.0), txn("b", 1)])
    put(f"{tmp_path}/in", 1, [txn("a", 5, amount=2.0), txn("c", 9)])
    out = run(windows.dedup(one_by_one(streams, f"{tmp_path}/in")), tmp_path)
    assert sorted((r["transaction_id"], r["amount"]) for r in out.collect()) == [("a", 1.0), ("b", 100.0), ("c", 100.0)]


def test_session_windows(streams, tmp_path):
    put(f"{tmp_path}/in", 0, [txn(f"a{i}", i) for i in range(12)] + [txn("b", 300)])
    put(f"{tmp_path}/in", 1, [txn("end", 86400)])
    out = run(windows.burst_sessions(one_by_one(streams, f"{tmp_path}/in")), tmp_path)
    assert sorted(r["tx_count"] for r in out.collect()) == [1, 12]


def message(row):
    return json.dumps({**row, "event_time": row["event_time"].isoformat()})


def test_pipeline_resumes_without_loss_or_repeats(spark, streams, tmp_path):
    folder, root = f"{tmp_path}/in", f"{tmp_path}/wh"
    rows = [txn(f"t{i}", 10 * i, amount=90000.0) for i in range(6)]
    raw = lambda: source(streams, "text", path=folder, maxFilesPerTrigger="1")

    def score_all():
        pipeline.start_scoring(
            raw(), root, f"{tmp_path}/ckpt", run_ts="2026-08-12 00:00:00", ml_score=F.lit(0.9), model_version="m", every=None
        ).awaitTermination()

    put_text(folder, 0, [message(r) for r in rows[:3]] + ["{broken"])
    score_all()
    put_text(folder, 1, [message(r) for r in rows[2:]] + [message({**rows[0], "amount": -1})])

    # the sink fails once the batch is partly written; the query stops
    real, calls = warehouse.upsert, []

    def failing(spark_, root_, table, *args, **kwargs):
        calls.append(table)
        if table == "fraud_alerts":
            raise RuntimeError("sink down")
        return real(spark_, root_, table, *args, **kwargs)

    warehouse.upsert = failing
    try:
        with pytest.raises(Exception, match="sink down"):
            score_all()
    finally:
        warehouse.upsert = real
    score_all()  # resumes at the failed batch

    table = warehouse.read_table(spark, root, "transaction_scores")
    stored = {r["transaction_id"]: r for r in table.collect()}
    assert sorted(stored) == [r["transaction_id"] for r in rows] and table.count() == 6
    assert stored["t5"]["risk_level"] == "HIGH"
    high = {t for t, r in stored.items() if r["risk_level"] == "HIGH"}
    alerts = [r["transaction_id"] for r in warehouse.read_table(spark, root, "fraud_alerts").collect()]
    assert sorted(alerts) == sorted(high) != []

    for _ in range(2):
        pipeline.start_dead_letters(raw(), root, f"{tmp_path}/ckpt_dlq", every=None).awaitTermination()
    letters = spark.read.parquet(f"{root}/dead_letters")
    assert sorted(r["error_type"] for r in letters.collect()) == ["amount", "payload"]


def test_late_messages_and_copies_are_kept_apart(spark, streams, tmp_path):
    """A late message in every batch reaches its folder; copies of an id count once, the first arrival."""
    folder, root = f"{tmp_path}/in", f"{tmp_path}/wh"
    slices = [
        [txn("a0", 0), txn("a1", 60), txn("a1", 60, amount=7.0)],
        [txn("b0", 3600), txn("late1", -3600), txn("a1", 60, amount=9.0)],
        [txn("c0", 7200), txn("late2", 600), txn("b0", 3600, amount=9.0)],
        [txn("d0", 10800), txn("late3", 3000, user_id="u2")],
    ]
    for number, rows in enumerate(slices):
        put_text(folder, number, [message(r) for r in rows])
    raw = source(streams, "text", path=folder, maxFilesPerTrigger="1")
    pipeline.start_scoring(raw, root, f"{tmp_path}/ckpt", every=None).awaitTermination()
    scores = warehouse.read_table(spark, root, "transaction_scores").collect()
    assert sorted(r["transaction_id"] for r in scores) == ["a0", "a1", "b0", "c0", "d0"]
    assert {r["transaction_id"]: float(r["amount"]) for r in scores}["a1"] == 100.0
    assert len({r["scored_at"] for r in scores}) >= 1 and all(r["scored_at"] for r in scores)
    late = [r["transaction_id"] for r in spark.read.parquet(f"{root}/late_events").collect()]
    assert sorted(late) == ["late1", "late2", "late3"]


def test_forest_scores_the_stream(spark, streams, frame, tmp_path):
    from tollgate.config import Config
    from tollgate.operators import iforest
    from tollgate.operators.features import add_features

    rows = random_slices(8, slices=1, per_slice=80)[0]
    known = add_features(frame(rows))
    forest = iforest.train(known, Config(n_trees=10, sample_size=32), "f1")
    put_text(f"{tmp_path}/in", 0, [message(r) for r in rows])
    raw = source(streams, "text", path=f"{tmp_path}/in")
    pipeline.start_scoring(
        raw, f"{tmp_path}/wh", f"{tmp_path}/ckpt", run_ts="2026-08-12 00:00:00", forest=forest, every=None
    ).awaitTermination()
    want = {r["transaction_id"]: r["anomaly_score"] for r in iforest.with_anomaly_score(known, forest).collect()}
    got = warehouse.read_table(spark, f"{tmp_path}/wh", "transaction_scores").collect()
    assert len(got) == len(rows) and {r["model_version"] for r in got} == {"f1"}
    assert all(float(r["ml_anomaly_score"]) == pytest.approx(want[r["transaction_id"]], abs=5.1e-5) for r in got)


def test_late_events_of_a_table(spark):
    rows = [(i, T0 + timedelta(seconds=s)) for i, s in enumerate([0, 700, 50, 99, 101, 3000, 2399.5, 2401])]
    df = spark.createDataFrame(rows, "seq long, event_time timestamp")
    for block in (1, 3, 1000):
        late = windows.late_events(df, "seq", block_rows=block)
        assert {r["seq"]: r["seconds_late"] for r in late.collect()} == {2: 50.0, 3: 1.0, 6: 0.5}
