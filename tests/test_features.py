import random
import re

import pytest
from conftest import T0, txn
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from naive import features

from tollgate.config import DEFAULT, FEATURE_NAMES, Config
from tollgate.operators import timeline
from tollgate.operators.features import add_features, bounded_window_features, feature_vector
from tollgate.operators.timeline import find_hot_users

SPLIT = Config(hot_user_rows=5, chunk_rows=1)
CITIES = [("Delhi", 28.6139, 77.209), ("Mumbai", 19.076, 72.8777), ("London", 51.5074, -0.1278)]


def check(frame, rows, cfg=Config(), arrival="transaction_id"):
    got = {r["transaction_id"]: r for r in add_features(frame(rows), cfg, arrival=arrival).collect()}
    assert len(got) == len(rows)
    for row in rows:
        want = features(row, rows)
        mine = {n: got[row["transaction_id"]][n] for n in FEATURE_NAMES}
        for name in FEATURE_NAMES:
            unit = 1e-4 if name in ("amount_zscore", "amount_vs_user_avg") else 1e-2
            assert mine[name] == pytest.approx(want[name], abs=unit * 1.01), (name, row, mine, want)
            if name.startswith(("tx_", "new_", "unique", "hour", "day", "amount_sum", "distance")):
                assert mine[name] == want[name], (name, row, mine, want)


def random_rows(seed: int, n: int, users=("u1", "u2", "solo")) -> list[dict]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        city, lat, lon = rng.choice(CITIES)
        user = "solo" if i == 0 else rng.choice(users[:2])
        amount = 500.0 if user == "u2" else rng.choice([0.0, 0.01, round(rng.uniform(1, 90000), 2)])
        rows.append(
            txn(
                f"t{i:05d}", rng.choice([0, 60, 300, 3600, 3600.000001, rng.uniform(0, 9000), rng.uniform(0, 400000)]),
                user_id=user, amount=amount, merchant_id=f"m{rng.randint(0, 4)}", device_id=f"d{rng.randint(0, 6)}",
                city=city, latitude=lat, longitude=lon,
            )
        )
    return rows


@pytest.mark.parametrize("cfg", [Config(), SPLIT], ids=["whole users", "split users"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_loop(frame, seed, cfg):
    check(frame, random_rows(seed, 150), cfg)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 8000), st.integers(0, 500_000), st.integers(0, 3), st.integers(0, 3)),
        min_size=1, max_size=40,
    )
)
def test_property(frame, items):
    rows = [
        txn(f"t{i:03d}", second, amount=cents / 100, merchant_id=f"m{m}", device_id=f"d{d}")
        for i, (second, cents, m, d) in enumerate(items)
    ]
    check(frame, rows)
    check(frame, rows, SPLIT)


def test_hot_user_is_split_and_whole(spark, frame):
    """One user holds nine tenths of the rows; the results are those of one big window."""
    rows = random_rows(7, 400, users=("u1", "u1"))
    tx = frame(rows)
    cfg = Config(hot_user_rows=100, chunk_rows=10)
    hot = find_hot_users(tx, cfg)
    assert [r["user_id"] for r in hot.collect()] == ["u1"]
    whole = add_features(tx).select("transaction_id", *FEATURE_NAMES)
    split = add_features(tx, cfg).select("transaction_id", *FEATURE_NAMES)
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_window_bounds(frame):
    rows = [
        txn("a", -240, amount=100.0), txn("b", -120, amount=200.0, merchant_id="m_2"),
        txn("c", -30, amount=300.0), txn("target", 0),
    ]
    out = {r["transaction_id"]: r for r in add_features(frame(rows)).collect()}["target"]
    assert (out["tx_count_1m"], out["tx_count_5m"], out["tx_count_1h"]) == (1.0, 3.0, 3.0)
    assert out["amount_sum_5m"] == 600.0 and out["unique_merchants_1h"] == 2.0
    # the lower bound is inclusive to the microsecond, the target's own instant is not seen
    edge = [txn("in", -60), txn("out", -60.000001), txn("same", 0), txn("target", 0)]
    out = {r["transaction_id"]: r for r in add_features(frame(edge)).collect()}["target"]
    assert out["tx_count_1m"] == 1.0 and out["tx_count_5m"] == 2.0


def test_first_event_is_neutral(frame):
    out = add_features(frame([txn("only", 0, amount=42.5)])).first()
    assert out["amount_zscore"] == 0.0 and out["avg_amount_1h"] == 42.5 and out["amount_vs_user_avg"] == 1.0
    assert out["new_device"] == 0.0 and out["new_location"] == 0.0 and out["distance_from_last_tx"] == 0.0
    assert out["hour_of_day"] == float(T0.hour) and out["day_of_week"] == float(T0.weekday())


def test_first_arrived_of_equal_times_is_last_place(frame):
    rows = [
        txn("a", -10, latitude=19.076, longitude=72.8777), txn("b", -10, latitude=51.5074, longitude=-0.1278),
        txn("target", 0, latitude=19.076, longitude=72.8777),
    ]
    out = {r["transaction_id"]: r for r in add_features(frame(rows)).collect()}["target"]
    assert out["distance_from_last_tx"] == 0.0


def test_sums_do_not_drift(frame):
    """Huge amounts entering and leaving a window leave no residue on later small sums."""
    rows = [txn("big", 0, amount=9_999_999_999.99), txn("x", 400, amount=0.1), txn("y", 410, amount=0.2), txn("z", 420)]
    out = {r["transaction_id"]: r for r in add_features(frame(rows)).collect()}["z"]
    assert out["amount_sum_5m"] == 0.3


def test_watermark_bound(frame):
    rows = [txn("old", -25 * 60), txn("new", -3 * 60), txn("target", 0)]
    out = {r["transaction_id"]: r for r in bounded_window_features(frame(rows)).collect()}["target"]
    assert out["tx_count_1h"] == 1.0


def test_vector_and_single_shuffle(frame):
    tx = add_features(frame(random_rows(5, 30)))
    vector = tx.select(feature_vector().alias("v")).first()["v"]
    assert len(vector) == 14 and all(x is not None for x in vector)
    plan = tx._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    assert "Python" not in plan


@pytest.mark.parametrize("cfg", [DEFAULT, Config(hot_user_rows=30, chunk_rows=2)])
def test_tasks_follow_the_rows(frame, monkeypatch, cfg):
    """Beyond the session's shuffle partitions, a task still gets no more rows."""
    tx = frame(random_rows(11, 400)).persist()
    plain = sorted(map(str, add_features(tx, cfg).collect()))
    monkeypatch.setattr(timeline, "TASK_ROWS", 10)
    tasks = -(-tx.count() // 10)
    assert tasks > timeline.shuffle_partitions(tx)
    more = add_features(tx, cfg)
    assert re.search(rf"Exchange hashpartitioning\(user_id[^)]*, {tasks}\)", more._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(str, more.collect())) == plain


def test_hot_users_share_one_step(frame):
    """The rows are read, marked and put into windows once, for the opening balances as for the rows themselves."""
    split = add_features(frame(random_rows(7, 400)).persist(), Config(hot_user_rows=30, chunk_rows=2))
    assert split.inputFiles() and all("/timeline-" in name for name in split.inputFiles())
    assert not re.search(r"\blag\(", split._jdf.queryExecution().optimizedPlan().toString())


@pytest.mark.parametrize(("asked", "used"), [("64MB", 16 << 20), ("1g", 16 << 20), ("67108864b", 16 << 20), ("8m", 8 << 20), ("16k", 16 << 10)])
def test_partitions_of_a_task_are_bounded(spark, asked, used):
    """Partitions are merged up to a size that bounds a task's memory, whatever the input; smaller ones asked for stay."""
    from tollgate import session

    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", asked)
    session.configure(own)
    assert session._bytes(own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == used


@pytest.mark.parametrize(("asked", "used"), [("128MB", 16 << 20), ("1g", 16 << 20), ("134217728b", 16 << 20), ("8m", 8 << 20)])
def test_splits_of_a_task_are_bounded(spark, asked, used):
    """A task that reads files holds what it deals to many partitions: it reads up to a size, whatever the input."""
    from tollgate import session

    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", asked)
    session.configure(own)
    assert session._bytes(own.conf.get("spark.sql.files.maxPartitionBytes")) == used
