from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import T0, txn

from tollgate.config import DEFAULT, FEATURE_NAMES
from tollgate.operators import balances
from tollgate.plans import jobs

DAY = 86_400


def history(users: int = 6, rows: int = 700, seed: int = 1) -> list[dict]:
    """Events of eight days; user u0 has half of them, with many in one hour around each midnight."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        user = "u0" if rng.random() < 0.5 else f"u{rng.randrange(1, users)}"
        seconds = rng.randrange(-6 * DAY, 2 * DAY) if rng.random() < 0.6 else rng.randrange(-6, 2) * DAY + 50_400 + rng.randrange(-3600, 3600)
        out.append(txn(
            f"t{i:04d}", seconds, user_id=user, amount=round(rng.uniform(1, 900), 2), device_id=f"d{rng.randrange(12)}", city=rng.choice("PQRST"),
            merchant_id=f"m{rng.randrange(9)}", latitude=rng.uniform(-60, 60), longitude=rng.uniform(-100, 100),
        ))
    return out


def told(df) -> dict:
    return {r["transaction_id"]: tuple(r[n] for n in (*FEATURE_NAMES, "risk_score")) for r in df.collect()}


@pytest.fixture(scope="module")
def stored(spark, frame, tmp_path_factory):
    root, tx = str(tmp_path_factory.mktemp("balances")), frame(history()).cache()
    jobs.update_balances(spark, root, tx)
    return root, tx


@pytest.mark.parametrize(("start", "hot"), [("2026-08-10", False), ("2026-08-10 15:30:00", False), ("2026-08-10", True), ("2026-08-11 00:20:00", True), ("2026-08-01", False)])
def test_backfill_from_balances(spark, stored, start, hot):
    """The same rows as with the whole past, from the range, the hour before its day and the balances alone."""
    root, tx = stored
    cfg = replace(DEFAULT, hot_user_rows=20, chunk_rows=15) if hot else DEFAULT
    expected = told(jobs.backfill(tx, start, "2026-08-13"))
    opened = jobs.opening(spark, root, start[:10])
    recent = tx.filter(f"event_time >= timestamp '{start[:10]}' - interval 1 hour")
    got = told(jobs.backfill(recent, start, "2026-08-13", cfg, opening=opened))
    assert got == expected and len(got) > 50
    assert told(jobs.backfill(tx, start, "2026-08-13", cfg, opening=opened)) == expected


def test_one_shuffle_of_the_rows(spark, stored):
    """The opening joins the rows before the shuffle that all windows share."""
    root, tx = stored
    plan = jobs.backfill(tx, "2026-08-10", "2026-08-13", opening=jobs.opening(spark, root, "2026-08-10"))._jdf.queryExecution().executedPlan().toString()
    by_user = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line and "REPARTITION" in line]
    assert len(by_user) == 1 and "SortMergeJoin" not in plan and "Python" not in plan


def test_summaries_merge(spark, frame):
    """Against plain loops over all earlier rows."""
    rows = history(rows=300, seed=4)
    tx = frame(rows)
    opened = balances.opening(balances.user_days(tx), balances.sight_days(tx), "2026-08-10")
    cut = T0.replace(day=10, hour=0)
    past = [r for r in rows if r["event_time"] < cut]
    for r in opened.users.collect():
        own = [e for e in past if e["user_id"] == r["user_id"]]
        mean = sum(e["amount"] for e in own) / len(own)
        latest = min(own, key=lambda e: (-e["event_time"].timestamp(), e["transaction_id"]))
        assert r["n"] == len(own) and r["mean"] == pytest.approx(mean)
        assert r["m2"] == pytest.approx(sum((e["amount"] - mean) ** 2 for e in own))
        assert (r["last"]["arrival"], r["last"]["latitude"]) == (latest["transaction_id"], latest["latitude"])
    seen = {(r["user_id"], r["kind"], r["value"]): r["first_us"] for r in opened.seen.collect()}
    expected: dict = {}
    for e in past:
        for kind in balances.NOVELTY:
            key = e["user_id"], kind, e[kind]
            us = round(e["event_time"].timestamp() * 1e6)
            expected[key] = min(us, expected.get(key, us))
    assert seen == expected
    assert opened.since == round(cut.timestamp() * 1e6)


def test_days_are_replaced(spark, frame, tmp_path):
    """A day summarised again is replaced, other days stay; no days give an empty opening."""
    root, rows = str(tmp_path), history(rows=80, seed=7)
    jobs.update_balances(spark, root, frame(rows))
    before = {r["user_id"]: r["n"] for r in jobs.opening(spark, root, "2026-08-20").users.collect()}
    day = (T0 + timedelta(0)).date()
    again = [r for r in rows if r["event_time"].date() == day] + [txn("late", 5, user_id="u0", device_id="brand new")]
    for _ in range(2):
        jobs.update_balances(spark, root, frame(again))
    after = {r["user_id"]: r["n"] for r in jobs.opening(spark, root, "2026-08-20").users.collect()}
    assert after == {**before, "u0": before["u0"] + 1}
    assert jobs.opening(spark, root, "2000-01-01").users.isEmpty()
