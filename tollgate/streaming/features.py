"""The fourteen features on a stream, from keyed state that is read and written by entry.

State per user:

* a value: the summary of everything older than watermark - 1 h (count, mean, spread, latest event), one small summary for
  each younger run of events, and the first sights of devices and cities while they are few (SIGHTS);
* a map from the number of a run to its events, at most RUN that arrived together or one batch after the other: a
  micro-batch reads the runs its events look back on, and writes those it adds;
* a map from (kind, value) to the first sight, for users with more of them, of which a micro-batch reads the entries it names.

Each call of the state is a message to the JVM and back; a user with few events needs three to five in a micro-batch, whatever
the minutes they spread over.

An event that is not late has t >= watermark, so a run that ends before watermark - 1 h lies before the longest window of
all events to come: its summary is merged into the user's and its entry removed. Hence the result equals the batch
features over what has arrived, with bounded window state. A repeated id of a user is dropped if its first arrival is in a
minute that the new events look back on and that had not ended before watermark - 1 h. State may start from stored balances (`opening`) and the events of the hour before them, as a batch
left them; the stream then goes on where the batch ended.
"""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tollgate.config import DEFAULT, FEATURE_NAMES, Config
from tollgate.functions.columns import EARTH_RADIUS_KM
from tollgate.operators.balances import NOVELTY
from tollgate.operators.features import FLAT_STD
from tollgate.operators.timeline import MICROS, MINUTE, Opening, micros
from tollgate.schemas import TXN_COLUMNS, TXN_SCHEMA

HOUR = 3600 * MICROS
_EVENT = ("us", "amount", "merchant_id", "device_id", "city", "latitude", "longitude", "transaction_id")
_SUMMARY = "n long, mean double, m2 double, last_us long, last_lat double, last_lon double"
# `counted` is false for events that an opening knows already: they count in windows only
_RUN = (
    "us array<long>, amount array<double>, merchant_id array<string>, device_id array<string>, city array<string>,"
    " latitude array<double>, longitude array<double>, transaction_id array<string>, counted array<boolean>"
)
_PAST = (
    f"{_SUMMARY}, ended_us long, spilled boolean, kinds array<string>, sights array<string>, first_us array<long>,"
    f" runs array<struct<number: long, {_SUMMARY.replace(' ', ': ').replace(',: ', ', ')}, first_minute: long, last_minute: long, held: long>>"
)
RUN, SIGHTS = 128, 64  # events in a run, first sights in a user's value
_INITIAL = (
    "user_id string, kind string, value string, us long, n long, mean double, m2 double, amount double, merchant_id string,"
    " device_id string, city string, latitude double, longitude double, transaction_id string"
)
_OUT = T.StructType(
    [T.StructField(f.name, f.dataType) for f in TXN_SCHEMA]
    + [T.StructField(n, T.DoubleType()) for n in FEATURE_NAMES if n != "amount"]
    + [T.StructField("is_late", T.BooleanType())]
)
_ROW = Row(*_OUT.fieldNames())
_LATE = [None] * (len(FEATURE_NAMES) - 1) + [True]


def _distance(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + (
        math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return EARTH_RADIUS_KM * 2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


class _Past:
    """Count, mean, spread and latest event of some of a user's events."""

    __slots__ = ("n", "mean", "m2", "last")

    def __init__(self, n: int = 0, mean: float = 0.0, m2: float = 0.0, last_us=None, last_lat=None, last_lon=None):
        self.n, self.mean, self.m2 = n, mean, m2
        self.last = None if last_us is None else (last_us, last_lat, last_lon)

    def state(self) -> tuple:
        return (self.n, self.mean, self.m2, *(self.last or (None, None, None)))

    def add(self, event: tuple) -> None:
        self.n += 1
        step = event[1] - self.mean
        self.mean += step / self.n
        self.m2 += step * (event[1] - self.mean)
        self.look_at((event[0], event[5], event[6]))

    def look_at(self, place: tuple | None) -> None:
        if place is not None and (self.last is None or place[0] > self.last[0]):  # of equal times the first arrived stays
            self.last = place

    def merge(self, other: _Past) -> None:
        """Take in another summary, of later events or of events counted elsewhere."""
        if other.n:
            n, apart = self.n + other.n, other.mean - self.mean
            self.m2 += other.m2 + apart * apart * self.n * other.n / n
            self.mean += apart * other.n / n
            self.n = n
        self.look_at(other.last)


class _Run:
    """Summary, minutes and number of events of a run."""

    __slots__ = ("past", "first", "last", "held")

    def __init__(self, past: _Past | None = None, first: int | None = None, last: int | None = None, held: int = 0):
        self.past, self.first, self.last, self.held = past or _Past(), first, last, held

    def add(self, event: tuple, counts: bool) -> None:
        minute = event[0] // MINUTE
        self.first = minute if self.first is None else min(self.first, minute)
        self.last = minute if self.last is None else max(self.last, minute)
        self.held += 1
        if counts:
            self.past.add(event)


class _User:
    """A user's value."""

    __slots__ = ("past", "ended_us", "spilled", "sights", "runs")

    def __init__(self, held: tuple | None = None):
        self.past, self.ended_us, self.spilled, self.sights, self.runs = _Past(), None, False, {}, {}
        if held is not None:
            *own, self.ended_us, self.spilled, kinds, values, first_us, runs = held
            self.past = _Past(*own)
            self.sights = dict(zip(zip(kinds, values, strict=True), first_us, strict=True))
            self.runs = {number: _Run(_Past(*summary), *rest) for number, summary, rest in ((r[0], r[1:7], r[7:]) for r in runs)}

    def state(self) -> tuple:
        runs = [(number, *r.past.state(), r.first, r.last, r.held) for number, r in sorted(self.runs.items())]
        kinds, values = [kind for kind, _ in self.sights], [value for _, value in self.sights]
        return (*self.past.state(), self.ended_us, self.spilled, kinds, values, list(self.sights.values()), runs)


class _Span:
    """Count and exact sum of the events within a time span before the current moment."""

    def __init__(self, seconds: int):
        self.length, self.events, self.units = seconds * MICROS, deque(), 0
        self.merchants: Counter = Counter()

    def add(self, event: tuple) -> None:
        units = round(event[1] * 10**8)
        self.events.append((event[0], units, event[2]))
        self.units += units
        self.merchants[event[2]] += 1

    def until(self, us: int) -> None:
        while self.events and self.events[0][0] < us - self.length:
            _, units, merchant = self.events.popleft()
            self.units -= units
            self.merchants[merchant] -= 1
            if not self.merchants[merchant]:
                del self.merchants[merchant]


def _describe(event: tuple, past: _Past, spans: dict[int, _Span], first_seen: dict[tuple[str, str], int]) -> list[float]:
    us, amount, _, device, city, lat, lon, _ = event
    std = math.sqrt(past.m2 / past.n) if past.n else 0.0
    hour = spans[3600]
    mean = hour.units / 10**8 / len(hour.events) if hour.events else amount
    new = [float(past.n > 0 and first_seen[kind, value] >= us) for kind, value in zip(NOVELTY, (device, city), strict=True)]
    return [
        round((amount - past.mean) / std, 4) if std > FLAT_STD else 0.0,
        float(len(spans[60].events)), float(len(spans[300].events)), float(len(hour.events)),
        round(spans[300].units / 10**8, 2),
        round(mean, 2),
        round(amount / mean, 4) if mean > 0 else 1.0,
        float(len(hour.merchants)),
        *new,
        round(_distance(past.last[1], past.last[2], lat, lon), 2) if past.last else 0.0,
        float(us // HOUR % 24), float((us // (24 * HOUR) + 3) % 7),  # 1970-01-01 was a Thursday
    ]


class KeyedFeatures(StatefulProcessor):
    """Feature rows of one user's new events."""

    def init(self, handle) -> None:
        self.past = handle.getValueState("past", _PAST)
        self.minutes = handle.getMapState("runs", "number long", _RUN)
        self.seen = handle.getMapState("seen", "kind string, value string", "first_us long")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        row, user = initialState, self.read_user()
        if row["kind"] == "event":
            latest = [n for n in sorted(user.runs)[-1:] if user.runs[n].held < RUN]
            self.add(user, {n: self.read_run(n) for n in latest}, [((*(row[c] for c in _EVENT),), False)])
        elif row["kind"] is not None:
            if user.spilled:
                self.seen.updateValue((row["kind"], row["value"]), (row["us"],))
                return
            user.sights[row["kind"], row["value"]] = row["us"]
        else:
            user.past.merge(_Past(row["n"], row["mean"], row["m2"], row["us"], row["latitude"], row["longitude"]))
        self.write_user(user)

    def read_user(self) -> _User:
        return _User(self.past.get())

    def write_user(self, user: _User) -> None:
        if len(user.sights) > SIGHTS:
            for pair, us in user.sights.items():
                self.seen.updateValue(pair, (us,))
            user.sights, user.spilled = {}, True
        self.past.update(user.state())

    def read_run(self, number: int) -> list[list]:
        return [list(c) for c in self.minutes.getValue((number,)) or [()] * (len(_EVENT) + 1)]

    def add(self, user: _User, entries: dict[int, list[list]], events: list[tuple]) -> None:
        """Append (event, counts) pairs, by minute and arrival: to the latest run if it is among the `entries` read and has room, then to new ones."""
        number, changed = max(user.runs, default=-1), set()
        for event, counts in sorted(events, key=lambda e: e[0][0] // MINUTE):
            if number not in entries or user.runs[number].held >= RUN:
                number += 1
                user.runs[number], entries[number] = _Run(), [[] for _ in range(len(_EVENT) + 1)]
            for column, value in zip(entries[number], (*event, counts), strict=True):
                column.append(value)
            user.runs[number].add(event, counts)
            changed.add(number)
        for number in changed:
            self.minutes.updateValue((number,), tuple(entries[number]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        arrived = sorted(rows, key=lambda r: r["_arrival"])
        if not arrived:
            return
        user = self.read_user()

        # what the new events look back on
        times = [r["_us"] for r in arrived]
        low, high = (min(times) - HOUR) // MINUTE, max(times) // MINUTE
        entries = {n: self.read_run(n) for n, run in sorted(user.runs.items()) if run.first <= high and run.last >= low}
        known = [(event[:-1], event[-1]) for entry in entries.values() for event in zip(*entry, strict=True)]
        kept = lambda minute: low <= minute <= high and (user.ended_us is None or (minute + 1) * MINUTE > user.ended_us)
        ids = {event[-1] for event, _ in known if kept(event[0] // MINUTE)}
        fresh: list[Row] = []
        for row in arrived:
            if row["transaction_id"] not in ids:
                ids.add(row["transaction_id"])
                fresh.append(row)
        events = [(r["_us"], *(r[c] for c in _EVENT[1:])) for r in fresh]
        on_time = [i for i, event in enumerate(events) if event[0] >= watermark]

        first_seen: dict[tuple[str, str], int] = {}
        for i in on_time:
            for kind, value in zip(NOVELTY, events[i][3:5], strict=True):
                first_seen[kind, value] = min(first_seen.get((kind, value), events[i][0]), events[i][0])
        for pair, us in first_seen.items():
            (before,) = (self.seen.getValue(pair) if user.spilled else None) or (user.sights.get(pair),)
            if before is not None and before <= us:
                first_seen[pair] = before
            elif user.spilled:
                self.seen.updateValue(pair, (us,))
            else:
                user.sights[pair] = us

        # known events first, so that at equal times the earlier arrival stays first
        timeline = [(event, -1, c) for event, c in known] + [(events[i], i, True) for i in on_time]
        timeline.sort(key=lambda entry: entry[0][0])
        now_known = _Past(*user.past.state())
        for _, run in sorted(user.runs.items()):
            if run.last < low:
                now_known.merge(run.past)
        spans = {s: _Span(s) for s in (60, 300, 3600)}
        described: dict[int, list] = {}
        at = 0
        while at < len(timeline):
            now, end = timeline[at][0][0], at
            while end < len(timeline) and timeline[end][0][0] == now:
                end += 1
            for span in spans.values():
                span.until(now)
            for event, i, _ in timeline[at:end]:
                if i >= 0:
                    described[i] = [*_describe(event, now_known, spans, first_seen), False]
            for event, _, counts in timeline[at:end]:
                if counts:
                    now_known.add(event)
                for span in spans.values():
                    span.add(event)
            at = end

        self.add(user, entries, [(events[i], True) for i in on_time])
        ended = watermark - HOUR
        for number in sorted(user.runs):
            if (user.runs[number].last + 1) * MINUTE <= ended:
                user.past.merge(user.runs.pop(number).past)
                self.minutes.removeKey((number,))
        user.ended_us = ended
        self.write_user(user)
        for i, row in enumerate(fresh):
            yield _ROW(*(row[c] for c in TXN_COLUMNS), *described.get(i, _LATE))

    def close(self) -> None:
        pass


def initial_rows(opening: Opening, recent: DataFrame) -> DataFrame:
    """State rows of an opening and of the events in the hour before it (transactions), by user."""
    def row(**given) -> list:
        names = [f.split()[0] for f in _INITIAL.split(", ")]
        kinds = [f.split()[1] for f in _INITIAL.split(", ")]
        return [given.get(n, F.lit(None)).cast(k).alias(n) for n, k in zip(names, kinds, strict=True)]

    own = {c: F.col(c) for c in ("user_id", "n", "mean", "m2")}
    users = opening.users.select(*row(**own, us=-F.col("last.neg_us"), latitude=F.col("last.latitude"), longitude=F.col("last.longitude")))
    seen = opening.seen.select(*row(user_id=F.col("user_id"), kind=F.col("kind"), value=F.col("value"), us=F.col("first_us")))
    hour = recent.filter((micros() >= opening.since - HOUR) & (micros() < opening.since))
    events = hour.select(*row(user_id=F.col("user_id"), kind=F.lit("event"), us=micros(), **{c: F.col(c) for c in _EVENT[1:]}))
    return users.unionByName(seen).unionByName(events)


def stream_features(
    events: DataFrame, cfg: Config = DEFAULT, arrival: str | None = None, *, watermarked: bool = False,
    opening: Opening | None = None, recent: DataFrame | None = None,
) -> DataFrame:
    """Feature rows for a stream, the first arrival of each id; late rows carry `is_late` and no features.

    As each row is scored on arrival, an event that arrives later with an earlier time does
    not change rows already emitted. `arrival` names a column that orders equal times;
    `watermarked` says that an earlier step has set the watermark already. With an `opening`, state starts from it and
    from the `recent` events of the hour before; the stream brings the events since its moment.
    """
    order = F.col(arrival) if arrival else F.col("transaction_id")
    if not watermarked:
        events = events.withWatermark("event_time", f"{cfg.watermark_minutes} minutes")
    # the event time goes on as a plain column: rows below the watermark must reach the state to be marked late
    plain = [F.timestamp_micros(micros()).alias(c) if c == "event_time" else F.col(c) for c in TXN_COLUMNS]
    keyed = events.select(*plain, micros().alias("_us"), order.alias("_arrival")).groupBy("user_id")
    first = None if opening is None else initial_rows(opening, recent).groupBy("user_id")
    return keyed.transformWithState(KeyedFeatures(), _OUT, "Append", "EventTime", initialState=first)
