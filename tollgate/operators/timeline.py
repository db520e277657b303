"""Per-user history as running totals over a timeline of records.

A moving range frame (`rangeBetween(-3600s, -1)`) re-aggregates its frame for every
row, so a dense user costs rows x frame. Here each transaction instead puts records on
its user's timeline: +1 at its own time and -1 one window length later. A running total
over the records strictly before t is then the value of the window [t - w, t), and one
incremental pass serves every window at once: O(n log n) however dense the user is.

A user with very many rows must not land in one task either. Users above
`Config.hot_user_rows` are cut into time chunks; a chunk starts from an *opening
balance*, a record that carries the totals of all earlier chunks (pre-aggregated per
chunk). What a chunk must know about its neighbours (last earlier visit of a merchant,
first sight of a device) also arrives as records, so no join touches the wide rows.
Most data has no such user, and then none of this appears in the plan.

An `Opening` works the same way over time: it carries what stored balances know of all
users before a moment, so that only the rows since then (and one window before) are read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import DEFAULT, Config
from tollgate.session import durable_dir

MICROS = 1_000_000
MINUTE = 60 * MICROS
DAY = 86_400 * MICROS
# Sums must not drift when amounts leave a window again: add exactly, in decimal.
EXACT = "decimal(28,8)"
#: Of a task; a row takes some 2 kB while its records are sorted.
TASK_ROWS = 150_000

_EVENT = 0
_OPENING = -1
_OPEN = "opening"  # marker of an opening's record among the rows


@dataclass(frozen=True)
class Opening:
    """What is known of users before `since` (microseconds).

    `users`: user_id, n, mean, m2 and `last`, as `position` makes it; `seen`: user_id, kind
    (a column), value and first_us, the first sight of the value.
    """

    since: int
    users: DataFrame
    seen: DataFrame


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def micros(column: str = "event_time") -> Column:
    return F.unix_micros(F.col(column))


def position(us: Column, arrival: Column, latitude: Column, longitude: Column) -> Column:
    """Smallest of (-time, arrival) = latest time, first arrived."""
    return F.struct((-us).alias("neg_us"), arrival.alias("arrival"), latitude.alias("latitude"), longitude.alias("longitude"))


def count_rows(tx: DataFrame, cfg: Config = DEFAULT) -> tuple[DataFrame | None, int]:
    """(hot users, rows): (user_id, _width) for users above the row limit, or None when there are none; and the rows of all.

    Reads two columns. The width, in microseconds, keeps the user's densest minute
    within `chunk_rows`. The table has at most rows / hot_user_rows rows.
    """
    by_user = tx.groupBy("user_id").agg(F.count("*").alias("_rows")).persist()
    is_hot = F.col("_rows") > cfg.hot_user_rows
    rows, users = by_user.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count_if(is_hot)).first()
    if users == 0:
        by_user.unpersist()
        return None, rows
    counts = by_user.filter(is_hot).select("user_id")
    per_minute = (
        tx.select("user_id", F.floor(micros() / F.lit(MINUTE)).alias("_minute"))
        .join(_small(counts, users, cfg), "user_id")
        .groupBy("user_id", "_minute")
        .agg(F.count("*").alias("_rows"))
    )
    fit = F.floor(F.lit(float(MINUTE)) * cfg.chunk_rows / F.max("_rows"))
    widths = per_minute.groupBy("user_id").agg(
        F.least(F.greatest(fit, F.lit(MICROS)), F.lit(DAY)).cast("bigint").alias("_width")
    )
    return _small(widths.persist(), users, cfg), rows


def find_hot_users(tx: DataFrame, cfg: Config = DEFAULT) -> DataFrame | None:
    return count_rows(tx, cfg)[0]


def _small(df: DataFrame, rows: int, cfg: Config) -> DataFrame:
    return F.broadcast(df) if rows <= cfg.broadcast_users else df


def chunk_of(at: str) -> Column:
    """Chunk number of a time; users that are not hot have the single chunk 0."""
    return F.expr(f"CASE WHEN _width IS NULL THEN 0L ELSE ({at} - pmod({at}, _width)) div _width END")


def with_chunks(df: DataFrame, hot: DataFrame | None, at: str = "_us") -> tuple[DataFrame, list[str]]:
    """Add the chunk column when there are hot users; return the keys to partition by."""
    if hot is None:
        return df, ["user_id"]
    chunked = df.join(hot, "user_id", "left").withColumn("_chunk", chunk_of(at))
    # the width follows from the user; as a key it lets "hot users only" be filtered early
    return chunked, ["user_id", "_width", "_chunk"]


def with_lookback(df: DataFrame, hot: DataFrame | None, seconds: int) -> tuple[DataFrame, list[str]]:
    """Chunks whose rows also see the `seconds` before the chunk.

    Rows near the end of a chunk are repeated in the chunk they reach, marked by
    `_own = false`; callers drop those after their window. Chunks are at least as wide as
    the look-back, so no row is repeated more than once.
    """
    if hot is None:
        return df.withColumn("_own", F.lit(True)), ["user_id"]
    wide = hot.withColumn("_width", F.greatest("_width", F.lit(seconds * MICROS)))
    reach = df.join(wide, "user_id", "left").withColumn("_reach", F.col("_us") + F.lit(seconds * MICROS))
    spread = reach.withColumn("_home", chunk_of("_us")).withColumn(
        "_chunk", F.explode(F.sequence(F.col("_home"), chunk_of("_reach")))
    )
    own = F.col("_home") == F.col("_chunk")
    return spread.withColumn("_own", own).drop("_home", "_reach"), ["user_id", "_chunk"]


def _neighbour_markers(base: DataFrame, column: str) -> DataFrame:
    """For each chunk of a hot user: where a value was last seen before and is next seen after."""
    edges = base.groupBy("user_id", "_width", "_chunk", column).agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last")
    )
    order = Window.partitionBy("user_id", column).orderBy("_chunk")
    around = edges.withColumn("_around", F.array(F.lag("_last").over(order), F.lead("_first").over(order)))
    return (
        around.select("user_id", "_width", "_chunk", column, F.explode("_around").alias("_us"))
        .filter(F.col("_us").isNotNull())
        .withColumn("_marker", F.lit(column))
    )


def _first_seen_markers(base: DataFrame, column: str) -> DataFrame:
    """One record in the chunk where a hot user shows a value for the first time."""
    return (
        base.groupBy("user_id", "_width", column)
        .agg(F.min("_us").alias("_us"))
        .withColumn("_chunk", chunk_of("_us"))
        .withColumn("_marker", F.lit(column))
    )


def prior_profile(
    tx: DataFrame,
    *,
    hot: DataFrame | None = None,
    count_spans: Sequence[int] = (),
    sum_spans: Sequence[int] = (),
    distinct_span: int | None = None,
    distinct_column: str = "merchant_id",
    novelty: Sequence[str] = (),
    moments: bool = False,
    last: bool = False,
    arrival: str = "transaction_id",
    opening: Opening | None = None,
    rows: int | None = None,
) -> DataFrame:
    """`tx` plus what was known about the user strictly before each row.

    Rows of the same user at the same instant do not see each other; the lower bound of
    a span (seconds) is inclusive. `tx` must be unique by transaction id. With an `opening`,
    rows before its moment count in spans only (the opening knows them already), and what
    is said of those rows themselves is of no use. With the number of `rows`, a task gets at most
    about TASK_ROWS of them, whatever the session's number of shuffle partitions.

    Adds `_us`, `_n` (all earlier rows) and, as asked: `_cnt_<span>`, `_sum_<span>` (exact
    decimal), `_distinct`, `_new_<column>`, `_mean` and `_std` (population), and `_last`
    (time, position of the latest earlier row; of equal times the first arrived).
    """
    columns = tx.columns
    base, keys = with_chunks(tx.withColumn("_us", micros()), hot)
    marked_rows = hot is not None or opening is not None
    if marked_rows:
        base = base.withColumn("_marker", F.lit(None).cast("string"))
    if hot is not None:
        dense = base.filter(F.col("_width").isNotNull())
        for column in novelty:
            sights = dense.select("user_id", "_width", column, "_us")
            if opening is not None:
                sights = sights.unionByName(_known(opening, column).join(hot, "user_id").select(*sights.columns))
            base = base.unionByName(_first_seen_markers(sights, column), allowMissingColumns=True)
        if distinct_span is not None:
            base = base.unionByName(_neighbour_markers(dense, distinct_column), allowMissingColumns=True)
    if opening is not None:
        for column in novelty:  # first sights of users that are not hot
            sights = _known(opening, column).withColumn("_marker", F.lit(column))
            if hot is not None:
                sights = sights.join(hot, "user_id", "left_anti").withColumn("_chunk", F.lit(0).cast("bigint"))
            base = base.unionByName(sights, allowMissingColumns=True)
        names = [f"_cnt_{s}" for s in count_spans] + [f"_sum_{s}" for s in sum_spans] + ["_distinct"] * (distinct_span is not None)
        base = base.unionByName(_opening_records(opening, hot, names, moments, last), allowMissingColumns=True)

    # One shuffle serves all windows below: each of them partitions by these keys at least.
    # A task sorts all it gets: beyond the session's partitions their number follows the rows, so tasks stay as they are.
    tasks = ceil((rows or 0) / TASK_ROWS)
    numbered = [tasks] if tasks > shuffle_partitions(tx) else []
    base = base.repartition(*numbered, *keys)
    for column in novelty:
        group = Window.partitionBy(*keys, column)
        first = F.min("_us").over(group)
        if hot is not None:
            marked = F.max(F.when(F.col("_marker") == column, F.col("_us"))).over(group)
            first = F.when(F.col("_width").isNull(), first).otherwise(marked)
        base = base.withColumn(f"_first_{column}", first)

    if distinct_span is not None:
        reach = distinct_span * MICROS
        visits = Window.partitionBy(*keys, distinct_column).orderBy("_us")
        before, after = F.lag("_us").over(visits), F.lead("_us").over(visits)
        if marked_rows:  # records of other kinds must not look like visits
            visits = Window.partitionBy(
                *keys, distinct_column, F.coalesce(F.col("_marker"), F.lit(distinct_column))
                == F.lit(distinct_column)
            ).orderBy("_us")
            before, after = F.lag("_us").over(visits), F.lead("_us").over(visits)
        base = base.select(
            "*",
            (before.isNull() | (before + reach < F.col("_us"))).cast("bigint").alias("_opens"),
            (after.isNull() | (after > F.col("_us") + reach)).cast("bigint").alias("_closes"),
        )
    if marked_rows:
        base = base.filter(F.coalesce("_marker", F.lit(_OPEN)) == _OPEN)
    if hot is not None:  # the opening balances and the rows themselves both start from here
        base = _stored(base)

    spans = sorted({*count_spans, *sum_spans, *([distinct_span] if distinct_span else [])})
    entries = [F.struct(F.col("_us").alias("_at"), F.lit(_EVENT).alias("_kind"))]
    entries += [
        F.struct((F.col("_us") + span * MICROS).alias("_at"), F.lit(span).alias("_kind")) for span in spans
    ]
    inlined = F.array(*entries)
    if opening is not None:
        itself = F.array(F.struct(F.col("_us").alias("_at"), F.lit(_OPENING).alias("_kind")))
        inlined = F.when(F.col("_open").isNotNull(), itself).otherwise(inlined)
    kept = [c for c in columns if c not in keys]
    firsts = [f"_first_{c}" for c in novelty]
    runs = ["_opens", "_closes"] if distinct_span is not None else []
    fixed = [c for c in keys if c != "_chunk"]
    records = base.select(
        *fixed, *(["_chunk"] if hot is not None and not spans else []),
        F.expr(f"try_cast(amount AS {EXACT})").alias("_amount"), *runs,
        F.struct("_us", *kept, *firsts).alias("_row"),
        *(["_open"] if opening is not None else []),
        F.inline(inlined),
    )
    is_event = F.col("_kind") == _EVENT
    records = records.withColumn("_row", F.when(is_event, F.col("_row")))
    if hot is not None and spans:
        # a record belongs to the chunk of its own time, not of the row it came from
        records = records.withColumn("_chunk", chunk_of("_at"))

    def leaving(span: int, value: Column) -> Column:
        return F.when(is_event, value).when(F.col("_kind") == span, -value)

    # what an opening knows already counts in spans only
    fresh = is_event if opening is None else is_event & (F.col("_row._us") >= opening.since)
    totals = {"_n": F.when(fresh, F.lit(1).cast("bigint"))}
    for span in count_spans:
        totals[f"_cnt_{span}"] = leaving(span, F.lit(1).cast("bigint"))
    for span in sum_spans:
        totals[f"_sum_{span}"] = leaving(span, F.col("_amount"))
    if distinct_span is not None:
        totals["_distinct"] = F.when(is_event, F.col("_opens")).when(
            F.col("_kind") == distinct_span, -F.col("_closes")
        )
    event_amount = F.when(fresh, F.col("_row.amount"))
    place = F.when(
        fresh, position(F.col("_row._us"), F.col(f"_row.{arrival}"), F.col("_row.latitude"), F.col("_row.longitude"))
    ) if last else None

    opens = hot is not None or opening is not None
    if hot is not None:
        records = records.unionByName(
            _opening_balances(records, totals, event_amount if moments else None, place), allowMissingColumns=True
        ).repartition(*numbered, *keys)

    earlier = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    is_opening = F.col("_kind") == _OPENING
    exprs = []
    for name, delta in totals.items():
        value = F.when(is_opening, F.col(f"_open.{name}")).otherwise(delta) if opens else delta
        exprs.append(F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(name))
    if moments:
        exprs += [F.avg(event_amount).over(earlier).alias("_mean"), F.var_pop(event_amount).over(earlier).alias("_var")]
        if opens:
            exprs += [F.max(F.col(f"_open.{c}")).over(earlier).alias(f"_{c}0") for c in ("n", "mean", "m2")]
    if last:
        value = F.when(is_opening, F.col("_open._last")).otherwise(place) if opens else place
        exprs.append(F.min(value).over(earlier).alias("_last"))

    events = records.select("*", *exprs).filter(is_event)
    out = [F.col("user_id") if c == "user_id" else F.col(f"_row.{c}").alias(c) for c in columns]
    out += [F.col("_row._us").alias("_us"), *[F.col(n) for n in totals]]
    for column in novelty:
        # no first sight recorded in this chunk = the value is known from an earlier one
        first_sight = F.coalesce(F.col("_row._us") == F.col(f"_row._first_{column}"), F.lit(False))
        out.append((first_sight & (F.col("_n") > 0)).cast("double").alias(f"_new_{column}"))
    if moments:
        out += _merged_moments(opens)
    if last:
        out.append(F.col("_last"))
    return events.select(*out)


def _stored(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder, deleted when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{durable_dir(spark, fallback=tempfile.gettempdir())}/timeline-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _known(opening: Opening, column: str) -> DataFrame:
    return opening.seen.filter(F.col("kind") == column).select("user_id", F.col("value").alias(column), F.col("first_us").alias("_us"))


def _opening_records(opening: Opening, hot: DataFrame | None, names: list[str], moments: bool, last: bool) -> DataFrame:
    """One record per user with what the opening knows, just before its moment.

    For a hot user it stands in a chunk before all that have rows, from where `_opening_balances` takes it into each.
    """
    fields = [F.col("n").cast("bigint").alias("_n")]
    fields += [F.lit(0).cast("decimal(38,8)" if n.startswith("_sum") else "bigint").alias(n) for n in names]
    if moments:
        fields += [F.col("n").cast("bigint").alias("n"), F.col("mean"), F.col("m2")]
    if last:
        fields.append(F.col("last").alias("_last"))
    users = opening.users.select("user_id", F.struct(*fields).alias("_open"), F.lit(_OPEN).alias("_marker"))
    just_before = F.lit(opening.since - 1).cast("bigint")
    if hot is None:
        return users.withColumn("_us", just_before)
    long_before = F.lit(opening.since - 2 * DAY).cast("bigint")  # chunks are at most a day wide, spans shorter
    placed = users.join(hot, "user_id", "left").withColumn("_us", F.when(F.col("_width").isNull(), just_before).otherwise(long_before))
    return placed.withColumn("_chunk", chunk_of("_us"))


def _opening_balances(
    records: DataFrame, totals: dict[str, Column], amount: Column | None, place: Column | None
) -> DataFrame:
    """One record per chunk of a hot user holding the totals of all earlier chunks, those of an opening included."""
    known = F.col("_kind") == _OPENING if "_open" in records.columns else F.lit(False)
    open_value = lambda name: F.col(f"_open.{name}") if "_open" in records.columns else F.lit(None)
    aggs = [F.coalesce(F.sum(F.when(known, open_value(name)).otherwise(delta)), F.lit(0)).alias(name) for name, delta in totals.items()]
    if amount is not None:
        mean, spread = F.avg(amount), F.var_pop(amount) * F.count(amount)
        aggs += [F.coalesce(F.max(F.when(known, open_value("mean"))), mean, F.lit(0.0)).alias("_mean"),
                 F.coalesce(F.max(F.when(known, open_value("m2"))), spread, F.lit(0.0)).alias("_m2")]
    if place is not None:
        aggs.append(F.min(F.when(known, open_value("_last")).otherwise(place) if "_open" in records.columns else place).alias("_last"))
    chunks = records.filter(F.col("_width").isNotNull()).groupBy("user_id", "_width", "_chunk").agg(*aggs)

    before = Window.partitionBy("user_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    fields = [F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in totals]
    if amount is not None:
        # Merging (count, mean, spread) pairwise adds only non-negative terms, so nothing cancels.
        chunks = chunks.select(
            "*",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
            F.coalesce(F.sum(F.col("_mean") * F.col("_n")).over(before), F.lit(0.0)).alias("_s0"),
        )
        mean0 = F.when(F.col("_n0") > 0, F.col("_s0") / F.col("_n0")).otherwise(F.lit(0.0))
        both = F.col("_n0") + F.col("_n")
        between = F.when(
            (F.col("_n0") > 0) & (F.col("_n") > 0),
            F.col("_n0") * F.col("_n") / both * F.pow(F.col("_mean") - mean0, F.lit(2.0)),
        ).otherwise(F.lit(0.0))
        chunks = chunks.withColumn("_grow", F.col("_m2") + between)
        fields += [
            F.col("_n0").alias("n"), mean0.alias("mean"),
            F.coalesce(F.sum("_grow").over(before), F.lit(0.0)).alias("m2"),
        ]
    if place is not None:
        fields.append(F.min("_last").over(before).alias("_last"))
    return chunks.select("*", F.struct(*fields).alias("_open")).select(
        "user_id", "_width", "_chunk", "_open",
        (F.col("_chunk") * F.col("_width") - 1).alias("_at"), F.lit(_OPENING).alias("_kind"),
    )


def _merged_moments(chunked: bool) -> list[Column]:
    if not chunked:
        return [F.col("_mean"), F.sqrt(F.col("_var")).alias("_std")]
    n0, mean0, m20 = (F.coalesce(F.col(f"_{c}0"), F.lit(0.0)) for c in ("n", "mean", "m2"))
    n1 = F.col("_n") - n0
    mean1, m21 = F.coalesce(F.col("_mean"), F.lit(0.0)), F.coalesce(F.col("_var"), F.lit(0.0)) * n1
    n = F.col("_n")
    mean = F.when(n > 0, (n0 * mean0 + n1 * mean1) / n)
    spread = F.when(n > 0, m20 + m21 + n0 * n1 / n * F.pow(mean1 - mean0, F.lit(2.0)))
    return [mean.alias("_mean"), F.sqrt(spread / n).alias("_std")]
