"""Hard negatives through an inverted multi-index.

Components become integers, floor(256 x). The vectors' two halves have a codebook each, fitted by k-means on at most
SAMPLE rows (those with the least hashes of their ids); every row is indexed in the cell of its two nearest codes. A half
score of a row with code c and an anchor is at most <anchor half, c> + |anchor half| * radius(c), the radius being the largest
distance of any row with that code. The multi-sequence heap visits the cells of an anchor by falling sums of the two bounds.

Anchors search in rounds. In each, an anchor asks for its next cells, about `reach` rows, and four times as many each time. Rows are dealt by
first code in chunks of about CHUNK; a chunk scores its asked cells for every anchor and returns the best few rows per anchor and window. An anchor
stops when no unvisited cell's bound reaches the last place of its list, or the lower end of its window: its result is certified.
The first search finds the positives (rows of the anchor's label), the second their windows of negatives, for all positives of an
anchor together.

Rows with a null id, label or vector, or a null or non-finite component take no part. Of rows with one id the one with the least
label and vector does; repeated rows are one. Shorter vectors have zeros at their end. Components beyond +-2^28 stop there. Equal
scores are ordered by id. Anchors without positives, and positives without negatives in their window, give no rows. An empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows, stored

CODES, SAMPLE, TURNS = 16, 8192, 12  # codes of a half, rows that fit them, turns of k-means
CHUNK, REACH = 4096, 1024  # rows of a chunk, rows of the first round
ASKERS = 16_384  # anchors that meet a chunk in one task
MOST = 1 << 28  # absolute value of a component
ROWS = "vec_id long, label long, vector binary, cell int"
WINDOWS = "array<struct<slot:int,low:long,high:long>>"
FOUND = "array<struct<slot:int,score:long,id:long>>"
ASKED = f"vec_id long, label long, vector binary, windows {WINDOWS}, bucket int, cells array<int>, visited int"
HITS = "vec_id long, slot int, score long, id long"


def vectors(df: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(vec_id, label, q): one row per id, q the integer components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(embedding, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * 256).cast("double"))).cast("int"))
    rows = df.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull()).filter(finite)
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.struct(F.col(label).cast("long").alias("label"), whole.alias("q")).alias("row"))
    return named.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def k_means(points: np.ndarray, codes: int) -> np.ndarray:
    """Centres by Lloyd's turns from the first different points."""
    centres = np.unique(points[: 64 * codes], axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(codes, len(centres))).astype(int)].astype(np.float64)
    for _ in range(TURNS):
        near = nearest(points, centres)[0]
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point and the distance to it."""
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    near = squares.argmin(1)
    return near, np.sqrt(((points - centres[near]) ** 2).sum(1))


@dataclass
class Index:
    """Codebooks, radii by code and rows by cell: a few thousand numbers, fixed by CODES and the number of components."""

    halves: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    kind: str  # of a stored component

    def visits(self, vector: np.ndarray):
        """(bound, cell, rows) by falling bound: the multi-sequence walk over two sorted lists of half bounds."""
        cut = self.halves[0].shape[1]
        sides = []
        for centres, radii, half in zip(self.halves, self.radii, (vector[:cut], vector[cut:]), strict=True):
            bounds = centres @ half + np.sqrt(half @ half) * radii
            order = np.argsort(-bounds, kind="stable")
            sides.append((bounds[order].tolist(), order.tolist()))
        (first, rows), (second, columns) = sides
        heap, seen = [(-(first[0] + second[0]), 0, 0)], {(0, 0)}
        width = len(columns)
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = rows[i] * width + columns[j]
            yield -bound, cell, int(self.sizes[cell])
            for step in ((i + 1, j), (i, j + 1)):
                if step[0] < len(rows) and step[1] < width and step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (-(first[step[0]] + second[step[1]]), *step))


def as_array(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, dtype=kind)


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floating point where no sum can pass 2^53."""
    rows, anchor = rows.astype(np.int64), anchor.astype(np.int64)
    if float(np.abs(rows).max(initial=0)) * float(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53:
        return np.rint(rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return rows @ anchor


def build(rows: DataFrame, codes: int, sample: int) -> tuple[DataFrame, Index, int]:
    """Every row with its cell, dealt in chunks; the index; and the number of components."""
    size, most = rows.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
    size, kind = size or 0, "<i2" if (most or 0) < 1 << 15 else "<i4"
    cut = (size + 1) // 2
    zeros = F.array_repeat(F.lit(0), F.lit(size) - F.size("q"))
    padded = rows.withColumn("q", F.concat("q", zeros))
    drawn = padded.select("q", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(sample).collect()  # at most `sample` rows
    points = np.array([r["q"] for r in drawn], dtype=np.float64).reshape(len(drawn), size)
    halves = tuple(k_means(part, codes) if len(part) else np.zeros((1, part.shape[1])) for part in (points[:, :cut], points[:, cut:]))
    width = len(halves[1])

    def assign(rows):
        while held := [r for _, r in zip(range(1024), rows)]:
            q = np.array([r[2] for r in held], dtype=kind).reshape(len(held), size)
            found = [nearest(part.astype(np.float64), centres) for part, centres in zip((q[:, :cut], q[:, cut:]), halves, strict=True)]
            cells = found[0][0] * width + found[1][0]
            for (vec_id, label, _), v, cell, a, b in zip(held, q, cells.tolist(), found[0][1].tolist(), found[1][1].tolist(), strict=True):
                yield vec_id, label, v.tobytes(), cell, a, b

    celled = stored(map_rows(padded.select("vec_id", "label", "q"), assign, ROWS + ", first double, second double"), "indexed")
    radii, sizes = [np.zeros(len(c)) for c in halves], np.zeros(len(halves[0]) * width, dtype=np.int64)
    for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("first").alias("a"), F.max("second").alias("b")).collect():  # a row per cell
        sizes[r["cell"]] = r["n"]
        for side, code, far in ((0, r["cell"] // width, r["a"]), (1, r["cell"] % width, r["b"])):
            radii[side][code] = max(radii[side][code], far)
    return celled.drop("first", "second"), Index(halves, tuple(radii), sizes, kind), size


def certified(bound: float, low: int, scores: list[int], keep: int) -> bool:
    """Whether rows scoring at most `bound` can't enter a list of falling scores; ties could, by a smaller id."""
    limit = bound + 1e-6 * abs(bound) + 1e-3
    return limit < low or (len(scores) >= keep and limit < scores[-1])


def ask(index: Index, keep: int):
    """Next cells of anchors that are not certified yet, by bucket (first code); a null bucket tells where an anchor stands."""

    def run(rows):
        width = len(index.halves[1])
        for vec_id, label, vector, visited, reach, windows, found in rows:
            lists: dict[int, list] = {w["slot"]: [] for w in windows}
            for f in sorted(found, key=lambda f: (-f["score"], f["id"])):
                lists[f["slot"]].append(f["score"])
            asked: dict[int, list[int]] = {}
            number, gathered, more = visited, 0, False
            for number, (bound, cell, n) in enumerate(index.visits(as_array(vector, index.kind).astype(np.float64))):
                if number < visited:
                    continue
                if all(certified(bound, w["low"], lists[w["slot"]], keep) for w in windows):
                    break
                if gathered >= reach:
                    more = True
                    break
                if n:
                    gathered += n
                    asked.setdefault(cell // width, []).append(cell)
            # rows below a full list's last place are of no use; equal ones may have a smaller id
            raised = [{**w, "low": max(w["low"], lists[w["slot"]][-1])} if len(lists[w["slot"]]) >= keep else w for w in windows]
            for bucket, cells in asked.items():
                yield vec_id, label, vector, raised, bucket, cells, None
            yield vec_id, label, vector, windows, None, None, number if more else None

    return run


def score(kind: str, keep: int, same: bool):
    """Best rows per anchor and window of one chunk. Rows come sorted by chunk, its own rows by cell before its anchors."""

    def run(rows):
        for _, group in groupby(rows, key=lambda r: r[:3]):
            own, chunk = [], None
            for _, _, _, asks, cell, vec_id, label, vector, windows, cells in group:
                if not asks:
                    own.append((vec_id, label, cell, vector))
                    continue
                if not own:
                    break
                if chunk is None:
                    chunk = [np.array(c) for c in zip(*(r[:3] for r in own), strict=True)], np.stack([as_array(r[3], kind) for r in own])
                (ids, labels, places), matrix = chunk
                edges = zip(np.searchsorted(places, cells).tolist(), np.searchsorted(places, cells, "right").tolist(), strict=True)
                taken = np.concatenate([np.arange(a, b) for a, b in edges])
                taken = taken[(labels[taken] == label) & (ids[taken] != vec_id) if same else labels[taken] != label]
                scores = products(matrix[taken], as_array(vector, kind))
                for w in windows:
                    fits = np.flatnonzero((scores >= w["low"]) & (scores <= w["high"]))
                    if len(fits) > 4 * keep:
                        fits = fits[scores[fits] >= np.partition(scores[fits], len(fits) - keep)[len(fits) - keep]]
                    for i in fits[np.lexsort((ids[taken[fits]], -scores[fits]))[:keep]].tolist():
                        yield vec_id, w["slot"], int(scores[i]), int(ids[taken[i]])

    return run


def search(anchors: DataFrame, rows: DataFrame, index: Index, keep: int, same: bool, reach: int) -> DataFrame:
    """(vec_id, slot, score, id, place): per anchor and window, the best `keep` rows in it, certified.

    `anchors` has vec_id, label, vector and windows; rows of the anchor's label count if `same`, all others if not.
    """
    width = len(index.halves[1])
    chunks = F.get(F.array(*[F.lit(max(1, -(-int(n) // CHUNK))) for n in index.sizes.reshape(-1, width).sum(1)]), F.col("bucket"))
    spread = max(1, -(-anchors.count() // ASKERS))  # anchors of a chunk go to as many tasks as keep each one's part small
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(spread)).cast("int").alias("block")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("block")
    names = ["bucket", "chunk", "block", "asks", "cell", "vec_id", "label", "vector", "windows", "cells"]
    bucketed = rows.withColumn("bucket", F.floor(F.col("cell") / width).cast("int"))
    own = F.pmod(F.xxhash64("vec_id", F.lit(1)), chunks).cast("int").alias("chunk")
    given = bucketed.select("*", own, blocks, F.lit(False).alias("asks"), F.lit(None).cast(WINDOWS).alias("windows"), F.lit(None).cast("array<int>").alias("cells")).select(names)
    none = F.array().cast(FOUND)
    state = anchors.select("vec_id", "label", "vector", F.lit(0).alias("visited"), F.lit(reach).cast("long").alias("reach"), "windows", none.alias("found"))
    done = anchors.sparkSession.createDataFrame([], HITS + ", place int")
    while True:
        asked = stored(map_rows(state, ask(index, keep), ASKED), "asked")
        now = asked.filter("bucket is not null")
        if now.isEmpty():
            return done
        every = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
        asking = now.select("*", every, block, F.lit(True).alias("asks"), F.lit(-1).alias("cell")).select(names)
        met = given.unionByName(asking).repartition("bucket", "chunk", "block").sortWithinPartitions("bucket", "chunk", "block", "asks", "cell")
        hits = map_rows(met, score(index.kind, keep, same), HITS)
        best = Window.partitionBy("vec_id", "slot").orderBy(F.desc("score"), "id")
        done = stored(hits.unionByName(done.drop("place")).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep), "found")
        left = asked.filter("visited is not null")
        if left.isEmpty():
            return done
        lists = done.groupBy("vec_id").agg(F.collect_list(F.struct("slot", "score", "id")).alias("list")).withColumnRenamed("vec_id", "of")
        reach *= 4
        state = left.join(lists, F.col("vec_id") == F.col("of"), "left").select(
            "vec_id", "label", "vector", "visited", F.lit(reach).cast("long").alias("reach"), "windows", F.coalesce("list", none).alias("found")
        )


def hard_negatives(
    df: DataFrame, anchor: Column, label: Column | None = None, vec_id: str = "vec_id", embedding: str = "embedding", n_positives: int = 5, n_negatives: int = 10,
    low: int = 30, high: int = 90, codes: int = CODES, sample: int = SAMPLE, reach: int = REACH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its best positives,
    the best negatives with low% to high% of the positive's score. `anchor` is a condition on vec_id."""
    named = df.withColumn("_label", label if label is not None else F.col("label"))
    rows, index, size = build(stored(vectors(named, vec_id, "_label", embedding), "vectors"), codes, sample)
    anchors = rows.filter(anchor).select("vec_id", "label", "vector")
    if size == 0 or anchors.isEmpty():
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = F.array(F.struct(F.lit(0).alias("slot"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    positives = search(anchors.withColumn("windows", whole.cast(WINDOWS)), rows, index, n_positives, True, reach)
    # low * p <= 100 * s <= high * p, in integers
    ranges = positives.select(
        F.col("vec_id").alias("of"), F.col("place").alias("slot"),
        F.expr(f"({low} * score) div 100 + if(({low} * score) % 100 > 0, 1, 0)").alias("low"),
        F.expr(f"({high} * score) div 100 - if(({high} * score) % 100 < 0, 1, 0)").alias("high"),
    )
    windows = ranges.filter("low <= high").groupBy("of").agg(F.collect_list(F.struct("slot", "low", "high")).alias("windows"))
    wanting = anchors.join(windows, F.col("vec_id") == F.col("of")).select("vec_id", "label", "vector", F.col("windows").cast(WINDOWS).alias("windows"))
    negatives = search(wanting, rows, index, n_negatives, False, reach)
    of = positives.select(F.col("vec_id").alias("anchor_id"), F.col("place").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = negatives.select(F.col("vec_id").alias("anchor_id"), "slot", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(of, ["anchor_id", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
