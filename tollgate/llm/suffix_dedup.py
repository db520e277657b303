"""Exact removal of long strings that occur elsewhere, found with run-compressed indexes.

A window is a string of `length` bytes. Every byte covered by a window that also starts anywhere else is removed. To find
equal windows without moving the corpus:

1. In each window the least of the hashes of its 16-byte grams (the leftmost of equals) is its anchor. Equal windows have
   equal anchors at equal places. Neighbouring windows share an anchor; the bytes they span are the anchor's context. Only
   (anchor, digest of the context) is counted over the corpus. A context that occurs twice is all repeated; an anchor with
   one context that occurs once has nothing to do with any other. Copies, however many, are one row from here on.
2. The distinct contexts of the remaining anchors are fetched and dealt by anchor. A context keeps the windows whose
   common core some other context of the anchor has too. What is kept is packed into blocks of a few megabytes; a block
   gets a run-length Burrows-Wheeler index with sampled run ends (`rindex`), which streams the matching statistics
   of every position; windows with a match of full length are marked. A window is whole only in its own anchor's context,
   so no match is one of a text with itself.
3. An anchor whose contexts exceed `group_bytes` (a passage in very many different surroundings) is split: its contexts are
   spread over tasks, cores and then the windows around repeated cores are counted by 128-bit digests, which needs no
   group in one place and gives the same marks.
4. Marks come back to all occurrences by (anchor, digest), and documents meet their merged spans.

Matches never cross documents. Null texts are empty. Texts shorter than a window keep all. Texts of any length are worked
through in pieces. Repeated rows are each other's copies. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby
from operator import itemgetter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows, stored
from tollgate.llm.rindex import matching_statistics

GRAM = 16
PIECE = 1 << 17  # window starts worked on at a time
PLACE_BITS = np.uint64(18)  # places in a piece, below the hash in a sort key
BLOCK_BYTES = 3_000_000  # of an index
GROUP_BYTES = 4_000_000  # of an anchor's contexts in one task; beyond it the anchor is split
CELL = 16  # windows that are kept or left together

RANGES = "array<struct<first:int,last:int>>"  # of window starts, both included
OCCURRENCES = "doc_id long, text_hash long, anchor long, digest long, first int, last int, place int"
CONTEXTS = "anchor long, digest long, copies long, place int, split boolean, context binary"
MARKS = f"anchor long, digest long, ranges {RANGES}, copies long, place int, context binary"  # a mark, or a context left to do
CORES = "anchor long, digest long, cell int, core binary"
WINDOWS = "anchor long, digest long, copies long, distance int, start int, window binary"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all 16-byte grams."""
    n = len(data) - GRAM + 1
    words = np.empty(n + 8, dtype=np.uint64)
    for offset in range(8):
        part = data[offset : offset + (len(data) - offset) // 8 * 8].view("<u8")
        words[offset::8] = part[: len(words[offset::8])]
    with np.errstate(over="ignore"):
        mixed = words[:n] * np.uint64(0x9E3779B97F4A7C15) + (words[8 : n + 8] ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def anchors(data: np.ndarray, length: int):
    """(hash, first window start, last window start, place) of each anchor, for up to PIECE window starts."""
    hashes = gram_hashes(data)
    key = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    span, width = length - GRAM + 1, 1
    least = key
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    count = len(data) - length + 1
    least = np.minimum(least[:count], least[span - width : span - width + count])
    change = np.nonzero(least[1:] != least[:-1])[0]
    first = np.concatenate([[0], change + 1])
    last = np.concatenate([change, [count - 1]])
    place = (least[first] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    return hashes[place].view(np.int64), first, last, place


def occurrences(length: int):
    def run(rows):
        for doc_id, text_hash, text in rows:
            data = (text or "").encode()
            whole = np.frombuffer(data, dtype=np.uint8)
            for start in range(0, len(data) - length + 1, PIECE):
                stop = min(start + PIECE + length - 1, len(data))
                for anchor, first, last, place in zip(*(a.tolist() for a in anchors(whole[start:stop].copy(), length)), strict=True):
                    first, last, place = start + first, start + last, start + place
                    digest = xxhash.xxh64_intdigest(data[first : last + length]) - (1 << 63)
                    yield doc_id, text_hash, anchor, digest, first, last, place

    return run


def cut_contexts(length: int):
    """Contexts of a document's listed occurrences."""

    def run(rows):
        for text, wanted in rows:
            data = text.encode()
            for w in wanted:
                yield w["anchor"], w["digest"], w["copies"], w["place"] - w["first"], w["split"], data[w["first"] : w["last"] + length]

    return run


def ranges_of(starts: np.ndarray) -> list[dict]:
    """Runs of consecutive window starts."""
    if not len(starts):
        return []
    breaks = np.nonzero(np.diff(starts) > 1)[0]
    firsts, lasts = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(starts) - 1]])
    return [{"first": int(starts[a]), "last": int(starts[b])} for a, b in zip(firsts, lasts, strict=True)]


def cores_of(place: int, context: bytes, length: int):
    """(cell, core) of a context. Windows of one anchor are equal only at equal distances from it; the windows of a cell,
    CELL neighbouring distances, have a core in common. Without an equal core there is no equal window."""
    for cell in range((place - (len(context) - length)) // CELL, place // CELL + 1):
        core = place - cell * CELL
        yield cell, context[max(core, 0) : core - CELL + 1 + length]


def parts_of(cells: list[int], place: int, context: bytes, length: int):
    """(first window start, part of the context) around each run of neighbouring cells."""
    left = sorted(cells)
    while left:
        low = high = left.pop()  # the greatest distance is the first window
        while left and left[-1] == low - 1:
            low = left.pop()
        first, last = max(place - high * CELL - CELL + 1, 0), min(place - low * CELL, len(context) - length)
        yield first, context[first : last + length]


def mark_blocks(length: int):
    """Marks of contexts that come sorted by anchor; contexts of split anchors pass through."""

    def marks(block: list[tuple[int, int, int, int, bytes]]):
        found = matching_statistics([part for *_, part in block])
        for (anchor, digest, copies, first, part), lengths in zip(block, found, strict=True):
            if copies == 1:
                starts = np.nonzero(lengths[: len(part) - length + 1] >= length)[0]
                if len(starts):
                    yield anchor, digest, ranges_of(starts + first), None, None, None

    def run(rows):
        block: list = []
        size = 0
        for (anchor, split), group in groupby(rows, key=itemgetter(0, 4)):
            if split:
                for _, digest, copies, place, _, context in group:
                    yield anchor, digest, None, copies, place, context
                continue
            # a repeated row brings its contexts again
            contexts = {digest: (copies, place, context) for _, digest, copies, place, _, context in group}
            cores = {d: [(cell, xxhash.xxh64_intdigest(core)) for cell, core in cores_of(place, c, length)] for d, (_, place, c) in contexts.items()}
            owners = Counter(core for own in cores.values() for core in own)
            for digest, (copies, place, context) in contexts.items():
                shared = [core[0] for core in cores[digest] if owners[core] > 1]
                for first, part in parts_of(shared, place, context, length):
                    block.append((anchor, digest, copies, first, part))
                    size += len(part) + 1
            if size >= BLOCK_BYTES:
                yield from marks(block)
                block, size = [], 0
        if block:
            yield from marks(block)

    return run


def core_digests(length: int):
    def run(rows):
        for anchor, digest, place, context in rows:
            for cell, core in cores_of(place, context, length):
                yield anchor, digest, cell, xxhash.xxh128_digest(core)

    return run


def window_digests(length: int):
    def run(rows):
        for anchor, digest, copies, place, context, cells in rows:
            for first, part in parts_of(cells, place, context, length):
                for at in range(len(part) - length + 1):
                    yield anchor, digest, copies, place - first - at, first + at, xxhash.xxh128_digest(part[at : at + length])

    return run


def split_marks(left: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, ranges) of contexts (anchor, digest, copies, place, context) by counts of digests."""
    cores = stored(map_rows(left.select("anchor", "digest", "place", "context"), core_digests(length), CORES), "cores")
    same = ["anchor", "cell", "core"]
    shared = cores.join(cores.groupBy(same).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), same)
    cells = shared.groupBy("anchor", "digest").agg(F.collect_list("cell").alias("cells"))
    some = left.join(cells, ["anchor", "digest"]).select("anchor", "digest", "copies", "place", "context", "cells")
    windows = stored(map_rows(some, window_digests(length), WINDOWS), "windows")
    same = ["anchor", "distance", "window"]
    again = windows.groupBy(same).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    starts = windows.filter("copies = 1").join(again, same).groupBy("anchor", "digest").agg(F.collect_list("start").alias("s"))
    return starts.select("anchor", "digest", F.transform("s", lambda x: F.struct(x.alias("first"), x.alias("last"))).alias("ranges"))


def marked(seen: DataFrame, texts: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """(anchor, digest, ranges): window starts in a context, from its first, that occur elsewhere; ranges null: all."""
    where = F.struct("doc_id", "text_hash", "first", "last", "place").alias("where")
    contexts = stored(seen.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.min(where).alias("where")), "contexts")
    spread = contexts.groupBy("anchor").agg(
        F.count("*").alias("n"), F.count_if(F.col("copies") == 1).alias("n_single"),
        F.sum(F.col("where.last") - F.col("where.first") + length).alias("bytes"),
    ).filter("n > 1 and n_single > 0").select("anchor", (F.col("bytes") > group_bytes).alias("split"))
    listed = contexts.join(spread, "anchor").groupBy("where.doc_id", "where.text_hash").agg(
        F.collect_list(F.struct("anchor", "digest", "copies", "split", "where.first", "where.last", "where.place")).alias("wanted")
    ).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    met = texts.join(listed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).select("text", "wanted")
    fetched = map_rows(met, cut_contexts(length), CONTEXTS)
    # a split anchor's contexts go to tasks by their digests
    dealt = fetched.repartition("anchor", F.when(F.col("split"), F.col("digest"))).sortWithinPartitions("anchor")
    found = stored(map_rows(dealt, mark_blocks(length), MARKS), "marks")
    whole = contexts.filter("copies > 1").select("anchor", "digest", F.lit(None).cast(RANGES).alias("ranges"))
    marks = whole.unionByName(found.filter("context is null").select("anchor", "digest", "ranges"))
    left = found.filter("context is not null").select("anchor", "digest", "copies", "place", "context")
    if left.isEmpty():
        return marks
    return marks.unionByName(split_marks(left.dropDuplicates(["anchor", "digest"]), length))


def erase(length: int):
    """Removes the bytes of a text that its repeated windows cover."""

    def run(rows):
        for doc_id, text, firsts, lasts in rows:
            data = (text or "").encode()
            spans: list[list[int]] = []
            for first, last in sorted(zip(firsts, lasts, strict=True)):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], last + length)
                else:
                    spans.append([first, last + length])
            kept, at = [], 0
            for first, stop in spans:
                kept.append(data[at:first])
                at = stop
            yield doc_id, len(data), [{"first": a, "last": b - 1} for a, b in spans], b"".join(kept) + data[at:]

    return run


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (first and last byte of maximal removed runs), kept (the remaining bytes)."""
    if length < GRAM:
        raise ValueError(f"windows are of {GRAM} bytes at least")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    long_enough = texts.filter(F.octet_length("text") >= length)
    seen = stored(map_rows(long_enough, occurrences(length), OCCURRENCES, limit=8192), "occurrences")
    marks = marked(seen, long_enough, length, group_bytes)
    ranges = F.when(F.col("ranges").isNull(), F.array(F.struct("first", "last"))).otherwise(
        F.transform("ranges", lambda r: F.struct((F.col("first") + r["first"]).alias("first"), (F.col("first") + r["last"]).alias("last")))
    )
    per_doc = seen.join(marks, ["anchor", "digest"]).groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_list(ranges)).alias("ranges")
    ).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    none = F.array().cast(RANGES)
    joined = texts.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").withColumn("r", F.coalesce("ranges", none))
    return map_rows(joined.select("doc_id", "text", "r.first", "r.last"), erase(length), f"doc_id long, n_bytes long, spans {RANGES}, kept binary")
