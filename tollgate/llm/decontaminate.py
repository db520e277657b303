"""Benchmark decontamination by pigeonhole edit matching.

A text and an item match where a stretch of the text's words lies within the item's error budget of word edits: a fifth of
its words, rounded down. The item is cut into one piece more than it has errors, so one piece at least is intact. Pieces
are looked up exactly, as hashes of word numbers at every place of every text; around each hit the whole item is compared
with Myers' bit-parallel algorithm on words. Words are `\\w+` of the lower-cased text, so case, punctuation and spacing don't
count.

The benchmark is broadcast in blocks of about `block_bytes` of item text, however large it is; each block scans all texts.
Texts don't move. Null texts and items have no words and match nothing. Items of fewer than five words have no budget and
match exactly. Repeated items and rows each match. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import keep_rows, map_rows

WORD = re.compile(r"\w+")
RATE = 0.2
BLOCK_BYTES = 16_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)  # multiplier of the rolling hash
FOUND = "doc_id long, item_id long, distance int, item_words int, first_word int, last_word int"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Pieces:
    """Pieces of a block of items, by length and hash, with what verification needs."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int], int]] = []
        by_length: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not numbers:
                continue
            budget = math.floor(rate * len(numbers))
            edges = [len(numbers) * i // (budget + 1) for i in range(budget + 2)]
            for start, stop in zip(edges, edges[1:], strict=False):
                key = int(rolling(np.array(numbers[start:stop], dtype=np.uint64), stop - start)[-1][0])
                by_length[stop - start][key].append((len(self.items), start))
            self.items.append((item_id, numbers, budget))
        self.owners = {n: dict(d) for n, d in by_length.items()}
        self.keys = {n: np.sort(np.fromiter(d, dtype=np.uint64, count=len(d))) for n, d in by_length.items()}

    def hits(self, numbers: np.ndarray) -> dict[int, list[int]]:
        """For each item, places in the text where it would begin if the piece found there were in its place."""
        found: dict[int, list[int]] = defaultdict(list)
        if not self.keys:
            return found
        for length, hashes in enumerate(rolling(numbers, max(self.keys)), 1):
            keys = self.keys.get(length)
            if keys is None or not len(hashes):
                continue
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            for place in np.nonzero(keys[at] == hashes)[0].tolist():
                for item, start in self.owners[length][int(hashes[place])]:
                    found[item].append(place - start)
        return found

    def matches(self, text: str | None):
        """(item_id, distance, item's words, first word, last word) of the best match in each stretch with hits."""
        get = self.vocabulary.get
        numbers = [get(w, 0) for w in words_of(text)]
        for item, starts in sorted(self.hits(np.array(numbers, dtype=np.uint64)).items()):
            item_id, pattern, budget = self.items[item]
            for low, high in stretches(starts, len(pattern), budget, len(numbers)):
                distance, last = myers(pattern, numbers[low:high])
                if distance <= budget:
                    _, back = myers(pattern[::-1], numbers[low : low + last + 1][::-1], whole=distance)
                    yield item_id, distance, len(pattern), low + last - back, low + last


def rolling(numbers: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of all stretches of 1, 2, ... words."""
    found = []
    last = numbers
    with np.errstate(over="ignore"):
        for length in range(1, longest + 1):
            if length > 1:
                last = last[:-1] * BASE + numbers[length - 1 :] if len(last) else last
            found.append(last)
    return found


def stretches(starts: list[int], size: int, budget: int, n: int):
    """Merged ranges of words in which the item can lie, from the places where it would begin."""
    low = high = None
    for start in sorted(set(starts)):
        a, b = max(start - budget, 0), min(start + size + budget, n)
        if high is not None and a <= high:
            high = max(high, b)
        else:
            if high is not None:
                yield low, high
            low, high = a, b
    if high is not None:
        yield low, high


def myers(pattern: list[int], text: list[int], whole: int | None = None) -> tuple[int, int]:
    """Least distance of the pattern to a stretch of the text, and the last word of the first such stretch.

    With `whole`, the stretch starts at the text's first word and the shortest one with that distance is taken.
    """
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[int, int] = defaultdict(int)
    for i, number in enumerate(pattern):
        places[number] |= 1 << i
    plus, minus, distance = mask, 0, m
    best, at = m + 1, -1
    for j, number in enumerate(text):
        equal = places.get(number, 0)
        across = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | (~(across | plus) & mask), plus & across
        distance += bool(up & top) - bool(down & top)
        up = (up << 1 | (whole is not None)) & mask
        plus = (down << 1 & mask) | (~((equal | minus) | up) & mask)
        minus = up & (equal | minus)
        if distance < best:
            best, at = distance, j
            if whole is not None and best == whole:
                break
    return best, at


def blocks(benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES, item_id: str = "item_id", text: str = "text"):
    """Broadcasts of the items' pieces, one bounded block after the other."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for block in range(count if total else 0):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Pieces([tuple(r) for r in part], rate))


def find_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document, item and stretch that match; clean documents have none."""
    found = docs.sparkSession.createDataFrame([], FOUND)
    for pieces in blocks(benchmark, rate, block_bytes):
        found = found.unionByName(map_rows(docs.select(doc_id, text), matcher(pieces), FOUND))
    return found


def matcher(pieces):
    def run(rows):
        for key, content in rows:
            for match in pieces.value.matches(content):
                yield key, *match

    return run


def without_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that match no item, with all their columns."""
    for pieces in blocks(benchmark, rate, block_bytes):
        docs = keep_rows(docs, text, tester(pieces))
    return docs


def tester(pieces):
    return lambda: lambda content: next(pieces.value.matches(content), None) is None
