"""Tokens of two tokenizers aligned over the same bytes.

Byte offsets at which a token of both A and B ends cut a text into groups; every token of A in a group is linked to every
token of B in it. An id pair counts the documents that hold it linked.

1. Texts are shuffled by their full content, so that each distinct text is tokenised and aligned once, with its number of copies.
2. A task aligns texts in blocks. A text ends a group at every place where `pieces` cuts, so groups are made per word, and a
   worker keeps those of repeated words. A text with a word whose tokens don't give its bytes is tried as a whole,
   and has no tokens if that fails too.
3. A block numbers its own id pairs. It sends each pair once, with the documents that hold it, and keeps each text's pairs by those
   numbers. Pair counts are the sums over blocks; they return to the blocks that asked, one row per block and pair, and not per document.
4. Each block resolves its texts, and documents meet their text's measures by digest.

Null and empty texts have no tokens, nor have texts whose tokens don't give back the text's bytes: zeros and ''. Repeated rows each
count and each get their row. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tollgate.llm.common import drop, scratch, stored
from tollgate.llm.pieces import WordEncoder, byte_tokens, shared_cache, words_of

TEXTS, CHARACTERS = 4096, 4_000_000  # of a block
KEPT = 120_000  # words of a generation of a worker's cache
LARGE = 1024  # links of a group that is counted instead of listed
PAIRS = 4096  # of a stored row
TEXT_ROWS, PAIR_ROWS = 0, 1
ALIGNED = (
    "kind int, block long, digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary,"
    " number array<int>, a array<int>, b array<int>, docs array<long>"
)
RESOLVED = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def sentence_tokens(model) -> list[bytes]:
    """Bytes of each id of a sentencepiece model; control symbols have none."""

    def content(i: int) -> bytes:
        if model.is_byte(i):
            return bytes([int(model.id_to_piece(i)[3:5], 16)])
        if model.is_control(i) or model.is_unknown(i):
            return b""
        return model.id_to_piece(i).replace("▁", " ").encode()

    return [content(i) for i in range(model.get_piece_size())]


class Aligned(NamedTuple):
    """Numbers of tokens, groups and links of a word, packed; its id pairs, packed, one per link or with how often each is linked; and
    its groups as text."""

    sizes: bytes
    pairs: bytes
    times: bytes
    groups: str


NOTHING = Aligned(bytes(32), b"", b"", "")


#: Before a token's id: of the same side of a group, of a next group, of the other side, of a next word, at the start.
SIGNS = np.array([",", ";", "|", "\n", ""], dtype=object)


def sizes_of(values: list) -> np.ndarray:
    return np.fromiter(map(len, values), dtype=np.int64, count=len(values))


def counted(groups: list[tuple[list[int], list[int]]]) -> tuple[bytes, bytes]:
    """Different pairs of groups of any size, and how often each is linked."""
    pairs: Counter[int] = Counter()
    for left, right in groups:
        many = Counter(right)
        for x, n in Counter(left).items():
            for y, m in many.items():
                pairs[x << 32 | y] += n * m
    return np.array(list(pairs), dtype="<i8").tobytes(), np.array(list(pairs.values()), dtype="<i8").tobytes()


class Aligner:
    """Function from words to their alignments after a space, None where tokens don't give back the bytes.

    All words of a call are laid end to end; a group is the tokens between two offsets where tokens of both end.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path_a)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.encode_a, self.bytes_a, self.bytes_b = WordEncoder(tokenizer), byte_tokens(tokenizer), sentence_tokens(self.model)
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        self.names = np.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))], dtype=object)

    def look(self, words: list[str]) -> dict[str, Aligned | None]:
        return dict(zip(words, self(words), strict=True))

    def __call__(self, words: list[str]) -> list[Aligned | None]:
        if not words:
            return []
        packed = self.encode_a.spaced(words)
        a, n_a = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64), sizes_of(packed) // 4
        listed = self.model.encode(words, num_threads=1)
        n_b = sizes_of(listed)
        b = np.fromiter(chain.from_iterable(listed), dtype=np.int64, count=int(n_b.sum()))
        texts = [b" " + w.encode() for w in words]
        good = np.ones(len(words), dtype=bool)
        sides = (a, n_a, self.bytes_a, self.lengths_a), (b, n_b, self.bytes_b, self.lengths_b)
        whole, ends = b"".join(texts), np.cumsum(sizes_of(texts))
        for ids, sizes, tokens, lengths in sides:
            sums = np.concatenate([[0], np.cumsum(lengths[ids])])[np.cumsum(sizes)]
            if not np.array_equal(sums, ends) or b"".join([tokens[i] for i in ids.tolist()]) != whole:
                stops = np.cumsum(sizes).tolist()
                own = [ids[start:stop].tolist() for start, stop in zip([0, *stops], stops, strict=False)]
                good &= [b"".join([tokens[i] for i in of]) == text for of, text in zip(own, texts, strict=True)]
        if good.all():
            return self.align(a, n_a, b, n_b)
        out: list[Aligned | None] = [None] * len(words)
        if good.any():
            found = self.align(a[np.repeat(good, n_a)], n_a[good], b[np.repeat(good, n_b)], n_b[good])
            for place, one in zip(np.flatnonzero(good).tolist(), found, strict=True):
                out[place] = one
        return out

    def align(self, a: np.ndarray, own_a: np.ndarray, b: np.ndarray, own_b: np.ndarray) -> list[Aligned]:
        """Of the ids of some words, laid end to end, and their numbers by word."""
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        common = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a]
        common = common[np.diff(common, prepend=-1) > 0]
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        starts_b = np.cumsum(n_b) - n_b
        # the words' ends among groups and links
        last_a = np.cumsum(own_a)
        groups = group_a[last_a - 1] + 1
        links = n_a * n_b
        small = links <= LARGE

        wide = np.where(small[group_a], n_b[group_a], 0)
        first = np.repeat(starts_b[group_a] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
        packed = (np.repeat(a, wide) << 32 | b[first]).astype("<i8").tobytes()
        stops = (8 * np.cumsum(np.where(small, links, 0))[groups - 1]).tolist()
        pairs = [packed[start:stop] for start, stop in zip([0, *stops], stops, strict=False)]
        times = [b""] * len(pairs)
        for word in np.unique(np.searchsorted(groups, np.flatnonzero(~small), side="right")).tolist():
            low, high = groups[word - 1] if word else 0, groups[word]
            (from_a, to_a), (from_b, to_b) = (np.searchsorted(side, [low, high]) for side in (group_a, group_b))
            sides = (a[from_a:to_a], group_a[from_a:to_a]), (b[from_b:to_b], group_b[from_b:to_b])
            pairs[word], times[word] = counted([tuple(x[g == i].tolist() for x, g in sides) for i in range(low, high)])

        # the groups as text: each token behind its sign, words behind line ends
        both = np.concatenate([a, b])
        order = np.argsort(np.concatenate([group_a, group_b]), kind="stable")  # a's tokens of a group, then b's
        opens_a = np.concatenate([[True], group_a[1:] != group_a[:-1]])
        opens_b = np.concatenate([[True], group_b[1:] != group_b[:-1]])
        signs = np.concatenate([np.where(opens_a, 1, 0), np.where(opens_b, 2, 0)])
        signs[last_a[:-1]] = 3
        signs[0] = 4
        parts = np.empty(2 * len(both), dtype=object)
        parts[0::2], parts[1::2] = SIGNS[signs[order]], self.names[both[order]]
        texts = "".join(parts.tolist()).split("\n")

        n_links = np.diff(np.cumsum(links)[groups - 1], prepend=0)
        sizes = np.column_stack([own_a, own_b, np.diff(groups, prepend=0), n_links]).astype("<i8").tobytes()
        return list(map(Aligned._make, zip([sizes[at : at + 32] for at in range(0, len(sizes), 32)], pairs, times, texts, strict=True)))


class Block:
    """Alignments of some texts: per text its sizes and groups, per id pair its number, per text and pair how often it is linked."""

    def __init__(self, texts: list[str], copies: np.ndarray, align, cache):
        words = [words_of(t) for t in texts]
        every = set(chain.from_iterable(words))
        known = cache.look_up(every)
        number = {w: n for n, w in enumerate(every)}
        items = [known[w] for w in every]
        rows = [[*map(number.__getitem__, own)] for own in words]
        if None in items:
            for i, own in enumerate(rows):
                if any(items[n] is None for n in own):
                    (whole,) = align([texts[i]])
                    rows[i] = [] if whole is None else [len(items)]
                    items += [] if whole is None else [whole]
        sizes, pairs, weighted, groups = zip(*[i or NOTHING for i in items], strict=True) if items else ((), (), (), ())
        self.groups = [hashlib.sha256(";".join(map(groups.__getitem__, own)).encode()).hexdigest() if own else "" for own in rows]

        # how often each text has each piece
        n, base = len(texts), max(1, len(items))
        flat = np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=sum(map(len, rows)))
        keys, times = np.unique(np.repeat(np.arange(n), sizes_of(rows)) * base + flat, return_counts=True)
        text, item = np.divmod(keys, base)
        sums = np.cumsum(np.frombuffer(b"".join(sizes), dtype="<i8").reshape(-1, 4)[item] * times[:, None], axis=0)
        stops = np.searchsorted(text, np.arange(n), side="right")
        self.sizes = np.diff(np.concatenate([np.zeros((1, 4), dtype=np.int64), sums])[stops], axis=0, prepend=0)

        # how often each text has each pair
        lengths = sizes_of(pairs) // 8
        starts = np.cumsum(lengths) - lengths
        self.pairs, numbers = np.unique(np.frombuffer(b"".join(pairs), dtype="<i8"), return_inverse=True)
        weights = np.ones(int(lengths.sum()), dtype=np.int64)
        if any(weighted):
            for own, start in zip(weighted, starts.tolist(), strict=True):
                weights[start : start + len(own) // 8] = np.frombuffer(own, dtype="<i8")
        taken = lengths[item]
        places = np.repeat(starts[item] - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))
        linked = np.repeat(times, taken) * weights[places]
        width = max(1, len(self.pairs))
        keys = np.repeat(text, taken) * width + numbers[places]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
        linked = np.add.reduceat(linked[order], firsts) if len(keys) else linked
        text, pair = np.divmod(keys[firsts], width)
        self.docs = np.zeros(width if len(self.pairs) else 0, dtype=np.int64)
        np.add.at(self.docs, pair, copies[text])
        edges = np.searchsorted(text, np.arange(n + 1))
        self.links = [pack(pair[a:b], linked[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the search for reference cycles: a block makes hundreds of thousands of tuples and no cycle."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def pack(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and what belongs to them, as steps and values of the least width that holds them all."""
    steps = np.diff(pairs, prepend=0)
    wide = [next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w - (w == 8)) for x in (steps, times)]
    return bytes(wide) + steps.astype(f"<u{wide[0]}").tobytes() + times.astype(f"<u{wide[1]}").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(data) - 2) // (data[0] + data[1])
    steps = np.frombuffer(data, dtype=f"<u{data[0]}", count=n, offset=2)
    return np.cumsum(steps, dtype=np.int64), np.frombuffer(data, dtype=f"<u{data[1]}", offset=2 + n * data[0]).astype(np.int64)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The values in rows of PAIRS."""
    offsets = [*range(0, len(values), PAIRS), len(values)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def align_blocks(path_a: str, path_b: str):
    """Rows of ALIGNED from batches (digest, copies, text)."""
    schema = to_arrow_schema(T.StructType.fromDDL(ALIGNED))

    def batch(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def finish(held: list[tuple[bytes, int, str]], align, cache) -> Iterator[pa.RecordBatch]:
        with uncollected():
            block = Block([t for _, _, t in held], np.array([c for _, c, _ in held], dtype=np.int64), align, cache)
        # of distinct texts, a digest names its block
        name = xxhash.xxh64_intdigest(held[0][0]) - (1 << 63)
        sizes = {n: pa.array(block.sizes[:, i]) for i, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
        n = len(held)
        yield batch(
            n, kind=pa.array([TEXT_ROWS] * n, pa.int32()), block=pa.array([name] * n, pa.int64()), digest=pa.array([d for d, _, _ in held], pa.binary()),
            groups_sha256=pa.array(block.groups, pa.string()), links=pa.array(block.links, pa.binary()), **sizes,
        )
        if len(block.pairs):
            numbers = lists(np.arange(len(block.pairs)), pa.int32())
            n = len(numbers)
            yield batch(
                n, kind=pa.array([PAIR_ROWS] * n, pa.int32()), block=pa.array([name] * n, pa.int64()), number=numbers,
                a=lists(block.pairs >> 32, pa.int32()), b=lists(block.pairs & 0xFFFFFFFF, pa.int32()), docs=lists(block.docs, pa.int64()),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = None
        held: list[tuple[bytes, int, str]] = []
        weight = 0

        def make():
            return Aligner(path_a, path_b).look

        for part in batches:
            cache = shared_cache("aligned", path_a, path_b, make=make, most=KEPT)
            align = cache.function.__self__
            for start in range(0, part.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in part.slice(start, 256).columns), strict=True):
                    held.append(row)
                    weight += len(row[2])
                    if weight >= CHARACTERS or len(held) >= TEXTS:
                        yield from finish(held, align, cache)
                        held, weight = [], 0
        if held:
            yield from finish(held, align, cache)

    return run


def resolver():
    """Measures of a block's texts from the counts of its pairs."""
    schema = to_arrow_schema(T.StructType.fromDDL(RESOLVED))

    def run(counts: pa.Table, texts: pa.Table) -> pa.Table:
        number = counts.column("number").to_numpy()
        count, best = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
        count[number] = counts.column("count").to_numpy()
        best[number] = counts.column("best").to_numpy()
        n_best, sums = [], []
        for data in texts.column("links").to_pylist():
            pairs, times = unpack(data)
            n_best.append(int(best[pairs] @ times))
            sums.append(int(count[pairs] @ times))
        found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        columns = [found[f.name] if f.name in found else texts.column(f.name).cast(f.type) for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold a pair linked, and 1 where no other pair of the A id has more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    top = F.max("count").over(Window.partitionBy("a"))  # an A id has at most as many pairs as B has ids
    return counts.withColumn("best", (F.col("count") == top).cast("int"))


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; per pair:
    a, b, count, best. A is a byte-level tokenizers file, of which space and text are encoded; B a sentencepiece model."""
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(F.col(text), 256))
    some = docs.filter(F.length(text) > 0).select(F.col(text).alias("text"))
    distinct = some.groupBy("text").agg(F.count("*").alias("copies")).select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    aligned = distinct.mapInArrow(align_blocks(path_a, path_b), ALIGNED)
    place = scratch(spark, "aligned")
    aligned.write.option("compression", "zstd").partitionBy("kind").parquet(place)

    def written(kind: int) -> DataFrame:
        return spark.read.schema(ALIGNED).parquet(place).filter(F.col("kind") == kind)

    listed = written(PAIR_ROWS).select("block", F.inline(F.arrays_zip("number", "a", "b", "docs")))
    counts = stored(pair_counts(listed), "pair-counts")
    wanted = listed.join(counts, ["a", "b"]).select("block", "number", "count", "best")
    texts = written(TEXT_ROWS).select("block", "digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    measures = stored(wanted.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(resolver(), RESOLVED), "alignments")
    drop(spark, place)
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest.alias("own"))
    found = own.join(measures, F.col("own") == F.col("digest"), "left").select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return found, counts
