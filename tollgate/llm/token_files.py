"""Token ids of a corpus as entropy-coded files.

`write` encodes every text, appends the end id and writes all ids in ascending order of document into a folder:

* `table`: (id, frequency), the shared frequency table, counted over the whole corpus; at most one row per id in use.
* `blocks`: a row per block with its coded ids (`rans`), its place (part, block, first id of the part) and its directory (ids and
  sizes of its documents, and whether the first one goes on from the block before). A block ends after `block_ids` ids or
  `block_docs` documents; a long document runs through several blocks.

Parts are ranges of documents that Spark sorted; blocks are coded and decoded independently of each other, in as many tasks as there are
parts and files. The folder is a Parquet table, so Spark's commit makes a lost executor's part appear once or not at all, on
any store Spark can write.

`read_pieces` decodes the blocks and gives a row per document and block with checksum; `documents` joins them to a row per document;
`read_ids` gives the ids themselves, decoding from the checkpoint before them.

Null texts are empty: they have the end id alone. Null document ids come first. Rows with one document id stand in the order of
their texts' hashes; repeated rows are written as often as they occur. An empty table gives a folder without blocks.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm import rans
from tollgate.llm.common import drop, map_rows, scratch, stored
from tollgate.llm.pieces import IdCache, WordEncoder, has_odd_blanks, split_texts

BLOCK_IDS, BLOCK_DOCS = 1 << 18, 1 << 14
TEXTS, CHARACTERS = 4096, 4_000_000  # encoded at a time: the more, the fewer different words are looked up
ENCODERS: dict[tuple[str, str], tuple[WordEncoder, IdCache | None]] = {}  # of the Python worker
TOKENS = "doc_id long, tie long, n_tokens long, ids binary"
BLOCKS = (
    "part int, block int, first long, n_ids int, first_doc long, continued boolean, doc_ids array<long>, sizes array<int>, payload binary"
)
PIECES = "part int, doc long, doc_id long, whole boolean, first long, n long, crc long"


def cuts_at_spaces(path: str) -> bool:
    """Whether the tokenizer's file is of the kind whose texts may be encoded in pieces."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    split = parts["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    flags = ("single_word", "lstrip", "rstrip")
    return plain and parts["normalizer"] is None and not any(t[f] or " " in t["content"] for t in parts["added_tokens"] for f in flags)


def text_encoder(path: str, width: str):
    """Function from texts to their ids as packed integers of `width`."""
    from tokenizers import Tokenizer

    if (path, width) not in ENCODERS:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        encoder = WordEncoder(tokenizer, width)

        def ids_of(words: list[str]) -> dict[str, bytes]:
            """A word that begins with a space is the first one of a text, without that space."""
            firsts = [w for w in words if w[:1] == " "]
            found = encoder.look([w for w in words if w[:1] != " "])
            found.update(zip(firsts, encoder.texts([w[1:] for w in firsts]), strict=True))
            return found

        ENCODERS[path, width] = encoder, IdCache(ids_of, width) if cuts_at_spaces(path) else None
    encoder, cache = ENCODERS[path, width]
    if cache is None:
        return encoder.texts

    def encode(texts: list[str]) -> list[bytes]:
        odd, found = [has_odd_blanks(t) for t in texts], {}
        for kind in set(odd):
            places = [i for i, o in enumerate(odd) if o == kind]
            firsts, others = split_texts([texts[i] for i in places], kind)
            found.update(zip(places, cache([" " + w for w in firsts], others), strict=True))
        return [found[i] for i in range(len(texts))]

    return encode


def encode_rows(path: str, end_id: int | None, width: str):
    """(doc_id, tie, n_tokens, packed ids) of rows (doc_id, tie, text)."""

    def run(rows):
        encode = text_encoder(path, width)
        end = b"" if end_id is None else np.array([end_id], dtype=width).tobytes()
        size, held, weight = np.dtype(width).itemsize, [], 0
        compress = zstandard.ZstdCompressor(level=1).compress

        def finish():
            for (doc_id, tie, _), ids in zip(held, encode([r[2] for r in held]), strict=True):
                ids += end
                yield doc_id, tie, len(ids) // size, compress(ids)

        for doc_id, tie, text in rows:
            held.append((doc_id, tie, text or ""))
            weight += len(text or "")
            if len(held) >= TEXTS or weight >= CHARACTERS:
                yield from finish()
                held, weight = [], 0
        yield from finish()

    return run


def counts_of(width: str, n_ids: int):
    """(id, count) of a partition's ids."""

    def run(rows):
        counts, held, weight = np.zeros(n_ids, dtype=np.int64), [], 0
        decompress = zstandard.ZstdDecompressor().decompress
        for (ids,) in rows:
            held.append(decompress(ids))
            weight += len(held[-1])
            if weight > 1 << 22:
                counts += np.bincount(np.frombuffer(b"".join(held), dtype=width), minlength=n_ids)
                held, weight = [], 0
        counts += np.bincount(np.frombuffer(b"".join(held), dtype=width), minlength=n_ids)
        for i in np.nonzero(counts)[0].tolist():
            yield i, int(counts[i])

    return run


def code_blocks(frequency: np.ndarray, width: str, block_ids: int, block_docs: int):
    """Blocks of a partition's sorted rows (doc_id, ids)."""

    def run(rows):
        table, part = rans.Table(frequency), TaskContext.get().partitionId()
        decompress = zstandard.ZstdDecompressor().decompress
        block = first = first_doc = held = 0
        continued, ids, doc_ids, sizes = False, [], [], []

        def close():
            return part, block, first, held, first_doc, continued, doc_ids, sizes, rans.encode(np.concatenate(ids), table)

        for doc_id, packed in rows:
            own = np.frombuffer(decompress(packed), dtype=width)
            at = 0
            while at < len(own) or not len(own):
                taken = own[at : at + block_ids - held]
                ids.append(taken)
                doc_ids.append(doc_id)
                sizes.append(len(taken))
                held += len(taken)
                at += len(taken)
                if held == block_ids or (len(sizes) >= block_docs and at == len(own)):
                    yield close()
                    goes_on = at < len(own)
                    block, first, first_doc = block + 1, first + held, first_doc + len(sizes) - goes_on
                    continued, ids, doc_ids, sizes, held = goes_on, [], [], [], 0
                if not len(own):
                    break
        if sizes:
            yield close()

    return run


def write(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None = 2, text: str = "text", doc_id: str = "doc_id",
    block_ids: int = BLOCK_IDS, block_docs: int = BLOCK_DOCS,
) -> None:
    """Writes the ids of all texts into the folder `path`."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    n_ids = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), (end_id or 0) + 1)
    width = "<u2" if n_ids <= 1 << 16 else "<u4"
    place = scratch(spark, "tokens")
    rows = docs.select(F.col(doc_id).cast("long"), F.xxhash64(text), text)
    tokens = stored(map_rows(rows, encode_rows(tokenizer_path, end_id, width), TOKENS), "tokens", place)

    counted = map_rows(tokens.select("ids"), counts_of(width, n_ids), "id int, n long", limit=8192)
    counts = np.zeros(n_ids)
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():  # one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    frequency = rans.quantise(counts)
    used = [(int(i), int(frequency[i])) for i in np.nonzero(frequency)[0]]
    spark.createDataFrame(used, "id int, frequency int").coalesce(1).write.parquet(f"{path}/table")

    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "n_tokens", "ids")
    blocks = map_rows(ordered.select("doc_id", "ids"), code_blocks(frequency, width, block_ids, block_docs), BLOCKS, limit=16)
    blocks.write.parquet(f"{path}/blocks")
    drop(spark, place)


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """Frequencies by id; as many as the vocabulary has."""
    rows = spark.read.schema("id int, frequency int").parquet(f"{path}/table").collect()
    frequency = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        frequency[r["id"]] = r["frequency"]
    return frequency


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def directory(first_doc: int, continued: bool, doc_ids: list, sizes: list[int], last: bool):
    """(number in the part, doc_id, whole, first, stop) of a block's documents; the last one may go on in the next block."""
    at = 0
    for n, (doc_id, size) in enumerate(zip(doc_ids, sizes, strict=True)):
        yield first_doc + n, doc_id, not ((continued and n == 0) or (last and n == len(sizes) - 1)), at, at + size
        at += size


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """A row per document and block: its place in the part, number of ids and their checksum."""
    frequency = read_table(spark, path)

    def run(rows):
        table = rans.Table(frequency)
        for part, first, first_doc, continued, doc_ids, sizes, payload in rows:
            ids = np.ascontiguousarray(rans.decode(payload, table), dtype="<u4")
            for doc, doc_id, whole, a, b in directory(first_doc, continued, doc_ids, sizes, True):
                yield part, doc, doc_id, whole, first + a, b - a, zlib.crc32(ids[a:b])

    names = ["part", "first", "first_doc", "continued", "doc_ids", "sizes", "payload"]
    return map_rows(read_blocks(spark, path).select(names), run, PIECES, limit=8192)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in all parts before; a row per part, of which there are as many as writing tasks."""
    sizes = read_blocks(spark, path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def joined(rows):
    """One row of each run of pieces, from their lists of (first, n, crc)."""
    for part, doc, doc_id, pieces in rows:
        crc, n = 0, 0
        for p in pieces:
            crc, n = rans.join_checksums(crc, p["crc"], p["n"]) if n else p["crc"], n + p["n"]
        yield part, doc, doc_id, True, pieces[0]["first"], n, crc


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    pieces = stored(read_pieces(spark, path), "pieces")
    split = pieces.filter("not whole").groupBy("part", "doc", "doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "n", "crc"))).alias("pieces"))
    rows = pieces.filter("whole").unionByName(map_rows(split, joined, PIECES))
    return rows.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def read_ids(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(part, doc, doc_id, first, ids) of documents `first` to `last` by document id, a row per document and block.

    Blocks without such a document are not decoded; others from the checkpoint before the first one wanted to the last one.
    """
    frequency = read_table(spark, path)
    wanted = F.lit(True)
    for bound, op in ((first, lambda d: d >= first), (last, lambda d: d <= last)):
        if bound is not None:
            wanted = wanted & F.exists("doc_ids", op)

    def run(rows):
        table = rans.Table(frequency)
        for part, start, first_doc, continued, doc_ids, sizes, payload in rows:
            found = [
                d for d in directory(first_doc, continued, doc_ids, sizes, True)
                if (first is None and last is None) or (d[1] is not None and (first is None or d[1] >= first) and (last is None or d[1] <= last))
            ]
            if found:
                low, high = found[0][3], found[-1][4]
                ids = rans.decode(payload, table, low, high)
                for doc, doc_id, _, a, b in found:
                    yield part, doc, doc_id, start + a, ids[a - low : b - low].tolist()

    names = ["part", "first", "first_doc", "continued", "doc_ids", "sizes", "payload"]
    return map_rows(read_blocks(spark, path).filter(wanted).select(names), run, "part int, doc long, doc_id long, first long, ids array<int>", limit=256)
