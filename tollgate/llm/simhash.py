"""SimHash near-duplicates found through Golay-coded keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Three differing bits leave at least two segments
with one differing bit or none. Each segment is decoded to its codeword's index and to those of its one-bit neighbours
(six at most). For each pair of segments, a fingerprint offers (index, nearby indices) and asks for (nearby indices,
index); any two fingerprints within three bits then meet in a key of 24 bits. The join verifies the distance inside
its condition, so unrelated fingerprints that share a key leave no row. Equal fingerprints are one row before all of
this; links are turned into components by joins (`components`), and ids come back by fingerprint.

Null and blank texts have fingerprint zero and link like any other. Repeated rows and ids share a component. An empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm import golay
from tollgate.llm.common import map_rows, stored
from tollgate.llm.components import components

#: (first bit, bits) of the segments; a pair of them makes a key.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
SEED = 42
BUCKET_ROWS, SAMPLE = 20_000, 64
MIX = np.uint64(0x9E3779B97F4A7C15)
LANES = np.uint64(0x0101010101010101)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; bytes' methods know exactly these letters and white spaces."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of the space-joined shingles, repeats included; of the whole sequence when it is shorter."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    digest, stops = xxhash.xxh64_intdigest, (ends[size - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=len(starts))


def fingerprint(hashes: np.ndarray, words: int = 1) -> list[int]:
    """`words` times 64 bits, each set if it is in over half of the hashes; as signed 64-bit integers.

    The first word counts the hashes themselves, others count them remixed. Bits are counted in byte lanes, 255 at a time.
    """
    if not len(hashes):
        return [0] * words
    found = []
    for word in range(words):
        mixed = hashes
        if word:
            with np.errstate(over="ignore"):
                mixed = (hashes ^ np.uint64(word)) * MIX
                mixed = (mixed ^ (mixed >> np.uint64(31))) * MIX
                mixed ^= mixed >> np.uint64(33)
        ones = np.zeros((8, 8), dtype=np.int64)  # by bit within a byte, by byte
        edges = np.arange(0, len(mixed), 255)
        for bit in range(8):
            lanes = np.add.reduceat((mixed >> np.uint64(bit)) & LANES, edges)
            ones[bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        bits = np.packbits((ones.T.ravel() * 2 > len(mixed)), bitorder="little")
        found.append(int(bits.view("<i8")[0]))
    return found


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fps) of every row."""

    def run(rows):
        for key, text_hash, content in rows:
            yield key, text_hash, fingerprint(shingle_hashes(words_of(content), shingle), words)

    return map_rows(docs.select(doc_id, F.xxhash64(text), text), run, "doc_id long, text_hash long, fps array<long>", limit=16384)


def key_frame(nodes: np.ndarray, fps: np.ndarray, word: int, swap: bool) -> pd.DataFrame:
    """Keys of fingerprints: of each pair's segments one is given by its index, the other by all indices nearby."""
    bits = fps.view(np.uint64)
    segments = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    own = [golay.index(s) for s in segments]
    near = [golay.nearby(s) for s in segments]
    parts = []
    for number, pair in enumerate(PAIRS):
        one, many = pair[::-1] if swap else pair
        keys = near[many]
        fresh = np.concatenate([np.ones((len(keys), 1), dtype=bool), keys[:, 1:] != keys[:, :-1]], axis=1)
        row, column = np.nonzero(fresh)
        first, second = own[one][row].astype(np.int64), keys[row, column].astype(np.int64)
        if swap:
            first, second = second, first
        table = (word * len(PAIRS) + number) << 24
        parts.append(pd.DataFrame({"node": nodes[row], "fp": fps[row], "key": table | (first << 12) | second}))
    return pd.concat(parts)


def golay_keys(nodes: DataFrame, swap: bool) -> DataFrame:
    """(node, fp, key) rows of a table (node, fp); the two forms of `swap` meet each other."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                ids, fps = (np.ascontiguousarray(part.column(i).to_numpy(zero_copy_only=False)) for i in (0, 1))
                yield pa.RecordBatch.from_pandas(key_frame(ids, fps, 0, swap), preserve_index=False)

    return nodes.select("node", "fp").mapInArrow(run, "node long, fp long, key long")


def links(nodes: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b) with a < b: nodes of a table (node, fp) whose fingerprints differ in at most `bits` bits, for up to three."""
    if bits > 3:
        raise ValueError("the keys guarantee distances up to three bits")
    a = golay_keys(nodes, False).withColumnsRenamed({"node": "a", "fp": "x"})
    b = golay_keys(nodes, True).withColumnsRenamed({"node": "b", "fp": "y"})
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= bits)
    return a.join(b, (a["key"] == b["key"]) & close).select("a", "b").distinct()


def joined_in(nodes: np.ndarray, fps: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Edges that connect what a bucket's links (at most `most` differing bits) connect.

    They lead from the least node of each connected part to its others, so that buckets with the same nodes send the same
    edges, and never more than a bucket has rows.
    """
    root = np.arange(len(nodes))
    for start in range(0, len(nodes), 256):
        block = fps[start : start + 256]
        near = np.bitwise_count(block[:, None, :] ^ fps[None, :, :]).sum(axis=2, dtype=np.int16) <= most
        for i in range(len(block)):
            linked = np.nonzero(near[i, : start + i])[0]
            for other in np.unique(root[linked]).tolist():
                low, high = sorted((other, int(root[start + i])))
                root[root == high] = low
    order = np.lexsort((nodes, root))
    first = np.concatenate([[True], root[order][1:] != root[order][:-1]])
    least = nodes[order][np.maximum.accumulate(np.where(first, np.arange(len(nodes)), 0))]
    real = least != nodes[order]
    return least[real].tolist(), nodes[order][real].tolist()


def wide_keys(nodes: np.ndarray, fps: np.ndarray, key_words: int) -> pd.DataFrame:
    """(key, node, place) of fingerprints of several words: the keys of both forms of the first `key_words` words."""
    places = np.arange(len(nodes))
    frames = [key_frame(places, np.ascontiguousarray(fps[:, w]), w, swap) for w in range(key_words) for swap in (False, True)]
    found = pd.concat(frames)[["key", "node"]].drop_duplicates().rename(columns={"node": "place"})
    return found.assign(node=nodes[found["place"].to_numpy()])


def wide_rows(nodes: DataFrame, words: int, key_words: int) -> DataFrame:
    """(key, node, w0, w1, ...) rows of a table (node, fps)."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                fps = np.array(part.column(1).to_pylist(), dtype=np.int64).reshape(-1, words)
                keys = wide_keys(ids, fps, key_words)
                columns = {f"w{w}": fps[keys["place"].to_numpy(), w] for w in range(words)}
                yield pa.RecordBatch.from_pandas(keys[["key", "node"]].assign(**columns), preserve_index=False)

    return nodes.select("node", "fps").mapInArrow(run, "key long, node long, " + ", ".join(f"w{w} long" for w in range(words)))


def edges_of(rows: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Edges within runs of rows (key, i, j, node, words...) with equal key, i and j."""
    starts = np.nonzero(np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]))[0]
    sizes = np.diff(np.concatenate([starts, [len(rows)]]))
    twos = starts[sizes == 2]
    near = np.bitwise_count(rows[twos, 4:].view(np.uint64) ^ rows[twos + 1, 4:].view(np.uint64)).sum(axis=1, dtype=np.int64) <= most
    near &= rows[twos, 3] != rows[twos + 1, 3]
    a, b = rows[twos[near], 3].tolist(), rows[twos[near] + 1, 3].tolist()
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        group = rows[start : start + size]
        more = joined_in(group[:, 3], np.ascontiguousarray(group[:, 4:]).view(np.uint64), most)
        a += more[0]
        b += more[1]
    return a, b


def bucket_edges(most: int):
    """Edges of partitions whose rows come sorted by key, i and j."""

    def run(batches):
        rest = None
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64)
            rows = rows if rest is None else np.concatenate([rest, rows])
            open_from = len(rows) - int(np.argmax((rows[::-1, :3] != rows[-1, :3]).any(axis=1)))
            if open_from == len(rows):  # all of one run
                rest = rows
                continue
            a, b = edges_of(rows[:open_from], most)
            rest = rows[open_from:]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        if rest is not None:
            a, b = edges_of(rest, most)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def bucket_links(rows: DataFrame, sampled: DataFrame, words: int, share: float, bucket_rows: int) -> DataFrame:
    """(a, b): edges that connect the nodes of rows (key, node, w0, w1, ...) which share a key and differ in at most `share` of their bits.

    A bucket sends no more edges than it has rows. Buckets that a sample of one node in SAMPLE shows to be large are
    split into blocks, and each pair of blocks is compared in its own task; the sample decides on nothing else.
    """
    blocks = F.ceil(F.col("count") * SAMPLE / bucket_rows).cast("int").alias("blocks")
    large = stored(sampled.groupBy("key").count().select("key", blocks).filter("blocks > 1"), "large-buckets")
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    split = rows.join(large, "key", "left").select("key", F.inline(F.when(F.col("blocks") > 1, pairs).otherwise(whole)), "node", *[f"w{w}" for w in range(words)])
    ordered = split.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(bucket_edges(int(share * 64 * words)), "a long, b long").distinct()


def wide_links(nodes: DataFrame, words: int, key_words: int, share: float, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`bucket_links` of a table (node, fps) by the Golay keys of its first `key_words` words."""
    sampled = wide_rows(nodes.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0), words, key_words)
    return bucket_links(wide_rows(nodes, words, key_words), sampled, words, share, bucket_rows)


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fp (64 bits), component_id (least doc_id of the component)."""
    prints = stored(fingerprints(docs, shingle, 1, doc_id, text).select("doc_id", F.get("fps", F.lit(0)).alias("fp")), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select(F.col("fp").alias("node"), "fp"), bits)).withColumnRenamed("node", "fp")
    members = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


#: Share of differing bits at a Jaccard similarity of 0.8 of the shingle sets: the angle of cosine 2J / (1 + J), over pi.
SHARE_AT_80 = float(np.arccos(2 * 0.8 / 1.8) / np.pi)

#: Bands of BAND_ROWS least hashes; sets of similarity J share none of them with probability (1 - J^BAND_ROWS)^BANDS: 3e-6 at 0.8.
BANDS, BAND_ROWS = 24, 4
#: Share of differing bits up to which sets that share a band are compared: 7 standard deviations above SHARE_AT_80 for 256
#: bits, 5 for sets of four and five shingles, whose bits differ most.
SHARE_LOOSE = 80 / 256
CELLS = 4_000_000  # of a matrix of sets and shingles held at a time


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * BAND_ROWS, 1), dtype=np.uint64)
    return drawn[0] << np.uint64(1) | np.uint64(1), drawn[1]


def band_keys(hashes: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> list[int]:
    """A key for each band of least hashes of a set; as signed 64-bit integers."""
    if not len(hashes):
        return []
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), 4096):
        np.minimum(least, ((hashes[start : start + 4096] ^ masks) * factors).min(axis=1), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = (keys ^ row) * MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64).tolist()


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), shingle))


def sketches(docs: DataFrame, shingle: int, words: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, node, fps, keys) of every row; node is the digest of its set of shingles."""

    def run(rows):
        factors, masks = multipliers()
        for key, text_hash, content in rows:
            hashes = shingle_set(content, shingle)
            node = xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)
            yield key, text_hash, node, fingerprint(hashes, words), band_keys(hashes, factors, masks)

    return map_rows(docs.select(doc_id, F.xxhash64(text), text), run, "doc_id long, text_hash long, node long, fps array<long>, keys array<long>")


def joined_sets(nodes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges from the least node to the others of each part that links of Jaccard similarity 0.8 or more connect."""
    order = np.argsort(nodes, kind="stable")
    nodes, sets = nodes[order], [sets[i] for i in order.tolist()]
    n, sizes = len(nodes), np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        common = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2, dtype=np.int64)
        common[1, 0] = common[0, 1]
        common[[0, 1], [0, 1]] = sizes
    else:
        _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner, shared = np.repeat(np.arange(n), sizes), counts > 1
        held = shared[column]
        owner, column = owner[held], (np.cumsum(shared) - 1)[column[held]]
        by_column = np.argsort(column, kind="stable")
        owner, column = owner[by_column], column[by_column]
        common, width = np.zeros((n, n), dtype=np.int64), max(1, CELLS // n)
        for start in range(0, int(shared.sum()), width):
            a, b = np.searchsorted(column, [start, start + width])
            cells = np.zeros((n, min(width, int(shared.sum()) - start)), dtype=np.float32)
            cells[owner[a:b], column[a:b] - start] = 1
            common += np.rint(cells @ cells.T).astype(np.int64)
    near = 9 * common >= 4 * (sizes[:, None] + sizes[None, :])  # common / (sum - common) >= 4 / 5
    left, edges = np.ones(n, dtype=bool), []
    for root in range(n):
        if not left[root]:
            continue
        left[root], fresh = False, np.array([root])
        while len(fresh):
            fresh = np.nonzero(near[fresh].any(axis=0) & left)[0]
            left[fresh] = False
            edges += [(int(nodes[root]), other) for other in nodes[fresh].tolist() if other != nodes[root]]
    return edges


def set_edges(rows):
    """Edges within runs of rows (root, i, j, node, set) with equal root, i and j."""
    for _, group in groupby(rows, key=lambda r: r[:3]):
        members = [(r[3], r[4]) for r in group]
        if len(members) > 1:
            yield from joined_sets(np.array([m[0] for m in members]), [np.frombuffer(m[1], dtype=np.uint64) for m in members])


def candidates(nodes: DataFrame, words: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): edges that connect the nodes of a table (node, fps, keys) which share a key and differ in at most SHARE_LOOSE of their bits.

    Keys are the Golay keys of the first word, in which SimHash fingerprints within three bits meet, and the bands.
    """
    bands = nodes.select(F.explode("keys").alias("key"), "node", *[F.get("fps", F.lit(w)).alias(f"w{w}") for w in range(words)])
    rows = wide_rows(nodes, words, 1).unionByName(bands)
    one_of = F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0
    sampled = wide_rows(nodes.filter(one_of), words, 1).unionByName(bands.filter(one_of))
    return bucket_links(rows, sampled, words, SHARE_LOOSE, bucket_rows)


def verified(marked: DataFrame, nodes: DataFrame, clusters: DataFrame, shingle: int, text: str) -> DataFrame:
    """(a, b): edges that connect what links of Jaccard similarity 0.8 or more connect inside clusters (node, root).

    Each set moves to its cluster; clusters are cut into about sqrt(size) / 4 blocks, and each pair of blocks is one run, so a
    task gets few rows of a large cluster and every pair of its sets is compared.
    """
    blocks = F.ceil(F.sqrt(F.count("*") / 16)).cast("int").alias("blocks")
    named = clusters.join(clusters.groupBy("root").agg(blocks), "root").join(nodes.select("node", "_id", "_hash"), "node")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))
    texts = marked.select("_own", "_own_hash", F.col(text).alias("_text")).join(named, (F.col("_own") == F.col("_id")) & (F.col("_own_hash") == F.col("_hash")))
    # repeated rows are one node
    once = texts.select("node", "root", "blocks", "_text").dropDuplicates(["node"])

    def run(rows):
        for node, root, n, content in rows:
            yield node, root, n, shingle_set(content, shingle).tobytes()

    sets = map_rows(once, run, "node long, root long, blocks int, set binary")
    dealt = sets.select("root", F.inline(pairs), "node", "set")
    ordered = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return map_rows(ordered, set_edges, "a long, b long").distinct()


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, words: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the least id; all columns stay.

    Links join texts whose sets of shingles have a Jaccard similarity of 0.8 or more, counted exactly. Candidates are sets
    whose SimHash fingerprints meet in a Golay key, or that share a band of least hashes, and that differ in few bits of the
    longer fingerprint; their clusters get the sets themselves. Equal sets (so equal texts, and all blank ones) are one node before that. Rows without an id go by their
    text's hash. Rows with one id and unlike texts are rows of their own: each stays unless it is near a row before it.
    """
    marked = docs.withColumns({"_own": F.coalesce(F.col(doc_id), F.xxhash64(text)), "_own_hash": F.xxhash64(text)})
    prints = stored(sketches(marked, shingle, words, "_own", text), "sketches")
    least = F.min(F.struct("doc_id", "text_hash")).alias("least")
    first = F.first("fps").alias("fps"), F.first("keys").alias("keys")
    nodes = stored(prints.groupBy("node").agg(least, *first).select("node", F.col("least.doc_id").alias("_id"), F.col("least.text_hash").alias("_hash"), "fps", "keys"), "nodes")
    clusters = stored(components(candidates(nodes, words)), "clusters")
    roots = components(verified(marked, nodes, clusters, shingle, text))
    members = nodes.select("node", "_id", "_hash").join(roots, "node", "left")
    kept = members.groupBy(F.coalesce("root", "node")).agg(F.min(F.struct("_id", "_hash")).alias("least")).select("least.*")
    joined = marked.join(kept, (F.col("_own") == F.col("_id")) & (F.col("_own_hash") == F.col("_hash")))
    return joined.dropDuplicates(["_own", "_own_hash"]).select(*docs.columns)
