from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tollgate.llm import golay, simhash
from tollgate.llm.catalog import QUERIES
from tollgate.llm.common import stored
from tollgate.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def plain_components(prints: dict) -> dict:
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_golay_is_perfect():
    syndromes, errors = golay.tables()
    assert len(syndromes) == 1 << 23 and len({int(e) for e in errors}) == 1 << 11
    assert max(int(e).bit_count() for e in errors) == 3
    assert np.bincount(golay.index(np.arange(1 << 23, dtype=np.uint32)), minlength=4096).tolist() == [2048] * 4096


def test_golay_neighbours():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000, dtype=np.uint32)
    flipped = words ^ (np.uint32(1) << rng.integers(0, 23, 3000, dtype=np.uint32))
    near = golay.nearby(words)
    assert (near == golay.index(flipped)[:, None]).any(axis=1).all()
    assert max(len(set(r)) for r in near.tolist()) <= 6


def test_links_lose_nothing(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(300)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), n % 6)) for n, p in enumerate(prints)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints} | {0, -1, 1, 7})
    nodes = spark.createDataFrame([(p, p) for p in signed], "node long, fp long")
    got = {tuple(r) for r in simhash.links(nodes).collect()}
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == expected


def family(rng, n: int) -> list[list[int]]:
    """Fingerprints of four words around a few centres."""
    centres = [rng.getrandbits(256) for _ in range(5)]
    found = []
    for _ in range(n):
        value = rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(256), rng.choice([0, 8, 20, 30])))
        found.append([(value >> 64 * w & (1 << 64) - 1) - (1 << 63) for w in range(4)])
    return found


def partition_of(edges, nodes) -> dict:
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


@pytest.mark.parametrize(("bucket_rows", "sample"), [(20_000, 64), (40, 1), (7, 2)])
def test_wide_links_connect_what_shares_a_key(spark, monkeypatch, bucket_rows, sample):
    monkeypatch.setattr(simhash, "SAMPLE", sample)
    rng = random.Random(9)
    fps = family(rng, 220)
    nodes = spark.createDataFrame(list(enumerate(fps)), "node long, fps array<long>")
    got = [tuple(r) for r in simhash.wide_links(nodes, 4, 2, 38.5 / 256, bucket_rows).collect()]
    keys = [set() for _ in fps]
    frame = simhash.wide_keys(np.arange(len(fps)), np.array(fps), 2)
    for key, node in zip(frame["key"], frame["node"], strict=True):
        keys[node].add(key)
    apart = lambda x, y: sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(fps[x], fps[y], strict=True))
    true = [(x, y) for x in range(len(fps)) for y in range(x) if keys[x] & keys[y] and apart(x, y) <= 38]
    assert partition_of(got, range(len(fps))) == partition_of(true, range(len(fps)))


def test_fingerprints_within_three_bits_are_candidates(spark):
    """SimHash fingerprints meet in their Golay keys, with or without a band in common."""
    rng = random.Random(21)
    fps = [[rng.getrandbits(64) - (1 << 63) for _ in range(4)] for _ in range(40)]
    fps += [[word ^ sum(1 << b for b in rng.sample(range(63), 3)) if w == 0 else word for w, word in enumerate(own)] for own in fps]
    nodes = spark.createDataFrame([(n, own, [n]) for n, own in enumerate(fps)], "node long, fps array<long>, keys array<long>")
    assert sorted(tuple(r) for r in simhash.candidates(nodes, 4).collect()) == [(n, n + 40) for n in range(40)]


def test_edges_over_batches():
    """Runs that go on over batches of rows are one bucket."""
    rng = random.Random(4)
    rows = np.array([[key, 0, 0, n, *family(rng, 1)[0]] for n, key in enumerate(sorted(rng.choices(range(4), k=60)))], dtype=np.int64)
    names = ["key", "i", "j", "node", "w0", "w1", "w2", "w3"]
    batch = lambda part: simhash.pa.RecordBatch.from_arrays([simhash.pa.array(c) for c in part.T], names=names)
    whole = simhash.edges_of(rows, 60)
    for size in (1, 7, 60):
        parts = [batch(rows[i : i + size]) for i in range(0, 60, size)]
        found = [e for b in simhash.bucket_edges(60)(iter(parts)) for e in zip(*b.to_pydict().values(), strict=True)]
        assert sorted(found) == sorted(zip(*whole, strict=True))


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(7, i) for i in range(8, 30)] + [(40, 41), (41, 42), (42, 40)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_components_join_an_edge_a_node(spark, monkeypatch):
    """Nodes that many groups join to different nodes: what the rounds join grows with the nodes."""
    rng = random.Random(6)
    nodes = list(range(800))
    groups = [rng.sample(nodes, 100) for _ in range(200)]
    edges = [(min(g), n) for g in groups for n in g if n != min(g)]
    assert len(set(edges)) > 8 * len(nodes)
    kept = []

    def keep(df, name):
        out = stored(df, name)
        kept.append((name, out))
        return out

    monkeypatch.setattr("tollgate.llm.components.stored", keep)
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == dict.fromkeys({n for e in edges for n in e}, 0)
    joined = [t for name, t in kept if name == "edges"][-1]
    assert joined.count() <= 3 * len(nodes)


def test_query_against_brute_force(spark):
    rows = QUERIES["op6_simhash_golay"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(prints)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{prints[i]:016x}", roots[i]) for i in texts}


@pytest.mark.parametrize("words", [1, 4])
def test_fingerprint_lanes(words):
    hashes = np.random.default_rng(5).integers(0, 1 << 64, 1003, dtype=np.uint64)
    ones = [sum(int(h) >> b & 1 for h in hashes) for b in range(64)]
    found = simhash.fingerprint(hashes, words)
    assert found[0] & (1 << 64) - 1 == sum(1 << b for b in range(64) if ones[b] * 2 > 1003)
    assert len(set(found)) == words


def test_odd_rows(clashing, documents):
    got = simhash.near_duplicates(clashing).collect()
    assert len(got) == clashing.count()
    roots = {r["doc_id"]: r["component_id"] for r in got}
    assert roots[2] == roots[3] == roots[4] == 2
    assert simhash.near_duplicates(documents([])).count() == 0


def test_one_of_each_group_stays(clashing, documents):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(600)]
    one_off = base[:300] + ["changed"] + base[301:]
    other = base[:300] + [f"o{i}" for i in range(300)]
    docs = documents([(5, " ".join(base)), (3, " ".join(base)), (9, " ".join(one_off)), (7, " ".join(other)), (8, "  ".join(base).upper()), (11, "short"), (11, "short")])
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 11]
    assert kept.columns == docs.columns
    left = simhash.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    texts = [r["text"] for r in left.collect()]
    assert len(texts) == len(set(texts)) and sum(not (t or "").encode().split() for t in texts) == 1
    assert simhash.drop_near_duplicates(documents([])).count() == 0


def plain_kept(rows: list[tuple]) -> list[int]:
    """Least ids of the components of exact Jaccard similarity >= 0.8 of five-word shingle sets."""
    sets = {}
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().lower().split()]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(sets)
    links = [(a, b) for n, b in enumerate(ids) for a in ids[:n] if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = partition_of(links, ids)
    return [i for i in ids if root[i] == i]


def near_texts(rng) -> list[tuple]:
    """Pairs with similarities on both sides of 0.8, chains of such, and short texts."""
    rows = []
    for _ in range(40):
        n = rng.choice([6, 9, 14, 40, 150, 400])
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        rows.append(" ".join(words))
        for _ in range(rng.choice([1, 1, 3, 12])):
            words = list(words) if rng.random() < 0.5 else rows[-1].split()
            cut = max(1, round(n * rng.choice([0.05, 0.09, 0.1, 0.11, 0.12, 0.15, 0.22])))
            at = rng.randint(0, n - cut)
            words[at : at + cut] = [f"c{rng.randint(0, 10**6)}" for _ in range(rng.choice([0, cut]))]
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_kept_rows_against_brute_force_jaccard(documents):
    rows = near_texts(random.Random(11))
    expected = plain_kept(rows)
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(documents(rows)).collect()) == expected
    assert len(expected) < len(rows)


def test_sets_in_runs():
    rng = np.random.default_rng(3)
    base = np.arange(90, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(70, 90)], rng.integers(1000, 1 << 60, rng.integers(0, 9), dtype=np.uint64)])) for _ in range(25)]
    nodes = rng.permutation(25)
    true = [(a, b) for a in range(25) for b in range(a) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))]
    assert partition_of(simhash.joined_sets(nodes, sets), range(25)) == partition_of([(nodes[a], nodes[b]) for a, b in true], range(25))
