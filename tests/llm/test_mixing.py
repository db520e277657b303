from __future__ import annotations

import re

import pytest
import xxhash

from tollgate.llm import mixing
from tollgate.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def water(sizes: dict, cap: int = 3) -> dict:
    """Targets by filling and capping until nothing changes."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - cap * sum(sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        target = {s: float(cap * sizes[s]) if s in capped else left * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in capped and left * weight[s] > cap * sizes[s] * open_weight}
        if not over:
            return target
        capped |= over


def uniform(*values: tuple[int, int]) -> float:
    seed = 42
    for value, width in values:
        seed = xxhash.xxh64_intdigest(value.to_bytes(width, "little", signed=True), seed)
    return ((seed >> 11) + 0.5) / 2**53


def fold(items: list[tuple]) -> dict:
    """Copies by the pivotal method over one group, in the operator's order and with its random numbers."""
    carry, copies = None, {}
    for p, size, base, doc, row in sorted(items, key=lambda i: (-i[1], i[3], i[4])):
        item = [p, size, base, doc, row]
        if carry is None:
            carry = item
            continue
        ratio = size / carry[1]
        up, down = min(1 - carry[0], p * ratio), min(carry[0], (1 - p) * ratio)
        grows = uniform((carry[3], 8), (carry[4], 8), (doc, 8), (row, 8), (0, 4)) * (up + down) < down
        if grows and 1 - carry[0] <= p * ratio:
            copies[carry[3]], carry, item[0] = carry[2] + 1, item, p - (1 - carry[0]) / ratio
        elif grows:
            copies[doc], carry[0] = base, carry[0] + p * ratio
        elif carry[0] <= (1 - p) * ratio:
            copies[carry[3]], carry, item[0] = carry[2], item, p + carry[0] / ratio
        else:
            copies[doc], carry[0] = base + 1, carry[0] - (1 - p) * ratio
    if carry:
        lucky = xxhash.xxh64_intdigest(b"last", xxhash.xxh64_intdigest(carry[4].to_bytes(8, "little", signed=True), xxhash.xxh64_intdigest(carry[3].to_bytes(8, "little", signed=True), 42)))
        copies[carry[3]] = carry[2] + (((lucky >> 11) + 0.5) / 2**53 < carry[0])
    return copies


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5}, {"a": 5}, {"z": 7, None: 9, "é": 1}, {"a": 0, "b": 0}, {"a": 0, "b": 3, "c": 900, "d": 1, "e": 2},
    {f"s{i}": (i * 37) % 101 for i in range(40)},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(water(sizes))


def test_copies_against_brute_force(documents):
    rows = [(i, "w " * (1 + i * 7 % 50), "en", "ab"[i % 5 == 0]) for i in range(100)]
    got = mixing.mix(documents(rows)).collect()
    sizes = {s: sum(1 + i * 7 % 50 for i in range(100) if "ab"[i % 5 == 0] == s) for s in "ab"}
    target = water(sizes)
    for source in "ab":
        items = []
        for r in got:
            if r["source"] == source:
                ratio = target[source] / sizes[source]
                items.append((ratio - int(ratio), r["size"], int(ratio), r["doc_id"], r["row"]))
        expected = fold(items) if items[0][0] > 0 else {i[3]: i[2] for i in items}
        assert {r["doc_id"]: r["copies"] for r in got if r["source"] == source} == expected


def test_many_rounds(documents, monkeypatch):
    """Small groups make a deep tree; every document comes out once and sources meet their targets."""
    monkeypatch.setattr(mixing, "FAN", 8)
    rows = [(i, "w " * (i % 9), "en", f"s{i % 3}") for i in range(1500)]
    got = mixing.mix(documents(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1500))
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert all(0 <= r["copies"] <= 3 for r in own)


def test_query_and_rerun(spark):
    first, second = (sorted(map(tuple, QUERIES["op3_mixing_pivotal"](spark, SF).collect())) for _ in range(2))
    assert first == second
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes: dict = {}
    for d in docs:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    target = water(sizes)
    assert len(first) == len(docs)
    rows = QUERIES["op3_mixing_pivotal"](spark, SF).collect()
    for source, size in sizes.items():
        own = [r for r in rows if r["source"] == source]
        assert own[0]["source_size"] == size and own[0]["target"] == target[source]
        assert abs(sum(r["taken"] for r in own) - target[source]) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 3 * r["size"] for r in own)


def test_native(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows(clashing, documents):
    got = mixing.mix(clashing).collect()
    assert len(got) == clashing.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert {r["source"] for r in got} == {"s", None}
    assert mixing.mix(documents([])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents([(1, None), (2, "")])).collect()] == [0, 0]
