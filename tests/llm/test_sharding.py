from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import docs_frame, edge_rows, prose
from tillsight.llm import queries, sharding
from tillsight.llm.common import utf8_bytes


def greedy_shards(sizes, capacity):
    shards, held = 1, 0
    for s in sizes:
        if s > capacity:
            return 10**9
        if held + s > capacity:
            shards, held = shards + 1, 0
        held += s
    return shards


def best_capacity(rows, n):
    """Brute force over (shared text, size): the smallest capacity of n contiguous shards."""
    groups = defaultdict(int)
    for text, size in rows:
        groups[int(hashlib.sha256((text or "").encode()).hexdigest()[:15], 16)] += size
    sizes = [groups[k] for k in sorted(groups)]
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if greedy_shards(sizes, mid) <= n else (mid + 1, hi)
    return lo


@pytest.mark.parametrize(("seed", "hot", "n"), [(1, 0, 5), (2, 200, 7), (3, 0, 24), (4, 900, 4)])
@pytest.mark.parametrize("first_bits", [2, 14])
def test_capacity_is_the_smallest(spark, monkeypatch, seed, hot, n, first_bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", first_bits)  # few blocks: rounds of splitting
    monkeypatch.setattr(sharding, "SPLIT_TOTAL", 16 if first_bits == 2 else 1 << 16)
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", "a") for i in range(600)]
    rows += [(10_000 + i, rows[0][1], "en", "a") for i in range(hot)]
    docs = docs_frame(spark, rows)
    out = sharding.shard_by_size(docs, n, F.col("text"), utf8_bytes(F.col("text")) + 8).collect()
    totals, places = defaultdict(int), defaultdict(set)
    for r in out:
        totals[r.shard] += len(r.text.encode()) + 8
        places[r.text].add(r.shard)
    assert len(out) == len(rows) and set(totals) <= set(range(n))
    assert all(len(p) == 1 for p in places.values())
    assert max(totals.values()) == best_capacity([(t, len(t.encode()) + 8) for _, t, _, _ in rows], n)
    if not hot:
        assert len(totals) == n and min(totals.values()) > 0.7 * sum(totals.values()) / n


def test_edges(spark):
    rows = edge_rows()
    out = sharding.shard_by_size(docs_frame(spark, rows).withColumn("shard", F.lit("old")), 4, F.col("text"), utf8_bytes(F.col("text")) + 8)
    got = out.collect()
    assert len(got) == len(rows) and {r.shard for r in got} <= set(range(4))
    assert len({r.shard for r in got if not r.text}) == 1  # null stays with empty
    empty = docs_frame(spark, rows).limit(0)
    assert sharding.shard_by_size(empty, 4, F.col("text"), utf8_bytes(F.col("text")) + 8).count() == 0


def test_query(spark, tmp_path):
    rows = edge_rows() + [(100 + i, f"text {i % 50} " * (i % 7), "en", "a") for i in range(300)]
    docs_frame(spark, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op2_sharding(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    key = lambda i, t: (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == sorted(key(i, t) for i, t, _, _ in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.text_crc32, r.shard) for r in out}) == len({r.text_crc32 for r in out})
