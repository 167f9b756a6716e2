from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.frames import docs_frame, edge_rows, prose
from tillsight.llm import queries, simhash


def plain_fingerprint(text, k=3):
    """The contract, word for word."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, distance=3):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                parent[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [least.get(find(a)) for a in range(len(fps))]


@pytest.mark.parametrize("text", ["", "  ", "One", "one TWO", "a b c", "A b c d A b c", "é É ß\x0bx\x1cy z w", "tab\tnew\nline\x0cfeed vt\x0b end a b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_slices(monkeypatch):
    text = prose(random.Random(1), 500)
    monkeypatch.setattr(simhash, "_SLICE", 64)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_close_pair_shares_a_key(distance):
    masks = simhash.key_masks(distance)
    rng = random.Random(distance)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), distance))
        assert any(not flips & m for m in masks)
        first = next(m for m in masks if not flips & m)
        assert any(not flips & m for m in simhash.second_masks(first, distance, simhash.BLOCKS))
    assert all(m.bit_count() >= 40 for k in masks for m in simhash.second_masks(k, 3, simhash.BLOCKS))


@pytest.mark.parametrize("bucket", [4, 1 << 12])
def test_components_of_crowded_fingerprints(spark, bucket):
    rng = random.Random(9)
    fps = set()
    for _ in range(12):  # clusters, chains and strangers
        centre = rng.getrandbits(64)
        at = centre
        for _ in range(25):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))))
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(at)
        fps.add(rng.getrandbits(64))
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(frame, bucket=bucket)).collect()}
    roots = [found.get(f, f) for f in (int(np.uint64(f).astype(np.int64)) for f in fps)]
    wanted = plain_components(fps, list(range(len(fps))))
    pairs = set(zip(roots, wanted, strict=True))
    assert len(pairs) == len(set(roots)) == len(set(wanted))


def test_crowded_keys_are_dealt_before_they_meet(spark, monkeypatch):
    """100,000 fingerprints that agree in 32 bits: no task holds them all, and no link is lost."""
    rng = np.random.default_rng(17)
    mask = np.uint64(simhash.key_masks()[0])
    base = np.uint64(0x0123456789ABCDEF) & mask
    fps = np.unique(base | (rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) * np.uint64(2) & ~mask))
    free = [b for b in range(64) if not int(mask) >> b & 1]
    near = fps[:300] ^ np.array([sum(1 << b for b in rng.choice(free, 3, replace=False)) for _ in range(300)], np.uint64)
    fps = np.unique(np.concatenate([fps, near]))
    met, plain_meet = [], simhash._meet

    def watched(dealt, task):
        met.append(dealt.groupBy("key", "masked").count().agg({"count": "max"}).collect()[0][0] or 0)
        return plain_meet(dealt, task)

    monkeypatch.setattr(simhash, "_meet", watched)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = simhash.links(frame).collect()
    assert met[0] <= simhash.BUCKET and met[1] <= 1 << 18 and met[1] < len(fps) / 10
    pairs = np.array([(r.u, r.v) for r in found], np.int64).view(np.uint64)
    assert (np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= 3).all()
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for u, v in pairs.tolist():
        root[find(u)] = find(v)
    for x in near.tolist():  # each planted one is linked with all that are close to it
        close = fps[np.bitwise_count(fps ^ np.uint64(x)) <= 3]
        assert len(close) > 1 and len({find(y) for y in close.tolist()}) == 1
    assert simhash.crowded_keys(frame.limit(50).selectExpr("0 AS key", "fp AS masked", "fp"), 4096) is None


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for r in edge_rows() if r[0] is None or r[0] < 9]
    for i in range(60):
        text = prose(rng, rng.randrange(30, 200))
        rows.append((100 + 3 * i, text, "en", "a"))
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((101 + 3 * i, " ".join(words), "en", "a"))
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op5_simhash_near_dedup(spark, str(tmp_path)).collect()
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    wanted = zip([r[0] for r in rows], fps, plain_components(fps, [r[0] for r in rows]), strict=True)
    order = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=order) == sorted(((i, f"{f:016x}", c) for i, f, c in wanted), key=order)


def test_drop_keeps_one_row_of_each_group(spark):
    rows = edge_rows()
    docs = docs_frame(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = plain_components([plain_fingerprint(t) for _, t, _, _ in rows], list(range(len(rows))))
    assert kept.count() == len(set(groups))
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_clashing_columns(spark):
    docs = docs_frame(spark, edge_rows())
    more = docs.selectExpr("*", "'x' AS fp", "1 AS key", "2 AS masked", "3 AS component_id", "4 AS node", "5 AS root")
    told = lambda frame: sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(frame).collect()), key=str)
    assert told(more) == told(docs)
    kept = simhash.drop_near_duplicates(more)
    assert kept.columns == more.columns and kept.count() == simhash.drop_near_duplicates(docs).count()
