from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tests.oracle_harness import compare, duck
from tillsight.llm import centroids, queries
from tillsight.llm.oracles import ORACLES

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, scale, dims):
    """The rounds anew, in plain whole numbers: sorted rows and final centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    means = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(means))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        means = [
            [sum(col) // len(members) for col in zip(*members, strict=True)] if (members := [v for (_, v), c in zip(kept, own, strict=True) if c == n]) else old
            for n, old in enumerate(means)
        ]
    return sorted(((i, *reversed(near(v))) for i, v in kept), key=str), means


@pytest.mark.parametrize(("n", "k", "rounds", "spread"), [(300, 12, 5, 0.2), (60, 40, 2, 0.01), (5, 40, 3, 1.0), (200, 7, 4, 900.0)])
def test_against_brute_force(spark, n, k, rounds, spread):
    rng = random.Random(n)
    vector = lambda: [float(np.float32(rng.gauss(0, spread))) for _ in range(64)]
    rows = [(i, vector()) for i in range(n)]
    rows += [(1000 + i, rows[2][1]) for i in range(n // 3)]  # a group of equal vectors: ties
    rows += [(3, vector()), (3, rows[3][1]), (None, vector()), (None, rows[4][1])]  # repeated and null ids
    rows += [(9001, None), (9002, vector()[:63] + [None]), (9003, [float("nan")] * 64), (9004, [float("-inf")] * 64), (9005, []), (9006, vector() + [1.0]), (9007, [0.0] * 64)]
    frame = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], f"{SCHEMA}, cluster string, planes int").repartition(3)
    found, means = centroids.cluster_vectors(frame, k, rounds)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str)
    wanted, plain_means = plain(rows, k, rounds, 256, 64)
    assert got == wanted
    assert means.tolist() == plain_means
    told = centroids.with_inertia(found, means).collect()
    assert len(told) == len(wanted)
    for r in told:
        assert r.inertia == sum(d for _, _, d in wanted)
        assert r.cluster_inertia == sum(d for _, c, d in wanted if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, plain_means[r.cluster])).encode()).hexdigest()


@pytest.mark.parametrize("dims", [1, 63, 64, 65, 200])
def test_planes(dims):
    rng = np.random.default_rng(dims)
    for most in (1, 5, 160, 1 << 27):
        x, c = rng.integers(-most, most + 1, (70, dims)), rng.integers(-most // 3, most + 1, (9, dims))
        x[0], x[1], c[0] = most, -most, 0
        px, pc = centroids.packed(x), centroids.packed(c)
        assert (centroids.unpacked(px, dims) == x).all()
        assert (centroids.unpacked(centroids.widened(px, 31), dims) == x).all()
        if dims <= 64:
            assert (centroids.inner_products(px, pc) == x @ c.T).all()
            assert (centroids.squares(px) == (x * x).sum(axis=1)).all()
            distance = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            number, least = centroids.nearest(px, pc)
            assert (number == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_planes_of_small_numbers_are_few():
    assert centroids.packed(np.array([[0, -1]])).shape == (1, 1, 1)
    assert centroids.packed(np.array([[1, -2]])).shape == (1, 2, 1)
    assert centroids.packed(np.array([[127, -128]])).shape == (1, 8, 1)
    assert centroids.packed(np.array([[128, 0]])).shape == (1, 9, 1)


def test_empty_and_too_large(spark):
    empty, means = centroids.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and len(means) == 0
    assert centroids.with_inertia(empty, means).count() == 0
    with pytest.raises(Exception, match="quantised component"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    key = "op12_centroid_clustering"
    result = compare(spark, duck(path), key, queries.op12_centroid_clustering, ORACLES[key], path)
    assert result["match"], result
