"""Exact centroid clustering on bit planes.

A vector of whole numbers is kept as its bit planes: bit ``i`` of all 64 components is one
unsigned 64-bit word, in two's complement, so the last plane counts negative.  With planes
``x_i`` and ``c_j`` of a vector and a centroid, the inner product is the sum of
``w_i w_j popcount(x_i & c_j)``; squared distances follow from it, all in whole numbers.  Vectors
of other lengths use one word for every 64 components.

Vectors are packed once into a stored table.  A round reads that table, sums each
cluster's vectors in the tasks, and brings one row per cluster to the driver, which holds the
centroids and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import staged, with_package

SCALE = 256
DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Largest size of a quantised component; beyond it squared distances could leave a long.
LARGEST = 1 << 27
#: Vectors compared with all centroids at a time.
STRIP = 1024


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, dims: int = DIMS) -> DataFrame:
    """``vec_id`` and ``v`` (floor(scale * x), longs) of the vectors of ``dims`` components, none of them
    null, NaN or infinite.  A component beyond ``LARGEST`` is an error."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))
    kept = vectors.filter((F.size(F.col(vector_col)) == dims) & F.coalesce(fine, F.lit(False)))
    too_large = F.raise_error(F.lit(f"a quantised component is larger than {LARGEST}: squared distances would not fit a long")).cast("bigint")
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) > LARGEST, too_large).otherwise(F.floor(c * scale)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def packed(v: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers: (n, dims) to (n, planes, words), in as few planes as hold them all."""
    n, dims = v.shape
    planes = 1 + max(int(v.max(initial=0)).bit_length(), int(-v.min(initial=0) - 1 if v.min(initial=0) < 0 else 0).bit_length())
    words = -(-dims // 64)
    out = np.zeros((n, planes, words * 8), np.uint8)
    for i in range(planes):
        bits = np.packbits(((v >> i) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, i, : bits.shape[1]] = bits
    return out.view("<u8")


def widened(x: np.ndarray, planes: int) -> np.ndarray:
    """The same numbers in more planes: the sign plane is repeated."""
    return x if x.shape[1] >= planes else np.concatenate([x, np.repeat(x[:, -1:], planes - x.shape[1], axis=1)], axis=1)


def unpacked(x: np.ndarray, dims: int) -> np.ndarray:
    """The whole numbers of bit planes."""
    n, planes, _ = x.shape
    out = np.zeros((n, dims), np.int64)
    for i in range(planes):
        bits = np.unpackbits(np.ascontiguousarray(x[:, i]).view(np.uint8), axis=1, count=dims, bitorder="little").astype(np.int64)
        out += bits * -(1 << i) if i == planes - 1 else bits << i
    return out


def inner_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of packed vectors (n, p, words) with packed centroids (k, q, words)."""
    (n, p, words), (k, q, _) = x.shape, c.shape
    out = np.zeros((n, k), np.int64)
    for shift in range(p + q - 1):
        at_shift = np.zeros((n, k), np.int32)  # at most 64 a word and pair of planes
        for i in range(max(0, shift - q + 1), min(p, shift + 1)):
            j = shift - i
            for w in range(words):
                both = np.bitwise_count(x[:, i, w, None] & c[None, :, j, w])
                if (i == p - 1) != (j == q - 1):
                    at_shift -= both
                else:
                    at_shift += both
        out += at_shift.astype(np.int64) << shift
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """Exact squared lengths of packed vectors."""
    n, p, words = x.shape
    out = np.zeros(n, np.int64)
    for i in range(p):
        for j in range(i, p):
            both = np.bitwise_count(x[:, i] & x[:, j]).sum(axis=1, dtype=np.int64) << (i + j + (i != j))
            out += -both if (i == p - 1) != (j == p - 1) else both
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of two as near) and squared distance to it."""
    own = squares(c)
    numbers, distances = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), STRIP):
        strip = x[at : at + STRIP]
        d = squares(strip)[:, None] - 2 * inner_products(strip, c) + own
        numbers[at : at + STRIP] = best = d.argmin(axis=1)
        distances[at : at + STRIP] = d[np.arange(len(strip)), best]
    return numbers, distances


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            x = packed(v)
            blobs = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.full(len(x), x.shape[1], np.int32)), blobs], names=["vec_id", "n_planes", "planes"])


def pack_vectors(vectors: DataFrame) -> DataFrame:
    """``quantised`` vectors as a stored table of bit planes (``vec_id``, ``n_planes``, ``planes``)."""
    with_package(vectors.sparkSession)
    return staged(vectors.mapInArrow(_pack, "vec_id long, n_planes int, planes binary"), "bit-planes")


def _planes_of(batch: pa.RecordBatch, words: int) -> np.ndarray:
    """Vectors of a batch, all in as many planes as its widest has."""
    counts = batch.column("n_planes").to_numpy()
    out = np.zeros((len(counts), int(counts.max()), words), np.uint64)
    for n in np.unique(counts):
        which = np.flatnonzero(counts == n)
        blobs = batch.column("planes").take(pa.array(which)).to_pylist()
        out[which] = widened(np.frombuffer(b"".join(blobs), "<u8").reshape(len(which), int(n), words), out.shape[1])
    return out


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(cluster, vectors, componentwise sums) of each cluster that has any."""
    c, dims = packed(centroids), centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(c), dims), np.int64), np.zeros(len(c), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _planes_of(batch, c.shape[2])
                cluster = nearest(x, c)[0]
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                sums[found] += np.add.reduceat(unpacked(x, dims)[order], first, axis=0)
                counts += np.bincount(cluster, minlength=len(c))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = vectors.mapInArrow(add, "cluster long, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dims)))
    return [(r[0], r[1], list(r[2:])) for r in totals.collect()]  # one row per cluster


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids, salted, have the smallest SHA-256 digests, in their order.  A null id
    is hashed as an empty one; rows equal in id are told apart by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("__digest"), "v").orderBy("__digest", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), dims)


def moved(centroids: np.ndarray, sums: list[tuple[int, int, list[int]]]) -> np.ndarray:
    """Centroids at the whole numbers at or below their vectors' means; those without vectors stay."""
    out = centroids.copy()
    for cluster, n, total in sums:
        out[cluster] = [s // n for s in total]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of packed vectors."""
    c = packed(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(_planes_of(batch, c.shape[2]), c)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(place, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, dims: int = DIMS, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(rows, centroids): ``vec_id``, ``cluster``, ``distance`` (squared) of every vector that takes part, and
    the ``k`` final centroids, a matrix of whole numbers.  Start: ``first_centroids``; then ``rounds``
    times every vector goes to its nearest centroid (ties: the smaller number) and every
    centroid that has vectors to the floor of their mean; then vectors are assigned once more.

    Vectors that are null, of another length, or hold null, NaN or infinite components take no part.
    Repeated rows and ids are vectors of their own; a null id stays null.  With fewer than ``k``
    vectors there are as many centroids; an empty table gives no rows and no centroids.
    """
    rows = quantised(vectors, id_col, vector_col, scale, dims)
    centroids = first_centroids(rows, k, dims, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    planes = pack_vectors(rows)
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(planes, centroids))
    return staged(assigned(planes, centroids), "clusters"), centroids


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` of ``cluster_vectors`` with ``cluster_inertia``, ``inertia`` (distances summed over the cluster and
    over all) and ``centroid_sha256``, the digest of the cluster's centroid as decimal numbers joined by commas."""
    spark = rows.sparkSession
    sums = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per centroid
    told = [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    named = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
