"""Exact top-k inner products by ball-tree branch and bound.

Vectors are quantised to whole numbers and dealt to shards by space: the upper levels of one
ball tree are learnt from a bounded sample, every row follows their splits to a cell, and a cell is
one shard, or several (by row number) where it is large.  Each shard is packed once, as a ball tree
(centres, radii, rows in tree order), into a stored table; the balls of their roots are a
small table of their own.

Queries are dealt to blocks by the same cells.  A first pass searches for each query the few shards whose roots
have the highest upper bounds ``q.c + |q| r``; the k-th score found there is a lower bound of the final one
and is shared: the second pass forms only the pairs of block and shard whose root bound reaches it, with the
queries that need them.  Within a shard the leaves are visited in order of their upper bound, for all
those queries at a time, until no query's bound reaches its k-th score any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import ROW_ID, staged, with_package

SCALE = 64
LEAF = 128
SHARD_ROWS = 4096
QUERY_BLOCK = 256
#: Vectors that the splits of space are learnt from (about), and cells they make at most.
SAMPLE_ROWS = 1 << 15
MAX_CELLS = 1 << 12
#: Shards whose roots are compared with a block at a time.
ROOT_CHUNK = 1 << 12
#: Shards that a query is compared with to find a first k-th score.
FIRST_SHARDS = 8
_NO_FLOOR = -(1 << 62)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``ROW_ID``, ``vec_id`` and ``v`` (floor(scale * x), as doubles) of the vectors that take part:
    neither null nor with null or non-finite components.  Written once, so that each row keeps
    its number."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.col(vector_col).isNotNull() & F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))
    whole = F.transform(x, lambda c: F.rint(F.floor(c * scale).cast("double")))
    rows = vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    return staged(rows.withColumn(ROW_ID, F.monotonically_increasing_id()), "vectors")


def _matrix(rows: pa.Array) -> np.ndarray:
    """Rows as a matrix; shorter vectors are filled up with zeros."""
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
    return out


def ball_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a ball tree: each ball is split at the median of its
    projection on the line between two far points."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= leaf:
            leaves.append(own)
            continue
        x = points[own]
        a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
        b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
        order = np.argsort(x @ (b - a), kind="stable")
        half = len(own) // 2
        todo += [own[order[:half]], own[order[half:]]]
    return leaves


class BallTree:
    """A binary tree of balls over leaves in order; node 0 is the root."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        leaves = ball_leaves(points)
        order = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
        self.rows, self.ids, self.points = rows[order], ids[order], points[order]
        edges = np.cumsum([0, *map(len, leaves)])
        self.bounds: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._add(edges, 0, len(leaves))
        self.centres = np.array([self.points[a:b].mean(axis=0) for a, b in self.bounds])
        self.radii = np.array([np.sqrt(((self.points[a:b] - c) ** 2).sum(axis=1)).max() for (a, b), c in zip(self.bounds, self.centres, strict=True)])

    def _add(self, edges: np.ndarray, first: int, last: int) -> int:
        node = len(self.bounds)
        self.bounds.append((int(edges[first]), int(edges[last])))
        self.children.append(None)
        if last - first > 1:
            middle = (first + last + 1) // 2
            self.children[node] = (self._add(edges, first, middle), self._add(edges, middle, last))
        return node

    def upper(self, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, per query and node, with room for rounding."""
        bound = queries @ self.centres.T + norms[:, None] * self.radii
        return bound + 1e-9 * (1 + np.abs(bound) + norms[:, None] * self.radii)


class _Best:
    """The best candidates of a block of queries so far, as flat columns, and each query's bar: a
    score that a candidate must reach to matter still."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.k, self.bar, self.waiting = k, floor.copy(), 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.parts.append((query, score, ids, rows))
        self.waiting += len(query)
        if self.waiting > 4 * self.k * len(self.bar):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Keep the k best of each query (highest score, then smallest id, then row) and raise its bar."""
        empty = (np.zeros(0, np.int64),) * 4
        query, score, ids, rows = (np.concatenate([p[i] for p in (empty, *self.parts)]) for i in range(4))
        order = np.lexsort((rows, ids, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[rank < self.k]
        full = np.flatnonzero(rank == self.k - 1)
        self.bar[query[full]] = np.maximum(self.bar[query[full]], score[order[full]])
        result = (query[rank < self.k], score[kept], ids[kept], rows[kept])
        self.parts, self.waiting = [result], 0
        return result


def whole_products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, as exact longs.  Beyond 2**53 they are summed as longs;
    a product that no long holds is an error."""
    if not len(queries) or not len(points):
        return np.zeros((len(queries), len(points)), np.int64)
    products = queries @ points.T
    if queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(points).max(initial=0) < 2.0**53:
        return np.rint(products).astype(np.int64)
    if max(np.abs(products).max(), np.abs(queries).max(), np.abs(points).max()) >= 2.0**63 * (1 - 1e-9):
        raise ValueError("an inner product or component does not fit a long")
    return queries.astype(np.int64) @ points.astype(np.int64).T


def search(tree: BallTree, rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, score, id, row) of the k best candidates of each query of a block, by best-first
    branch and bound.  ``floor`` is a known lower bound of each query's final k-th score;
    candidates below it are left out."""
    best, norms = _Best(floor, k), np.sqrt((queries**2).sum(axis=1))
    upper = tree.upper(queries, norms)

    def visit(node: int, which: np.ndarray) -> None:
        a, b = tree.bounds[node]
        scores = whole_products(queries[which], tree.points[a:b])
        q, c = np.nonzero(scores >= best.bar[which][:, None])
        other = rows[which[q]] != tree.rows[a + c]  # not the query's own row
        q, c = q[other], c[other]
        best.add(which[q], scores[q, c], tree.ids[a + c], tree.rows[a + c])

    nodes = [(-np.inf, 0)]
    while nodes:
        _, node = heappop(nodes)
        which = np.flatnonzero(upper[:, node] >= best.bar)
        if not len(which):
            continue
        if tree.children[node] is None:
            visit(node, which)
            best.settle()
            continue
        for child in tree.children[node]:
            heappush(nodes, (-float(upper[which, child].max()), child))
    return best.settle()


class Space:
    """The upper levels of a ball tree: hyperplanes in heap order that lead a vector to its cell."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.depth = max(0, (max(1, cells) - 1).bit_length())
        self.directions = np.zeros(((1 << self.depth) - 1, sample.shape[1]))
        self.cuts = np.zeros(len(self.directions))
        parts = [np.arange(len(sample))]
        for node in range(len(self.directions)):
            own = parts[node]
            x, right = sample[own], np.zeros(len(own), bool)
            if len(own) > 1:
                a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
                b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
                along = x @ (b - a)
                self.directions[node], self.cuts[node] = b - a, np.median(along)
                right = along > self.cuts[node]
            parts += [own[~right], own[right]]

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        dims = min(points.shape[1], self.directions.shape[1])
        for _ in range(self.depth):
            right = (points[:, :dims] * self.directions[node, :dims]).sum(axis=1) > self.cuts[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


_FOUND = T.StructType([
    T.StructField("query_row", T.LongType()), T.StructField("query_id", T.LongType()),
    T.StructField("vec_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("score", T.LongType()),
])


def _pack(name: str):
    """Group function: the rows of a group as one row of blobs; a shard's root ball with them."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        points = _matrix(rows.column("v"))
        numbers, ids = rows.column(ROW_ID).to_numpy(), rows.column("vec_id").to_numpy()
        if name == "shard":
            order = np.concatenate(ball_leaves(points))
            numbers, ids, points = numbers[order], ids[order], points[order]
        centre = points.mean(axis=0)
        radius = np.sqrt(((points - centre) ** 2).sum(axis=1)).max()
        blob = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({
            name: pa.array([key[0].as_py()], pa.int64()), "dims": pa.array([points.shape[1]], pa.int32()), "rows": blob(numbers.astype(np.int64)),
            "ids": blob(ids.astype(np.int64)), "points": blob(points), "centre": blob(centre), "radius": pa.array([radius]),
        })

    return pack


def _packed_type(name: str) -> str:
    return f"{name} long, dims int, rows binary, ids binary, points binary, centre binary, radius double"


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, ids = np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64)
    return rows, ids, np.frombuffer(row["points"]).reshape(len(rows), row["dims"])


def _wide(x: np.ndarray, dims: int) -> np.ndarray:
    return x if x.shape[1] == dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def _floors(row: dict, q_rows: np.ndarray) -> np.ndarray:
    known = dict(row["floor"] or ())
    return np.array([known.get(r, _NO_FLOOR) for r in q_rows.tolist()], np.int64)


_BOUNDS = "block long, shard long, query int, bound double"


def _root_bounds(first: bool):
    """For a block and some shards: each query's shards of highest root bound (``first``), or all pairs of
    query and shard whose root bound reaches the query's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_rows, _, queries = _unpacked(row)
                dims = max([queries.shape[1], *(r["dims"] for r in row["roots"])])
                queries = _wide(queries, dims)
                centres = np.zeros((len(row["roots"]), dims))
                for i, root in enumerate(row["roots"]):
                    centres[i, : root["dims"]] = np.frombuffer(root["centre"])
                spread = np.sqrt((queries**2).sum(axis=1))[:, None] * np.array([r["radius"] for r in row["roots"]])
                bound = queries @ centres.T + spread
                bound += 1e-9 * (1 + np.abs(bound) + spread)
                if first:
                    some = min(FIRST_SHARDS, bound.shape[1])
                    q, s = np.repeat(np.arange(len(queries)), some), np.argsort(-bound, axis=1, kind="stable")[:, :some].ravel()
                else:
                    q, s = np.nonzero(bound >= _floors(row, q_rows)[:, None])
                shards = np.array([r["shard"] for r in row["roots"]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), row["block"], np.int64)), pa.array(shards[s]), pa.array(q.astype(np.int32)), pa.array(bound[q, s])],
                    names=["block", "shard", "query", "bound"],
                )

    return run


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held != row["shard"]:
                    tree, held = BallTree(*_unpacked({n: row[f"s_{n}"] for n in ("dims", "rows", "ids", "points")})), row["shard"]
                q_rows, q_ids, queries = (x[np.array(row["queries"], np.int64)] for x in _unpacked(row))
                dims = max(queries.shape[1], tree.points.shape[1])
                if tree.points.shape[1] < dims:
                    tree.points, tree.centres = _wide(tree.points, dims), _wide(tree.centres, dims)
                q, scores, ids, numbers = search(tree, q_rows, _wide(queries, dims), _floors(row, q_rows), k)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (q_rows[q], q_ids[q], ids, numbers, scores))], names=_FOUND.names)

    return run


def _dealt(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` (with their ``cell``) with ``name``, a number that rows of a cell share: cells in order are
    joined up to about ``size`` rows, and a larger one is split by row number.  Also the number of numbers."""
    counts = sorted(rows.groupBy("cell").count().collect())  # a row per cell: MAX_CELLS at most
    told, number, held = [], 0, 0
    for cell, n in counts:
        if held and held + n > size:
            number, held = number + 1, 0
        parts = max(1, -(-n // size))
        told.append((cell, number, parts))
        number, held = (number + parts, 0) if parts > 1 else (number, held + n)
    total = number + (held > 0)
    cells = rows.sparkSession.createDataFrame(told, "cell long, __first long, __parts long")
    part = F.col("__first") + F.pmod(F.xxhash64(ROW_ID), F.col("__parts"))
    return rows.join(F.broadcast(cells), "cell").withColumn(name, part).drop("__first", "__parts", "cell"), total


def _with_cells(rows: DataFrame, count: int, shard_rows: int) -> DataFrame:
    """``rows`` with the cell of space that each lies in, learnt from about ``SAMPLE_ROWS`` of them."""
    share = min(1.0, SAMPLE_ROWS / max(1, count))
    drawn = rows.filter(F.pmod(F.xxhash64(ROW_ID, F.lit(7)), F.lit(1 << 20)) < share * (1 << 20)).select("v").toArrow()
    sample = _matrix(drawn.column("v")) if drawn.num_rows else np.zeros((0, 0))
    space = Space(sample, min(MAX_CELLS, max(1, -(-count // shard_rows)), max(1, len(sample) // 8)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = space.cell_of(_matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    kind = T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType())])
    return staged(rows.mapInArrow(place, kind), "vectors-in-space")


def top_k(
    vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: for every row that ``is_query`` (a
    condition on ``vec_id``) admits, the ``k`` rows of highest inner product of the
    quantised vectors, all others being candidates; fewer if there are fewer.  Ties go to the
    smaller id.

    Vectors that are null or hold null, NaN or infinite components take no part.  Of
    different lengths, the shorter are filled up with zeros.  Repeated ids are different
    rows: each is a query of its own and a candidate for the others.  Scores are exact longs;
    one that no long holds is an error.
    """
    with_package(vectors.sparkSession)
    rows = quantised(vectors, id_col, vector_col, scale)
    placed = _with_cells(rows, rows.count(), shard_rows)
    dealt, shards = _dealt(placed, shard_rows, "shard")
    blocked, blocks = _dealt(placed.filter(F.coalesce(is_query, F.lit(False))), QUERY_BLOCK, "block")
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    trees = staged(dealt.groupBy("shard").applyInArrow(_pack("shard"), _packed_type("shard")), "ball-trees")
    packed = staged(blocked.groupBy("block").applyInArrow(_pack("block"), _packed_type("block")), "query-blocks")
    shard_side = trees.select("shard", *(F.col(n).alias(f"s_{n}") for n in ("dims", "rows", "ids", "points")))
    root = F.struct("shard", "dims", "centre", "radius")
    chunks = max(1, -(-shards // ROOT_CHUNK))
    roots = staged(trees.groupBy(F.pmod("shard", F.lit(chunks)).alias("chunk")).agg(F.collect_list(root).alias("roots")), "ball-roots")

    def pairs(blocks_with_floor: DataFrame, first: bool) -> DataFrame:
        # Each block meets each chunk of roots once; the chunk number is the join key.
        numbers = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>"))
        met = blocks_with_floor.withColumn("chunk", numbers).join(roots, "chunk").select("block", "dims", "rows", "ids", "points", "floor", "roots")
        bounds = met.mapInArrow(_root_bounds(first), _BOUNDS)
        if first:
            # Of a few shards for each query and chunk, those of highest bound.
            by_bound = Window.partitionBy("block", "query").orderBy(F.col("bound").desc(), "shard")
            bounds = bounds.withColumn("n", F.row_number().over(by_bound)).filter(F.col("n") <= FIRST_SHARDS)
        return bounds.groupBy("block", "shard").agg(F.collect_list("query").alias("queries"))

    def searched(blocks_with_floor: DataFrame, first: bool) -> DataFrame:
        wanted = staged(pairs(blocks_with_floor, first), "shards-to-search")
        met = wanted.join(blocks_with_floor, "block").join(shard_side, "shard")
        met = met.select("shard", "queries", "dims", "rows", "ids", "points", "floor", "s_dims", "s_rows", "s_ids", "s_points")
        return met.mapInArrow(_searcher(k), _FOUND)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = best(searched(packed.withColumn("floor", F.lit(None).cast("map<bigint,bigint>")), True))
    kth = staged(first.filter(F.col("rank") == k).select("query_row", "score"), "kth-scores")
    per_block = (
        blocked.select(F.col(ROW_ID).alias("query_row"), "block").join(kth, "query_row")
        .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("query_row", "score"))).alias("floor"))
    )
    second = best(searched(packed.join(per_block, "block", "left"), False))
    return second.select("query_id", "rank", "vec_id", "score")
