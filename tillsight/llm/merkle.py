"""Merkle manifest of a dataset, stored as van Emde Boas blocks.

Rows are leaves of one tree per key (a language), ordered within it; the roots of these trees
are the leaves of a last tree.  A node is the SHA-256 of up to ``FANOUT`` children, as hex text one after the other.

Trees are stored in aligned blocks of ``8 ** HEIGHT`` leaves.  A block is one row that holds
all its nodes in van Emde Boas order: a subtree is split at half its height, its upper part comes first,
then the lower subtrees from left to right, each laid out the same way.  The place of a node
follows by arithmetic from its height and index (``address``), in incomplete blocks as well, because what is missing there
is always the end of a level.  Building writes nodes to their addresses and proofs read siblings from
theirs.  The roots of blocks are the leaves of the next level of blocks, and so on up to one block
a tree.

No task holds more than a block: rows are put in order by a range partition, numbered by
partition offsets, and dealt to blocks by number, so a key of a third of all rows is many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import staged, with_package

FANOUT = 8
#: Levels of a block above its leaves.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def field(value: Column) -> Column:
    """``bytes:value`` in UTF-8, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest (32 bytes) of a row's values; their lengths keep different rows from looking alike."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def levels_over(n: int) -> int:
    """Levels of a tree over ``n`` leaves, the leaves included."""
    levels = 1
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def nodes_in(levels: int, n: np.ndarray | int) -> np.ndarray | int:
    """Nodes of a subtree of ``levels`` levels over its first ``n`` leaves."""
    return sum(-(-n // FANOUT**t) for t in range(levels))


def address(levels: int, height: int, index: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Places in van Emde Boas order of the nodes ``height`` above the leaves with these indexes from the
    left, in a subtree of ``levels`` levels over ``n`` leaves."""
    index = np.asarray(index, np.int64)
    if levels == 1:
        return np.zeros_like(index)
    low = levels // 2
    above = -(-n // FANOUT**low)  # leaves of the upper part
    if height >= low:
        return address(levels - low, height - low, index, above)
    span, wide = FANOUT ** (low - 1), FANOUT ** (low - 1 - height)
    subtree = index // wide
    start = nodes_in(levels - low, above) + subtree * nodes_in(low, span)  # all lower subtrees but the last are whole
    return start + address(low, height, index - subtree * wide, np.minimum(span, n - subtree * span))


def build_block(leaves: np.ndarray, levels: int) -> np.ndarray:
    """All nodes over ``leaves`` (n, 32), in van Emde Boas order."""
    n = len(leaves)
    out = np.zeros((nodes_in(levels, n), 32), np.uint8)
    level = leaves
    for height in range(levels):
        out[address(levels, height, np.arange(len(level)), n)] = level
        if height < levels - 1:
            text, run = level.tobytes().hex().encode(), FANOUT * _HEX
            parents = b"".join(hashlib.sha256(text[at : at + run]).digest() for at in range(0, len(text), run))
            level = np.frombuffer(parents, np.uint8).reshape(-1, 32)
    return out


def stored_level(nodes: np.ndarray, levels: int, n: int, height: int) -> bytes:
    """One level of a stored block as hex text."""
    return nodes[address(levels, height, np.arange(-(-n // FANOUT**height)), n)].tobytes().hex().encode()


Step = tuple[int, bytes]  # place among its siblings, the siblings as hex text


def steps_up(nodes: np.ndarray, levels: int, n: int, index: int) -> list[Step]:
    """A leaf's siblings, level by level up to the root of its block."""
    steps = []
    for height in range(levels - 1):
        first = index - index % FANOUT
        run = np.arange(first, min(first + FANOUT, -(-n // FANOUT**height)))
        others = nodes[address(levels, height, run[run != index], n)].tobytes().hex().encode()
        steps.append((index - first, others))
        index //= FANOUT
    return steps


def fold(digest: bytes, steps: list[Step]) -> bytes:
    """The root (hex text) that a leaf and its siblings lead to."""
    for place, others in steps:
        at = place * _HEX
        digest = hashlib.sha256(others[:at] + digest + others[at:]).hexdigest().encode()
    return digest


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their number from 0 in the order of their tree (nulls first), and ``size``, its rows."""
    keys = [F.col(tree), *(F.col(c).asc_nulls_first() for c in order), F.col("__tie")]  # equal rows are told apart: they are dealt like others
    placed = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    placed = staged(placed.withColumn("__at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    parts = placed.groupBy(tree, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    of_tree = Window.partitionBy(tree)
    before = of_tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        tree, "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"), F.sum("__n").over(of_tree).alias("size")
    )
    return placed.join(starts, [tree, "__part"]).withColumn("pos", F.col("__start") + F.col("__at") - F.col("__first")).drop("__part", "__at", "__first", "__start", "__n")


def _block_type(kept: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("size", T.LongType()), T.StructField("n", T.IntegerType()),
        T.StructField("levels", T.IntegerType()), T.StructField("root", T.BinaryType()), T.StructField("nodes", T.BinaryType()), T.StructField("kept", T.ArrayType(kept)),
    ])


def blocks_of(nodes: DataFrame, height: int) -> DataFrame:
    """Stored blocks of leaves (``tree``, ``pos``, ``size``, ``digest`` and a struct ``kept``)."""
    span = FANOUT**height
    kind = _block_type(nodes.schema["kept"].dataType)

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos").combine_chunks()
        size, n = rows.column("size")[0].as_py(), rows.num_rows
        levels = levels_over(size) if size <= span else height + 1
        leaves = np.frombuffer(b"".join(rows.column("digest").to_pylist()), np.uint8).reshape(n, 32)
        stored = build_block(leaves, levels)
        root = stored[address(levels, levels - 1, np.zeros(1, np.int64), n)[0]].tobytes()
        kept = rows.column("kept").combine_chunks()
        kept = kept.chunk(0) if isinstance(kept, pa.ChunkedArray) else kept
        lists = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), kept)
        values = ([key[0].as_py()], [key[1].as_py()], [size], [n], [levels], [root], [stored.tobytes()])
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([*(pa.array(v, t) for v, t in zip(values, types, strict=True)), lists], names=kind.names)

    dealt = nodes.withColumn("block", F.floor(F.col("pos") / span)).groupBy("tree", "block")
    return staged(dealt.applyInArrow(build, kind), "merkle-blocks")


def forest(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Levels of blocks over numbered leaves, up to one block a tree."""
    span, levels = FANOUT**height, [blocks_of(leaves, height)]
    largest = levels[0].agg(F.max("size")).collect()[0][0] or 0
    while largest > span:  # the roots of blocks are the leaves of the next level
        roots = levels[-1].filter(F.col("size") > span).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("size") / span).alias("size"), F.col("root").alias("digest"), F.struct(F.col("block")).alias("kept")
        )
        levels.append(blocks_of(roots, height))
        largest = -(-largest // span)
    return levels


def roots_of(levels: list[DataFrame], height: int) -> DataFrame:
    """``tree`` and ``root`` of every tree of a forest."""
    tops = [blocks.filter(F.col("size") <= FANOUT**height).select("tree", "root") for blocks in levels]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


_STEPS = "array<struct<place:int,others:binary>>"


def _stored(row: dict) -> np.ndarray:
    return np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf of a block with the steps from it to the root of all."""
    for batch in batches:
        for row in batch.to_pylist():
            nodes, n, levels = _stored(row), row["n"], row["levels"]
            named = "name" in row["kept"][0]  # leaves of the last tree are roots of trees
            trees = [k["name"] for k in row["kept"]] if named else [row["tree"]] * n
            pos = [0 if named else k["block"] for k in row["kept"]]
            subroots = [bytes.fromhex(d.decode()) for d in _cut(stored_level(nodes, levels, n, 0))] if named else [row["subroot"]] * n
            steps = [[{"place": p, "others": o} for p, o in steps_up(nodes, levels, n, i)] + row["above"] for i in range(n)]
            kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.string()), pa.array(pos, pa.int64()), pa.array(subroots, pa.binary()), pa.array(steps, kind)], names=["tree", "block", "subroot", "above"]
            )


def _cut(text: bytes) -> list[bytes]:
    return [text[at : at + _HEX] for at in range(0, len(text), _HEX)]


def lowest_blocks(levels: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The blocks of a forest's first level, each with ``above``, the steps from its root to the root of
    all, and ``subroot``; ``above`` has both for the root of every tree."""
    span, reached = FANOUT**height, None
    for blocks in reversed(levels):
        met = blocks.filter(F.col("size") <= span).join(above, "tree")
        if reached is not None:
            met = met.unionByName(blocks.filter(F.col("size") > span).join(reached, ["tree", "block"]))
        if blocks is levels[0]:
            return met
        reached = staged(met.mapInArrow(_children, f"tree string, block long, subroot binary, above {_STEPS}"), "merkle-paths")
    raise ValueError("a forest has one level at least")


@dataclass
class Manifest:
    """A dataset's stored blocks: those of its trees and those of the tree over their roots."""

    trees: list[DataFrame]
    top: list[DataFrame]
    height: int
    #: Hex digest of the whole dataset; None if it has no rows.
    root: str | None
    kept: list[str]


def build_manifest(rows: DataFrame, tree_col: str, order_cols: list[str], digest_col: str, keep: list[str], height: int = HEIGHT) -> Manifest:
    """Manifest of ``rows``, whose leaves ``digest_col`` (32 bytes) ascend by ``order_cols`` within each ``tree_col``
    (null is a tree of its own, the first); ``keep`` columns are stored beside the leaves.

    Nulls come first in any order.  Rows equal in their order are put in that of their digests, and
    equal rows are leaves of their own.  An empty table has no trees and no root.
    """
    with_package(rows.sparkSession)
    named = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    thin = staged(rows.select(named.alias("tree"), F.col(digest_col).alias("digest"), F.struct(*keep).alias("kept"), *(F.col(c).alias(f"__o{n}") for n, c in enumerate(order_cols))), "merkle-leaves")
    order = [f"__o{n}" for n in range(len(order_cols))]
    trees = forest(numbered(thin, "tree", [*order, "digest"]).drop(*order), height)
    subroots = roots_of(trees, height).select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.struct(F.col("tree").alias("name")).alias("kept"), F.col("tree").alias("__o0"))
    top = forest(numbered(subroots, "tree", ["__o0"]).drop("__o0"), height)
    found = roots_of(top, height).collect()  # one row, or none
    return Manifest(trees, top, height, found[0]["root"].hex() if found else None, list(keep))


def proofs(manifest: Manifest, claimed: str | None = None, with_steps: bool = False) -> DataFrame:
    """One row per leaf: the kept columns, ``leaf``, ``subroot`` (of its tree), ``root`` and
    ``proof_sha256`` (digest of the siblings on the way from the leaf to the root) as hex text, ``folded_root``, recomputed
    from the kept column ``claimed`` (a digest; the stored leaf without one, or where it is null) with the
    stored siblings, and ``verified``, whether that is the root.  ``with_steps`` adds ``steps``: place and siblings (hex text) by level."""
    root, height = manifest.root, manifest.height
    spark = manifest.top[0].sparkSession
    start = spark.createDataFrame([("", [], None)], f"tree string, above {_STEPS}, subroot binary")
    above = staged(lowest_blocks(manifest.top, start, height).mapInArrow(_children, f"tree string, block long, subroot binary, above {_STEPS}"), "merkle-paths").drop("block")
    blocks = lowest_blocks(manifest.trees, above, height)
    kept_type = blocks.schema["kept"].dataType.elementType
    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    kind = T.StructType([*kept_type.fields, *(T.StructField(c, T.StringType()) for c in texts)])
    if with_steps:
        kind = kind.add("steps", T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("others", T.StringType())])))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_lists = batch.column("kept")
            for at, row in enumerate(batch.drop_columns(["kept"]).to_pylist()):
                kept = kept_lists.slice(at, 1).flatten()
                nodes, n, levels = _stored(row), row["n"], row["levels"]
                stored = [stored_level(nodes, levels, n, t) for t in range(levels)]
                higher = [(s["place"], s["others"]) for s in row["above"]]
                leaves = _cut(stored[0])
                wanted = kept.field(claimed).to_pylist() if claimed else [None] * n
                folded = [_fold_stored(leaves[i] if w is None else w.hex().encode(), stored, i, higher) for i, w in enumerate(wanted)]
                proof = [hashlib.sha256(p).hexdigest() for p in _siblings(stored, b"".join(o for _, o in higher))]
                columns = [
                    *kept.flatten(), pa.array([d.decode() for d in leaves]), pa.array([row["subroot"].hex()] * n), pa.array([root] * n),
                    pa.array(proof), pa.array([d.decode() for d in folded]),
                ]
                if with_steps:
                    steps = [[{"place": p, "others": o.decode()} for p, o in steps_up(nodes, levels, n, i) + higher] for i in range(n)]
                    columns.append(pa.array(steps, pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))))
                yield pa.RecordBatch.from_arrays(columns, names=kind.names)

    out = blocks.select("n", "levels", "nodes", "kept", "subroot", "above").mapInArrow(prove, kind)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _siblings(stored: list[bytes], above: bytes) -> list[bytes]:
    """For each leaf of a block all siblings up to the root, one after the other; leaves share the texts above them."""
    texts = [above]
    for level in reversed(stored[:-1]):
        run = FANOUT * _HEX
        texts = [level[at - at % run : at] + level[at + _HEX : at - at % run + run] + texts[at // run] for at in range(0, len(level), _HEX)]
    return texts


def _fold_stored(digest: bytes, stored: list[bytes], index: int, higher: list[Step]) -> bytes:
    """``fold`` with siblings taken from the levels of a block, then the steps above it."""
    for level in stored[:-1]:
        at = index * _HEX
        first = at - at % (FANOUT * _HEX)
        digest = hashlib.sha256(level[first:at] + digest + level[at + _HEX : first + FANOUT * _HEX]).hexdigest().encode()
        index //= FANOUT
    return fold(digest, higher)
