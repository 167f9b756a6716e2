"""Sharding by minimax contiguous partition.

Rows that must stay together form an atomic group.  Groups are ordered by a
60-bit digest of what they share, and the order is cut into ``n_shards``
contiguous runs whose largest run is as small as any such cut allows.  The
smallest feasible capacity is found by binary search; a capacity is checked by
filling shards greedily.

The check runs over a summary of the order: blocks of consecutive digests with
their bytes and group counts.  A cut at a block edge is a true cut, so a
capacity that is feasible on block edges is feasible; a capacity that fails
even when every block could be cut anywhere is infeasible.  What lies between
is settled by splitting just those blocks in which a cut can fall, until the
two bounds meet, so the result is exact while the driver holds a bounded
summary (``2 ** FIRST_BITS`` blocks, then ``SPLIT_TOTAL`` more a round),
however many rows there are.  A row's shard then follows from its own digest and the
cuts: rows are neither joined nor shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import staged

KEY_BITS = 60
FIRST_BITS = 14
SPLIT_TOTAL = 1 << 16
SLOT_CHUNK = 1 << 15


def group_key(shared: Column) -> Column:
    """Order key of an atomic group: the first 60 bits of the SHA-256 of ``shared``
    (null is taken as empty)."""
    digest = F.sha2(F.coalesce(shared.cast("string"), F.lit("")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


@dataclass
class Blocks:
    """Consecutive blocks of the order: first key, key bits not fixed by the block,
    bytes and groups.  Empty blocks are left out."""

    first: np.ndarray
    free_bits: np.ndarray
    size: np.ndarray
    groups: np.ndarray

    def __post_init__(self) -> None:
        self.edge = np.concatenate(([0], np.cumsum(self.size)))  # exclusive prefix sums

    @property
    def total(self) -> int:
        return int(self.edge[-1])

    def cuts_on_edges(self, capacity: int, at: int = 0, shards: int | None = None) -> list[int] | None:
        """Greedy cuts (as edge numbers) with every shard within ``capacity``; None if a
        block is larger than that or ``shards`` do not suffice."""
        cuts, last = [], len(self.size)
        while at < last:
            to = int(np.searchsorted(self.edge, self.edge[at] + capacity, "right")) - 1
            if to == at or (shards is not None and len(cuts) == shards):
                return None
            cuts.append(at := to)
        return cuts

    def cuts_anywhere(self, capacity: int) -> list[int]:
        """Positions that no greedy cut of ``capacity`` can lie beyond."""
        cuts, at = [], 0
        while at < self.total:
            b = min(int(np.searchsorted(self.edge, at + capacity, "right")) - 1, len(self.size))
            sure = b == len(self.size) or self.groups[b] == 1
            to = int(self.edge[b]) if sure else at + capacity
            cuts.append(at := max(to, at + 1))
        return cuts


def _sizes(groups: DataFrame, size: str, block: Column) -> list:
    return groups.groupBy(block.alias("__b")).agg(F.sum(size).alias("__s"), F.count(F.lit(1)).alias("__n")).collect()


def _first_blocks(groups: DataFrame, key: str, size: str) -> Blocks:
    free = KEY_BITS - FIRST_BITS
    rows = sorted(_sizes(groups, size, F.shiftright(F.col(key), free)))
    b, s, n = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    return Blocks(b << free, np.full(len(b), free, np.int64), s, n)


def _split(blocks: Blocks, which: np.ndarray, groups: DataFrame, key: str, size: str) -> Blocks:
    """``blocks`` with those of ``which`` split into up to ``SPLIT_TOTAL`` parts in all."""
    spark = groups.sparkSession
    bits = max(1, int(np.log2(max(2, SPLIT_TOTAL // len(which)))))
    rows: list = []
    for free in sorted({int(f) for f in blocks.free_bits[which]}):
        own = which[blocks.free_bits[which] == free]
        prefixes = [(int(blocks.first[i]) >> free,) for i in own]
        near = groups.filter(F.col(key).between(int(blocks.first[own].min()), int(blocks.first[own].max()) + (1 << free) - 1))
        # Bounded: one row per block to split, of which there are at most all blocks.
        wanted = F.broadcast(spark.createDataFrame(prefixes, "__p long"))
        inside = near.withColumn("__p", F.shiftright(F.col(key), free)).join(wanted, "__p", "left_semi")
        left = max(0, free - bits)
        found = _sizes(inside, size, F.shiftright(F.col(key), left))
        rows += [(r[0] << left, left, r[1], r[2]) for r in found]
    keep = np.setdiff1d(np.arange(len(blocks.size)), which)
    new = [np.array([r[i] for r in rows], np.int64) for i in range(4)]
    first = np.concatenate((blocks.first[keep], new[0]))
    order = np.argsort(first, kind="stable")
    cols = ((blocks.free_bits, new[1]), (blocks.size, new[2]), (blocks.groups, new[3]))
    return Blocks(first[order], *(np.concatenate((old[keep], x))[order] for old, x in cols))


def _bounds(blocks: Blocks, shards: int, lo: int, hi: int) -> tuple[int, int]:
    """Binary searches: the largest bound below which no capacity is feasible, and the
    smallest capacity that is feasible on block edges."""
    a, b = lo, hi
    while a < b:
        mid = (a + b) // 2
        a, b = (a, mid) if len(blocks.cuts_anywhere(mid)) <= shards else (mid + 1, b)
    least, (a, b) = a, (a, hi)
    while a < b:
        mid = (a + b) // 2
        a, b = (a, mid) if blocks.cuts_on_edges(mid, shards=shards) is not None else (mid + 1, b)
    return least, a


def _where(blocks: Blocks, least: int, most: int) -> np.ndarray:
    """Blocks of several groups in which a greedy cut of a capacity in [least, most] can
    fall; first of all those that are themselves too large for a shard."""
    several = (blocks.groups > 1) & (blocks.free_bits > 0)
    if (several & (blocks.size > least)).any():
        return np.flatnonzero(several & (blocks.size > least))
    lows, at = [], 0
    while at < len(blocks.size):
        at = int(np.searchsorted(blocks.edge, blocks.edge[at] + least, "right")) - 1
        lows.append(int(blocks.edge[at]))
    marked = np.zeros(len(blocks.size), bool)
    for low, high in zip(lows, blocks.cuts_anywhere(most), strict=False):
        a = max(0, int(np.searchsorted(blocks.edge, low, "right")) - 1)
        marked[a : int(np.searchsorted(blocks.edge, max(low, high), "left")) + 1] = True
    return np.flatnonzero(marked & several)


def _even_cuts(blocks: Blocks, capacity: int, shards: int) -> list[int]:
    """Cuts within ``capacity``, each as near as the rest allows to an even share of what
    is left, so that one oversized group does not leave other shards empty."""
    cuts, at, last = [], 0, len(blocks.size)
    for left in range(shards, 1, -1):
        if at >= last:
            break
        greedy = int(np.searchsorted(blocks.edge, blocks.edge[at] + capacity, "right")) - 1
        ideal = blocks.edge[at] + (blocks.total - blocks.edge[at]) / left
        near = int(np.searchsorted(blocks.edge, ideal))
        if near > at + 1 and ideal - blocks.edge[near - 1] <= blocks.edge[min(near, last)] - ideal:
            near -= 1
        a, b = min(max(at + 1, near), greedy), greedy
        while a < b:  # a later cut leaves less to fit
            mid = (a + b) // 2
            fits = blocks.cuts_on_edges(capacity, mid, left - 1) is not None
            a, b = (a, mid) if fits else (mid + 1, b)
        cuts.append(at := a)
    return cuts


def minimax_cuts(groups: DataFrame, n_shards: int, key: str = "__key", size: str = "__size") -> tuple[list[int], int]:
    """First keys of the second and later shards, and the smallest feasible capacity,
    for a table of one row per atomic group (``key`` a long of 60 bits, ``size`` > 0)."""
    blocks = _first_blocks(groups, key, size)
    if not blocks.total:
        return [], 0
    largest = int(groups.agg(F.max(size)).collect()[0][0])
    lo = max(largest, -(-blocks.total // n_shards))
    hi = lo + largest  # any greedy shard but the last holds more than hi - largest
    while True:
        # An edge-feasible capacity may lie above hi while blocks are coarse.
        least, most = _bounds(blocks, n_shards, lo, max(hi, int(blocks.size.max()) + lo))
        if least >= most:
            break
        which = _where(blocks, least, min(most, hi))
        if not len(which):
            break
        lo, hi = least, min(hi, most)
        blocks = _split(blocks, which, groups, key, size)
    return [int(blocks.first[c]) for c in _even_cuts(blocks, most, n_shards) if c < len(blocks.size)], most


def shard_of(key: Column, cuts: list[int]) -> Column:
    """The shard of a digest: the number of cuts at or below it."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c <= key))


def group_sizes(rows: DataFrame) -> DataFrame:
    """One row per atomic group; copies are summed before they are shuffled."""
    return staged(rows.groupBy("__key").agg(F.sum("__size").alias("__size")), "shard-groups")


def shard_by_size(docs: DataFrame, n_shards: int, shared: Column, size: Column) -> DataFrame:
    """``docs`` with a ``shard`` column (an input column of that name is replaced): rows
    of equal ``shared`` stay together, and the largest shard by ``size`` is as small as
    contiguous cuts of the digest order allow.

    Nulls: a null ``shared`` is taken as empty, so such rows stay with empty ones.
    Empty tables give no rows; with fewer groups than shards some shards stay empty.
    """
    rows = docs.select(group_key(shared).alias("__key"), size.alias("__size"))
    cuts, _ = minimax_cuts(group_sizes(rows), n_shards)
    return docs.withColumn("shard", shard_of(group_key(shared), cuts).cast("int"))


def with_slots(rows: DataFrame, shard: Column, slot: str = "slot") -> DataFrame:
    """``rows`` (read from files) with ``shard`` and a gapless number from 0 within it, by file and
    row order.  Rows are numbered within bounded chunks of a file, whose starts are
    running sums of counts, so neither a large shard nor repeated rows meet in a task."""
    chunk = (F.col("_metadata.row_index") / SLOT_CHUNK).cast("long")
    placed = rows.select("*", shard.alias("shard"), F.col("_metadata.file_name").alias("__file"), chunk.alias("__chunk"), F.col("_metadata.row_index").alias("__row"))
    part = ["shard", "__file", "__chunk"]
    earlier = Window.partitionBy("shard").orderBy("__file", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
        .select(*part, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    )
    within = F.row_number().over(Window.partitionBy(*part).orderBy("__row")) - 1
    return (
        placed.withColumn("__within", within).join(starts, part)
        .withColumn(slot, (F.col("__start") + F.col("__within")).cast("long"))
        .drop("__file", "__chunk", "__row", "__within", "__start")
    )
