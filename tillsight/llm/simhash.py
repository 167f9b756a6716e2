"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

Equal fingerprints collapse first, so copies of a text, however many, are one entry.  A
fingerprint is cut into ``BLOCKS`` blocks of bits; two that differ in at most ``distance``
bits agree on at least ``BLOCKS - distance`` whole blocks, so each choice of that many
blocks is a key, and every pair to be found shares at least one key.  The keys fix about
32 of 64 bits.  Entries meet on a key in a sorted stream; there the Hamming distance is
computed, and the entries of a key give a spanning forest of its links, never all pairs.

A key with over ``BUCKET`` entries is not compared in one place: such keys are found by counting before
anything meets, and their entries are dealt by the same rule applied to the bits the key leaves free, which
fixes about half of them too, so that what then meets is bounded by the number of values
the last bits can take (15 to 18 bits: 262,144 at most).

Components come from alternating large-star and small-star rounds over the links, each
round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import ROW_ID, staged, with_package, with_row_ids

SHINGLE = 3
DISTANCE = 3
BLOCKS = 6
BUCKET = 1 << 12
#: One in so many fingerprints is counted to find crowded keys; up to ``SMALL`` of these are broadcast.
COUNTED = 1 << 4
SMALL = 100_000
SEED = 42
_SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z folded, words between ASCII white space, the
    XXH64 of every ``shingle`` words (repeats count; fewer words are one shingle).  A bit is
    set if over half of the hashes have it; no words give 0."""
    words = text.lower().split()  # on bytes both mean ASCII only: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = ends[len(words) - n :]
    first = (ends - lengths)[:n]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        spans = zip(first[at : at + _SLICE].tolist(), last[at : at + _SLICE].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, min(_SLICE, n - at))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint as a signed long) of every row; null texts have no words."""
    with_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType(), False)])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(1)):
                out[i] = fingerprint(text.as_buffer().to_pybytes(), shingle) if text.is_valid else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(compute, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """For each choice of ``blocks - distance`` blocks of the bit positions, their mask."""
    parts = [bits[i * len(bits) // blocks : (i + 1) * len(bits) // blocks] for i in range(blocks)]
    return [sum(1 << b for p in chosen for b in p) for chosen in combinations(parts, blocks - distance)]


def key_masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """Masks of the keys: any two fingerprints within ``distance`` bits agree under one of them."""
    return _masks(list(range(64)), blocks, distance)


def second_masks(mask: int, distance: int, blocks: int) -> list[int]:
    """Masks that deal a key's entries again: the key's own bits and, of the free ones, as above."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | m for m in _masks(free, blocks, distance)]


def spanning_links(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b) within ``distance`` bits that connect whatever such links connect."""
    waiting = fps
    while len(waiting):
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and len(waiting):
            one = frontier.pop()
            near = np.bitwise_count(waiting ^ one) <= distance
            if near.any():
                found = waiting[near]
                waiting = waiting[~near]
                frontier.extend(found)
                yield np.full(len(found), one, np.uint64), found


_MET = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("again", T.IntegerType())])


def _met(distance: int, bucket: int | None = None, seconds: list[list[int]] | None = None):
    """Task that reads (key, masked, fp) sorted by the first two and gives links
    (a, b, null).  For a key with over ``bucket`` entries it gives those instead, dealt again:
    (fp, masked, key) for each of the key's ``seconds``."""

    def give(a: np.ndarray, b: np.ndarray, key: int | None) -> pa.RecordBatch:
        again = pa.nulls(len(a), pa.int32()) if key is None else pa.array(np.full(len(a), key, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), again], names=["a", "b", "again"])

    def run(keys: np.ndarray, masked: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (masked[1:] != masked[:-1]), [True])))
        for i in np.flatnonzero(np.diff(edges) > 1):
            own = fps[edges[i] : edges[i + 1]]
            if bucket is not None and len(own) > bucket:
                key = int(keys[edges[i]])
                for n, mask in enumerate(seconds[key]):
                    yield give(own, own & np.uint64(mask), key * len(seconds[key]) + n)
                continue
            links = [*spanning_links(own, distance)]
            if links:
                yield give(np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links]), None)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now = (cols[0].copy(), cols[1].copy(), cols[2].view(np.uint64).copy())
            if not len(now[0]):
                continue
            if held and (held[-1][0][-1], held[-1][1][-1]) == (now[0][-1], now[1][-1]):
                held.append(now)  # all one key so far, or at least an open one
                continue
            keys, masked, fps = (np.concatenate([*(h[i] for h in held), now[i]]) for i in range(3))
            tail = int(np.flatnonzero((keys != keys[-1]) | (masked != masked[-1]))[-1] + 1) if (keys[0], masked[0]) != (keys[-1], masked[-1]) else 0
            yield from run(keys[:tail], masked[:tail], fps[:tail]) if tail else ()
            held = [(keys[tail:], masked[tail:], fps[tail:])]
        if held:
            yield from run(*(np.concatenate([h[i] for h in held]) for i in range(3)))

    return compute


def _meet(dealt: DataFrame, task) -> DataFrame:
    return dealt.repartition("key", "masked").sortWithinPartitions("key", "masked", "fp").mapInArrow(task, _MET)


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Verified links ``u`` > ``v`` between distinct fingerprints ``fp`` (one row each) within
    ``distance`` bits: not all of them, but enough to connect all that they connect."""
    with_package(fps.sparkSession)
    masks = key_masks(distance, blocks)
    keys = F.array(*(F.struct(F.lit(k).alias("key"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("masked")) for k, m in enumerate(masks)))
    dealt = fps.select("fp", F.explode(keys).alias("k")).select("k.key", "k.masked", "fp")
    seconds = [second_masks(m, distance, blocks) for m in masks]
    crowded = crowded_keys(dealt, bucket)
    apart, again = dealt, None
    if crowded is not None:
        apart = dealt.join(crowded, ["key", "masked"], "left_anti")
        of_key = F.array(*(F.array(*(F.lit(_signed(m)) for m in own)) for own in seconds))
        redealt = dealt.join(crowded, ["key", "masked"], "left_semi").select("key", "fp", F.posexplode(F.get(of_key, F.col("key"))).alias("n", "mask"))
        again = redealt.select((F.col("key") * len(seconds[0]) + F.col("n")).alias("key"), F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")
    first = staged(_meet(apart, _met(distance, bucket, seconds)), "simhash-met")
    found_so = first.filter("again IS NOT NULL").select(F.col("again").alias("key"), F.col("b").alias("masked"), F.col("a").alias("fp"))
    second = _meet(found_so if again is None else again.unionByName(found_so), _met(distance))
    pairs = first.filter("again IS NULL").select("a", "b").unionByName(second.select("a", "b"))
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def crowded_keys(dealt: DataFrame, bucket: int) -> DataFrame | None:
    """``key`` and ``masked`` of the keys that seem to have over ``bucket`` entries, judged by one in ``COUNTED``
    fingerprints; None if none does.  These are dealt by their second masks before anything is shuffled.
    Either way of dealing finds all links of a key; one that is crowded and was not seen here is dealt again by
    the task that meets it."""
    some = dealt.filter(F.pmod(F.xxhash64("fp"), F.lit(COUNTED)) == 0)
    found = staged(some.groupBy("key", "masked").count().filter(F.col("count") * (2 * COUNTED) > bucket).select("key", "masked"), "crowded-keys")
    n = found.count()
    return None if not n else F.broadcast(found) if n <= SMALL else found


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every other node of the links
    ``u`` > ``v``.  Alternating large-star and small-star rounds until nothing changes; the
    number of rounds grows with the logarithm of the longest chain."""
    edges = staged(edges, "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every edge now has u > v; small-star moves a node's other neighbours to the least.
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.distinct(), "components")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if tuple(state) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` (the smallest id reachable over links, its
    own included) of every row.

    Null and empty texts have fingerprint 0, which links like any other.  Equal rows get
    equal results; null ids take no part in the minimum (all null: null).  An empty table
    gives no rows.
    """
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min(id_col).alias("__least")), "distinct-fingerprints")
    found = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "__least", F.coalesce("root", "fp").alias("__root"))
    labels = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = staged(rooted.join(labels, "__root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(named, "fp").select(id_col, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` (all their columns), one per component: that with the smallest
    (non-null first) id, of several such rows one."""
    numbered = with_row_ids(docs)
    # Rows are told apart by their number; (id, number) orders them.
    keyed = numbered.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(ROW_ID).alias("row")).alias("__key"), text_col)
    found = near_duplicates(keyed, "__key", text_col, shingle, distance)
    stay = found.filter(F.col("__key") == F.col("component_id")).select(F.col("__key.row").alias(ROW_ID))
    return numbered.join(stay, ROW_ID, "left_semi").drop(ROW_ID)
