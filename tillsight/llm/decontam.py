"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a segment holds, for a few megabytes of whole
documents, the postings of every token (sorted distinct term hashes, where each
term's list starts, and all positions) as one row of a stored table, so it is built once
without a shuffle and can answer any number of benchmarks.  Neighbouring documents are
kept one empty position apart, so that no phrase crosses them.

The benchmark's windows are its phrases.  How often its terms occur in the corpus is
summed over the index first.  A window is then looked up by its rarest term: the
positions of that term, shifted to the window's start, are intersected with the shifted
lists of the other terms, rarer ones first.  What survives all lists is an exact phrase
match; what has every term within ``slop`` positions of the rarest one, in any order, is
a proximity match.

Words are compared by 64-bit hashes.  The benchmark is a table like any other: tasks pack its
items into stored blocks of at most ``BLOCK_WORDS`` words (one item at least), with their windows
and terms; one pass over the index counts the terms of all blocks.  The driver hands one packed block after
the other to the tasks, and what they find is added to one stored table, so neither plans nor
the driver's memory grow with the benchmark.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import ROW_ID, hash_words, ranges, staged, text_buffers, with_package, with_row_ids, word_spans
from tillsight.llm.pii import _bit_set, _slots
from tillsight.plans.scratch import new_run_dir

WINDOW = 10
SLOP = 20
SEGMENT_BYTES = 4 << 20
BLOCK_WORDS = 200_000
CANDIDATES = 1 << 20

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[48:58] = _WORD_BYTES[65:91] = _WORD_BYTES[97:123] = True
_WORD_BYTES[128:] = True


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` (A-Z folded) and the number of words of each text."""
    data, offsets = text_buffers(texts)
    starts, ends = word_spans(data, offsets, _WORD_BYTES)
    return hash_words(data, starts, ends, True), np.diff(np.searchsorted(starts, offsets))


def _segments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive documents of about ``SEGMENT_BYTES`` together, one document at least."""
    _, offsets = text_buffers(batch.column(1))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of all rows of ``docs``, one row per segment: ``doc_ids`` and
    ``n_words`` of its documents in order, and the postings (``terms`` as sorted uint64,
    ``starts`` and ``positions`` as int32, little-endian).  Null texts have no words;
    null or repeated ids are kept row by row."""
    with_package(docs.sparkSession)
    ids = T.ArrayType(docs.schema[id_col].dataType)
    schema = T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("doc_ids", ids), T.StructField("n_words", T.ArrayType(T.IntegerType())),
        T.StructField("terms", T.BinaryType()), T.StructField("starts", T.BinaryType()), T.StructField("positions", T.BinaryType()),
    ])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _segments(batch):
                hashes, counts = word_hashes(part.column(1))
                position = (np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)).astype(np.int32)
                order = np.argsort(hashes, kind="stable")
                ordered = hashes[order]
                first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
                doc_ids = part.column(0)
                lists = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.ListArray.from_arrays(lists, doc_ids),
                    pa.ListArray.from_arrays(lists, pa.array(counts, pa.int32())),
                    pa.array([ordered[first].tobytes()], pa.binary()), pa.array([first.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([position[order].tobytes()], pa.binary()),
                ], names=[f.name for f in schema])
                number += 1

    return staged(docs.select(id_col, text_col).mapInArrow(index, schema), "positional-index")


class PhraseBlock:
    """Distinct windows of a block of benchmark items, by length, with the items of each."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int) -> None:
        by_words: dict[bytes, set[int]] = {}
        self.item_ids = [i for i, _ in items]
        for n, (_, words) in enumerate(items):
            for at in range(max(1, len(words) - window + 1)):
                by_words.setdefault(words[at : at + window].tobytes(), set()).add(n)
        self.terms = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
        self.groups: list[tuple[np.ndarray, list[list[int]]]] = []
        for length in sorted({len(k) // 8 for k in by_words}):
            own = [(k, sorted(v)) for k, v in by_words.items() if len(k) == 8 * length]
            words = np.frombuffer(b"".join(k for k, _ in own), np.uint64).reshape(-1, length)
            self.groups.append((np.searchsorted(self.terms, words).astype(np.int32), [v for _, v in own]))
        self.frequency = np.zeros(len(self.terms), np.int64)


def phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """The benchmark as a stored table of packed ``PhraseBlock`` rows: ``block``, ``packed``."""
    most = BLOCK_WORDS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, words = [], 0

        def row() -> pa.RecordBatch:
            packed = pickle.dumps(PhraseBlock(held, window))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed], pa.binary())], names=["block", "packed"])

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own, _ = word_hashes(pa.array([text.as_py()], pa.string()))
                if held and words + len(own) > most:
                    yield row()
                    held, words, number = [], 0, number + 1
                if len(own):
                    held.append((item, own))
                    words += len(own)
        if held:
            yield row()

    with_package(benchmark.sparkSession)
    return staged(benchmark.select(id_col, text_col).mapInArrow(pack, "block long, packed binary"), "phrase-blocks")


class Segment:
    """The postings of a segment, for offset-adjusted intersection."""

    def __init__(self, terms: bytes, starts: bytes, positions: bytes, counts: np.ndarray) -> None:
        self.terms = np.frombuffer(terms, np.uint64)
        self.starts = np.frombuffer(starts, np.int32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.int32)
        self.counts = np.diff(np.concatenate((self.starts, [len(self.positions)])))
        self.doc_starts = np.concatenate(([0], np.cumsum(counts.astype(np.int64) + 1)))
        self.span = int(self.doc_starts[-1]) + 1
        # Ascending, as positions ascend within a term: one search finds a term at a position.
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) * self.span + self.positions

    def ranks(self, terms: np.ndarray) -> np.ndarray:
        """Rank of each term here, -1 if it does not occur."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the term occurs at a position from ``low`` to ``high``."""
        at = np.searchsorted(self.keys, rank * self.span + low)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= rank * self.span + high)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, position, "right") - 1


def _matches(segment: Segment, windows: np.ndarray, rarest: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(window, start) of phrase matches and (window, position of the rarest term) of
    proximity matches; ``windows`` holds the ranks of each window's terms, ``rarest`` their
    offsets from the rarest on."""
    length = windows.shape[1]
    alive = np.flatnonzero((windows >= 0).all(axis=1))
    if not len(alive):
        return
    rarest = rarest[alive]
    lists = segment.counts[windows[alive, rarest[:, 0]]]
    until, at = np.cumsum(lists), 0
    while at < len(alive):
        before = until[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(until, before + CANDIDATES, "right")))
        n = lists[at:to]
        own = np.repeat(np.arange(at, to), n)
        lead = rarest[own, 0]
        position = segment.positions[ranges(segment.starts[windows[alive[at:to], rarest[at:to, 0]]], n)].astype(np.int64)
        start = position - lead
        keep = np.flatnonzero(start >= 0)
        for k in range(1, length):
            off = rarest[own[keep], k]
            there = start[keep] + off
            keep = keep[segment.has(windows[alive[own[keep]], off], there, there)]
        doc = segment.doc_of(position)
        low, high = np.maximum(position - slop, segment.doc_starts[doc]), np.minimum(position + slop, segment.doc_starts[doc + 1] - 2)
        near = np.arange(len(own)) if slop else keep
        for k in range(1, length if slop else 0):
            near = near[segment.has(windows[alive[own[near]], rarest[own[near], k]], low[near], high[near])]
        yield alive[own[keep]], start[keep], alive[own[near]], position[near]
        at = to


def _match_segment(segment: Segment, block: PhraseBlock, slop: int) -> Iterator[tuple[int, list, list[int], list[int]]]:
    """(document, merged word spans, items with a phrase match, items with a proximity match)."""
    ranks = segment.ranks(block.terms)
    edges = np.zeros(segment.span + 1, np.int32)  # +1 where a match begins, -1 behind its end
    exact: dict[int, set[int]] = {}
    near: dict[int, set[int]] = {}
    for windows, items in block.groups:
        length = windows.shape[1]
        rarest = np.argsort(block.frequency[windows], axis=1, kind="stable")
        for won, start, near_won, position in _matches(segment, ranks[windows], rarest, slop):
            np.add.at(edges, start, 1)
            np.add.at(edges, start + length, -1)
            for found, w, d in ((exact, won, segment.doc_of(start)), (near, near_won, segment.doc_of(position))):
                for one, doc in set(zip(w.tolist(), d.tolist(), strict=True)):
                    found.setdefault(doc, set()).update(items[one])
    covered = np.cumsum(edges) > 0
    turn = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    docs = segment.doc_of(starts)
    for doc in sorted(exact.keys() | near.keys()):
        a, b = np.searchsorted(docs, (doc, doc + 1))
        base = int(segment.doc_starts[doc])
        spans = [{"first": int(s) - base, "last": int(e) - 1 - base} for s, e in zip(starts[a:b], ends[a:b], strict=True)]
        yield doc, spans, sorted(exact.get(doc, ())), sorted(near.get(doc, ()))


def _block_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            terms = pickle.loads(packed).terms.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(terms), number)), pa.array(np.arange(len(terms), dtype=np.int32)), pa.array(terms)], names=["block", "at", "term"]
            )


def with_frequencies(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``frequency``: how often each of a block's terms, in their order, occurs in the indexed documents.
    One pass over the index counts the terms of all blocks."""
    terms = staged(blocks.mapInArrow(_block_terms, "block long, at int, term long"), "phrase-terms")
    shared = index.sparkSession.sparkContext.broadcast(_bit_set(terms.select("term")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            for row in batch.to_pylist():
                own, starts = np.frombuffer(row["terms"], np.int64), np.frombuffer(row["starts"], np.int32)
                here = np.flatnonzero(wanted[_slots(own)])
                counts = np.diff(np.append(starts, row["n"]))
                yield pa.RecordBatch.from_arrays([pa.array(own[here]), pa.array(counts[here].astype(np.int64))], names=["term", "n"])

    words = F.aggregate("n_words", F.lit(0).cast("long"), lambda a, n: a + n)
    seen = index.select("terms", "starts", words.alias("n")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = terms.join(seen, "term", "left").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))).alias("f"))
    return staged(blocks.join(found, "block").select("block", "packed", F.col("f.n").alias("frequency")), "counted-phrase-blocks")


def find_matches(
    index: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text",
    window: int = WINDOW, slop: int = SLOP,
) -> DataFrame:
    """One row per indexed document: ``id_col``, ``n_words``, ``spans`` (first and last word of
    each stretch inside phrase matches), ``n_hit`` (words in them), ``item_ids`` (distinct
    items with a phrase match, as sorted strings) and ``near_item_ids`` (with a proximity match).

    A window is ``window`` consecutive words of an item; a shorter item is one window,
    one without words none.  With ``slop`` 0 only phrases are looked for.  Null item ids
    count as the empty string, repeated ones as one; an empty benchmark matches nothing.
    """
    spark = with_package(index.sparkSession)
    item_type = benchmark.schema[item_col].dataType
    found_schema = T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("ordinal", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(item_type)), T.StructField("near", T.ArrayType(item_type)),
    ])

    def search(shared) -> DataFrame:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            packed, frequency = shared.value
            block, out = pickle.loads(packed), to_arrow_schema(found_schema)
            block.frequency = np.frombuffer(frequency, np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    segment = Segment(row["terms"], row["starts"], row["positions"], np.array(row["n_words"], np.int64))
                    name = block.item_ids.__getitem__
                    rows = [
                        {"segment": row["segment"], "ordinal": doc, "spans": spans, "items": [*map(name, items)], "near": [*map(name, near)]}
                        for doc, spans, items, near in _match_segment(segment, block, slop)
                    ]
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

        return index.select("segment", "n_words", "terms", "starts", "positions").mapInArrow(match, found_schema)

    documents = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "__doc")).select(
        "segment", "ordinal", F.col("__doc.doc_ids").alias(id_col), F.col("__doc.n_words").cast("long").alias("n_words")
    )
    path = new_run_dir(spark, "phrase-matches")
    spark.createDataFrame([], found_schema).write.parquet(path)
    for block in with_frequencies(index, phrase_blocks(benchmark, item_col, item_text, window)).toLocalIterator():
        shared = spark.sparkContext.broadcast((bytes(block["packed"]), np.array(block["frequency"], np.int64).tobytes()))
        search(shared).write.mode("append").parquet(path)
        shared.unpersist()
    found = spark.read.schema(found_schema).parquet(path)
    texts = lambda items: F.array_sort(F.array_distinct(F.transform(F.flatten(F.collect_list(items)), lambda i: F.coalesce(i.cast("string"), F.lit("")))))
    found = found.groupBy("segment", "ordinal").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), texts("items").alias("item_ids"), texts("near").alias("near_item_ids")
    )
    # Spans of different blocks may overlap: count each word once.
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(a["last"], s["first"] - 1))).alias("n"), F.greatest(a["last"], s["last"]).alias("last")
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("last"))
    found = found.withColumn("n_hit", F.aggregate("spans", start, step, lambda a: a["n"]).cast("long"))
    none = F.array().cast("array<string>")
    return documents.join(found, ["segment", "ordinal"], "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("spans", F.array().cast(found_schema["spans"].dataType)).alias("spans"),
        F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("near_item_ids", none).alias("near_item_ids"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` (all their columns) without an exact occurrence of a benchmark
    window; null and empty texts stay."""
    numbered = with_row_ids(docs)
    matches = find_matches(build_index(numbered, ROW_ID, text_col), benchmark, ROW_ID, item_col, item_text, window, slop=0)
    return numbered.join(matches.filter("n_hit > 0").select(ROW_ID), ROW_ID, "left_anti").drop(ROW_ID)
