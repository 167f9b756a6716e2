"""Helpers shared by the operators: staged tables, text digests, Arrow text buffers, word hashing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.plans.scratch import new_run_dir

ROW_ID = "__tillsight_row"
_shipped: set[str] = set()


def with_package(spark: SparkSession) -> SparkSession:
    """``spark``, whose Python workers can import this package: it is sent to the executors
    once per application, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = os.path.join(tempfile.mkdtemp(prefix="tillsight-package-"), "tillsight_package.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, source.relative_to(root.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def staged(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: lineage is
    cut and a lost executor costs nothing that was already written."""
    spark = df.sparkSession
    path = new_run_dir(spark, purpose)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def with_row_ids(df: DataFrame) -> DataFrame:
    """``df`` with a unique ``ROW_ID``, fixed by writing the numbered rows once, so
    that null or repeated document ids never merge two rows."""
    return staged(df.withColumn(ROW_ID, F.monotonically_increasing_id()), "numbered")


def utf8_bytes(text: Column) -> Column:
    """UTF-8 length of a text; null counts as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc32_of(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null has those of no bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A reproducible number in [0, 1) from the values of ``cols`` (53 bits of XXH64)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array and its ``len + 1`` offsets, without copying.
    Null entries are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), at.astype(np.int64)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of ``is_word`` bytes; runs never cross a text."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi <= lo:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = is_word[data[lo:hi]]
    first = np.zeros(hi - lo + 1, bool)
    first[offsets - lo] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(begins) + lo, np.flatnonzero(ends) + lo + 1


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        t = np.full(n + 1, base, np.uint64)
        t[0] = 1
        return np.multiply.accumulate(t)

    return table(_BASE), table(_BASE_INVERSE)


@lru_cache(maxsize=2)
def byte_values(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_case``, A-Z share those of a-z."""
    values = np.random.default_rng(20_240_611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool) -> np.ndarray:
    """64-bit hashes of the byte spans (a random-table polynomial, vectorised over all
    words through prefix sums), in pieces of about a megabyte."""
    out = np.empty(len(starts), np.uint64)
    values, at = byte_values(fold_case), 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        n = int(ends[to - 1]) - base
        power, inverse = _powers(_PIECE if n <= _PIECE else n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[base : base + n]] * power[:n], out=sums[1:])
        s = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[s]) * inverse[s]
        at = to
    return mixed(out)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(start, start + count)``."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift


def groups_of(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Consecutive slices of about ``size`` bytes, one text at least."""
    _, offsets = text_buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield texts.slice(at, to - at)
        at = to
