"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites a line stands on is kept per line hash; sketches merge by
aggregation, so a line on every page is one small sketch per task before anything is
shuffled.  Lines whose estimate is clearly under or over the threshold are decided by it; those
within ``band`` of it get exact distinct counts.  Lines on at least ``min_sites`` sites are
boilerplate: each stays in the document with the smallest id and goes from all others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import staged

MIN_SITES = 5
LG_K = 12
#: Bits of the filter that tells texts without boilerplate lines.
FILTER_BITS = 24
_BLANK = " \t\r\x0b\x0c"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_hash(line: Column) -> Column:
    """XXH64 of a line without white space around it; null for a blank line."""
    trimmed = F.btrim(line, F.lit(_BLANK))
    return F.when(trimmed != "", F.xxhash64(trimmed))


def near_band(min_sites: int, lg_k: int = LG_K) -> int:
    """Four standard errors of the estimate at the threshold, one site at least."""
    return max(1, math.ceil(4 * 1.04 / math.sqrt(1 << lg_k) * min_sites))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``id``, ``site``, ``key`` (of the text) and ``lines`` (hashes in order), written once."""
    text = F.col(text_col)
    return staged(
        docs.select(
            F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.xxhash64(text).alias("key"), F.transform(lines_of(text), line_hash).alias("lines")
        ).filter(text.isNotNull()),
        "line-hashes",
    )


def boilerplate_lines(hashed: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    """``line`` (hash) and ``first`` (smallest id) of the lines on ``min_sites`` sites or more.
    A null site is none."""
    at = hashed.select("id", "site", F.explode(F.array_distinct("lines")).alias("line")).filter("line IS NOT NULL")
    sketched = at.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min("id").alias("first"))
    band = near_band(min_sites, lg_k)
    spread = staged(
        sketched.select("line", "first", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") >= min_sites - band), "line-spread"
    )
    near = spread.filter(F.col("sites") <= min_sites + band)
    exact = at.join(near.select("line"), "line", "left_semi").filter("site IS NOT NULL").select("line", "site").distinct()
    exact = exact.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("line")
    sure = spread.filter(F.col("sites") > min_sites + band)
    return staged(sure.select("line", "first").unionByName(near.join(exact, "line").select("line", "first")), "boilerplate-lines")


def marked_texts(hashed: DataFrame, told: DataFrame) -> DataFrame:
    """``key`` and ``marks`` (position, line and first id) of the texts that have boilerplate lines.  What is
    boilerplate in a text depends on the text alone, so copies share one entry."""
    placed = hashed.select("key", F.posexplode("lines").alias("pos", "line")).filter("line IS NOT NULL").distinct()
    marks = placed.join(told, "line").groupBy("key").agg(F.collect_list(F.struct("pos", "line", "first")).alias("marks"))
    # Written first, so that the join to come stands alone and copies of a text can be split over tasks.
    return staged(marks, "boilerplate-of-texts")


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(1 << FILTER_BITS)) + 1


def may_be_marked(rows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``__maybe``: false only if ``key`` has no marks for sure.  The keys with marks are
    bits of ``2 ** FILTER_BITS``, in bitmaps of 4 KB that are broadcast (2 MB at most)."""
    maps = marks.groupBy(F.bitmap_bucket_number(_bit(F.col("key"))).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_bit(F.col("key")))).alias("__bits"))
    at = F.bitmap_bit_position(_bit(F.col(key)))
    byte = F.conv(F.hex(F.expr(f"substring(__bits, cast(bitmap_bit_position(pmod(`{key}`, {1 << FILTER_BITS}) + 1) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = rows.withColumn("__bucket", F.bitmap_bucket_number(_bit(F.col(key)))).join(F.broadcast(staged(maps, "marked-bits")), "__bucket", "left")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    return found.withColumn("__maybe", F.coalesce(is_set, F.lit(False))).drop("__bucket", "__bits")


def drop_boilerplate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K
) -> DataFrame:
    """``id_col``, ``n_lines``, ``n_removed`` and ``text`` without the boilerplate lines, each of
    which stays in the document(s) of the smallest id it occurs in.

    Lines are compared without white space around them; blank lines always stay.  Null
    texts stay null, with 0 lines.  Null sites do not count; a null id is the smallest only of
    a line that has no other.  Empty tables give no rows.

    Only texts that may have boilerplate lines are shuffled, to meet their marks; the others are
    returned as they are read.
    """
    hashed = hashed_lines(docs, id_col, text_col, site_col)
    marks = marked_texts(hashed, boilerplate_lines(hashed, min_sites, lg_k))
    text = F.col("__text")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.xxhash64(F.col(text_col)).alias("__key"))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    n_lines = F.when(text.isNull(), 0).otherwise(breaks + 1).cast("long").alias("n_lines")
    rows = may_be_marked(rows.withColumn("__key", F.when(text.isNotNull(), F.col("__key"))), marks, "__key")
    plain = rows.filter(~F.col("__maybe")).select(F.col("__id").alias(id_col), n_lines, F.lit(0).cast("long").alias("n_removed"), text.alias("text"))
    met = rows.filter("__maybe").join(marks.withColumnRenamed("key", "__key").hint("merge"), "__key", "left")
    # Columns of their own: within a lambda they would be computed for every element.
    met = met.withColumn("__lines", F.when(F.col("marks").isNotNull(), lines_of(text)))
    # Texts that share a key by chance share marks; a mark counts only where its line stands.
    goes = lambda m: ~m["first"].eqNullSafe(F.col("__id")) & (line_hash(F.get("__lines", m["pos"])) == m["line"])
    met = met.withColumn("__goes", F.transform(F.filter("marks", goes), lambda m: m["pos"]))
    stays = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__goes"))  # by hash set: linear in the lines
    met = met.withColumn("__stays", F.when(F.col("marks").isNotNull(), stays))
    kept = F.array_join(F.transform("__stays", lambda at: F.get("__lines", at)), "\n")
    cleaned = met.select(
        F.col("__id").alias(id_col), n_lines, F.coalesce(F.size("__lines") - F.size("__stays"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(kept, text).alias("text"),
    )
    return plain.unionByName(cleaned)
