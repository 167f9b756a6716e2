"""Corpus pipeline: quality, near-duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again as the next one's documents.  An empty table passes every stage; all but the last return the
columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import decontam, mixing, quality, sharding, simhash
from tillsight.llm.common import staged, utf8_bytes

SHARDS = 24
#: Share of the tokens that the mixture asks for in all.
MIXTURE = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.  Null and empty texts are scored like any
    other, equal texts alike; null ids and repeated rows are rows of their own."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id (nulls last; of several rows with
    that id one).  Null and empty texts are copies of each other."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.  Null and empty texts stay, and so does all if the benchmark is empty."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered token shares of sources, languages and topics.  A null source or language is a value of
    its own; rows equal in id and text share their fate."""
    return mixing.sample_mixture(docs, fraction=MIXTURE)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the shard of each.  Equal texts share a shard; null texts are taken as empty."""
    return sharding.shard_by_size(docs, SHARDS, F.col("text"), utf8_bytes(F.col("text")) + 8)


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

#: The classifier and the fingerprints have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage keeps is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = staged(docs, name.replace(" ", "-"))
    return docs
