from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontam import plain as plain_hits
from tests.llm.test_sharding import best_capacity
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage and what comes out, as the stages are run: written and read again."""
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{n}")
        after = spark.read.parquet(f"{root}/{n}")
        out.append((name, docs, after))
        docs = after
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages(spark, steps):
    assert [n for n, *_ in steps] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "mixing to target weights", "sharding"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for _, _, after in steps[:-1])
    whole = {tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for _, _, after in steps[:-1]:
        assert {tuple(r) for r in after.collect()} <= whole


def test_quality_keeps_the_good(spark, steps):
    _, _, after = steps[0]
    kept = set(ids(after))
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_near_copies(steps):
    _, before, after = steps[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    assert ids(after) == sorted(set(plain_components([plain_fingerprint(t) for _, t in rows], [i for i, _ in rows])))


def test_benchmark(spark, steps):
    _, before, after = steps[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    assert ids(after) == [i for (i, _), hit in zip(rows, plain_hits([t for _, t in rows], items), strict=True) if not hit[1]]


def test_mixture(steps):
    _, before, after = steps[3]
    assert set(ids(after)) <= set(ids(before)) and 0.25 * before.count() < after.count() < 0.8 * before.count()


def test_shards(steps):
    _, before, after = steps[4]
    assert ids(after) == ids(before)
    totals = defaultdict(int)
    rows = after.collect()
    for r in rows:
        totals[r.shard] += len(r.text.encode()) + 8
    assert max(totals.values()) == best_capacity([(r.text, len(r.text.encode()) + 8) for r in rows], corpus_pipeline.SHARDS)


def test_run_is_the_stages(spark, steps):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(steps[-1][2])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = docs.drop("shard")
