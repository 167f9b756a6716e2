from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import docs_frame, edge_rows, prose
from tillsight.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = queries.op4_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == (r.score >= 0.3) for r in out)
    assert len(held) > 40 and np.mean([r.predicted == r.quality for r in held]) > 0.93
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_score_is_the_sparse_dot_product():
    rng = random.Random(2)
    texts = pa.array([None, "", "one", "One two, THREE!! four 5 5 5", prose(rng, 300), "é ß\n\n😀"], pa.string())
    weights = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    at, x, offsets = quality.features(texts)
    plain = [1 / (1 + np.exp(-(sum(weights[i] * v for i, v in zip(at[a:b], x[a:b], strict=True)) + weights[-1]))) for a, b in zip(offsets, offsets[1:], strict=False)]
    assert np.allclose(quality.scores(texts, weights), plain)
    assert offsets[1] == offsets[2] == 0  # null and empty texts have no features
    for n, text in enumerate(texts):  # a text's features do not depend on its neighbours
        alone, values, _ = quality.features(pa.array([text.as_py()], pa.string()))
        assert alone.tolist() == at[offsets[n] : offsets[n + 1]].tolist() and np.allclose(values, x[offsets[n] : offsets[n + 1]])


def test_ftrl_step_against_the_textbook():
    state = quality.Ftrl.empty()
    rng = np.random.default_rng(4)
    z, n = {}, {}
    for _ in range(30):
        at, x, y = rng.choice(50, 8, replace=False), rng.random(8), float(rng.integers(2))
        full = dict(zip([*at.tolist(), len(state.z) - 1], [*x.tolist(), 1.0], strict=True))
        w = {}
        for i in full:
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= state.l1 else -(zi - np.sign(zi) * state.l1) / ((state.beta + ni**0.5) / state.alpha + state.l2)
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in full.items())))
        for i, v in full.items():
            g = (p - y) * v
            s = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / state.alpha
            z[i], n[i] = z.get(i, 0.0) + g - s * w[i], n.get(i, 0.0) + g * g
        state.learn(at, x, y)
    assert all(np.isclose(state.z[i], v) and np.isclose(state.n[i], n[i]) for i, v in z.items())


def test_edges(spark):
    docs = docs_frame(spark, edge_rows())
    labels = spark.createDataFrame([(1, 0), (2, 1), (5, 1), (5, 0), (9, None), (10, 7), (None, 1)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality.keep_good(docs.withColumn("score", F.lit(1)).limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()  # nothing learnt: 0.5 for all


@pytest.mark.parametrize("rows", [3, 50])
def test_sample_is_bounded(spark, rows):
    rng = random.Random(rows)
    frame = spark.createDataFrame([(i, prose(rng, 5), i % 2) for i in range(200)], "doc_id long, text string, label int")
    assert quality.train(frame, sample_rows=rows).shape == ((1 << quality.BITS) + 1,)
