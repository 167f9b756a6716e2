"""Quality classifier: hashed word n-gram logistic regression trained with FTRL-proximal.

Tokens are runs of letters and digits, and runs of other visible characters; each also has a
shape (lower, capitalised, capitals, digits, marks, and whether it repeats the token before).  The
features of a text are the hashed counts of its words, word pairs and shape triples,
as shares of all of them; a score is the logistic of their sparse dot product with the weights.

Training takes a bounded, reproducible sample of the labelled rows, dealt to
``SHARDS`` tasks, which run FTRL passes over their share; their weights are averaged and
handed out again for the next round.  Only the weights (``2 ** BITS`` numbers) visit
the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import hash_words, mixed, staged, text_buffers, unit_hash, with_package, word_spans

BITS = 18
SAMPLE_ROWS = 12_000
SHARDS = 6
ROUNDS = 2
PASSES = 2
#: Shares are small numbers: this brings a text's features to a step that FTRL can learn from.
SCALE = 20.0
THRESHOLD = 0.3
_SLICE_BYTES = 2 << 20

_VISIBLE = np.ones(256, bool)
_VISIBLE[:33] = False
_VISIBLE[127] = False
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LOWER = np.zeros(256, np.int64)
_LOWER[97:123] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kind (1 word, 0 marks) of the tokens, in order."""
    a, b = word_spans(data, offsets, _LETTER)
    c, d = word_spans(data, offsets, _VISIBLE & ~_LETTER)
    order = np.argsort(np.concatenate((a, c)), kind="stable")
    kind = np.concatenate((np.ones(len(a), np.int64), np.zeros(len(c), np.int64)))
    return np.concatenate((a, c))[order], np.concatenate((b, d))[order], kind[order]


def _sums(flags: np.ndarray, data: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags[data], dtype=np.int64)))
    return total[ends - base] - total[starts - base]


def occurrences(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of texts (from, to): the feature number of every word, word pair and shape
    triple, and the text it is from, counted from the slice's first."""
    data, offsets = text_buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE_BYTES, "right")) - 1)
        part = offsets[at : to + 1]
        starts, ends, kind = _tokens(data, part)
        n = np.diff(np.searchsorted(starts, part))
        doc = np.repeat(np.arange(to - at), n)
        words = hash_words(data, starts, ends, True)
        lo, piece = int(part[0]), data[int(part[0]) : int(part[-1])]
        upper, lower, digit = (_sums(f, piece, lo, starts, ends) for f in (_UPPER, _LOWER, _DIGIT))
        shape = np.where(kind == 0, 5, np.where(digit == ends - starts, 4, np.where(upper > lower, 3, np.where(upper > 0, 2, 1))))
        together = np.zeros(len(words), bool)
        together[1:] = doc[1:] == doc[:-1]
        same = np.zeros(len(words), bool)
        same[1:] = together[1:] & (words[1:] == words[:-1])
        shape = np.where(same, 6, shape).astype(np.uint64)
        follows = np.flatnonzero(together)
        third = follows[together[follows - 1]]
        pairs = mixed(words[follows - 1] * np.uint64(3) + words[follows])
        triples = mixed(shape[third - 2] * np.uint64(64) + shape[third - 1] * np.uint64(8) + shape[third] + np.uint64(1 << 20))
        found = np.concatenate((words, pairs, triples)) >> np.uint64(64 - BITS)
        yield at, to, found.astype(np.int64), np.concatenate((doc, doc[follows], doc[third]))
        at = to


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text, its distinct feature numbers and their values, one after the other, and
    the ``len + 1`` offsets of the texts in them.  Null and empty texts have none."""
    numbers, values, counts = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(1, np.int64)]
    for at, to, found, owner in occurrences(texts):
        keys, times = np.unique((owner << BITS) | found, return_counts=True)
        owner = keys >> BITS
        numbers.append(keys & ((1 << BITS) - 1))
        values.append(times / np.bincount(owner, weights=times, minlength=to - at)[owner])
        counts.append(np.bincount(owner, minlength=to - at))
    return np.concatenate(numbers), SCALE * np.concatenate(values), np.cumsum(np.concatenate(counts))


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Logistic of each text's sparse dot product with the weights."""
    logit = np.full(len(texts), weights[-1])
    for at, to, found, owner in occurrences(texts):
        times = np.bincount(owner, minlength=to - at)
        logit[at:to] += SCALE * np.bincount(owner, weights=weights[found], minlength=to - at) / np.maximum(times, 1)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


@dataclass
class Ftrl:
    """FTRL-proximal state; the last coordinate is the bias."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        """One step on a text with features ``at`` (distinct) of values ``x``."""
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights (the last is the bias) learnt from rows with label 0 or 1; others, nulls among
    them, are left out.  At most about ``sample_rows`` rows are used, chosen by a hash of the
    id.  Without any rows all weights are 0, and every score 0.5."""
    spark = with_package(labelled.sparkSession)
    usable = labelled.filter(F.col(label_col).isin(0, 1))
    rows = usable.count()
    if not rows:
        return np.zeros((1 << BITS) + 1)
    chance = unit_hash(F.col(id_col).cast("string"), seed=4)
    sample = usable.filter(chance < min(1.0, sample_rows / rows)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("double").alias("label"), chance.alias("turn")
    )
    shard = F.pmod(F.xxhash64("turn", F.coalesce("text", F.lit(""))), F.lit(SHARDS)).cast("int")
    sample = staged(sample.withColumn("shard", shard).repartition(SHARDS, "shard").sortWithinPartitions("shard", "turn"), "quality-sample")
    state_type = T.StructType([T.StructField("z", T.BinaryType()), T.StructField("n", T.BinaryType()), T.StructField("rows", T.LongType())])

    def one_round(shared):
        def learn(rows: pa.Table) -> pa.Table:
            z, n = shared.value
            state = Ftrl(z.copy(), n.copy())
            texts, labels = rows.column("text"), np.array(rows.column("label").to_pylist())
            order = np.argsort(np.array(rows.column("turn").to_pylist()), kind="stable")
            at, x, offsets = features(texts.combine_chunks())
            for _ in range(PASSES):
                for i in order:
                    own = slice(offsets[i], offsets[i + 1])
                    state.learn(at[own], x[own], labels[i])
            return pa.table({"z": pa.array([state.z.astype(np.float32).tobytes()], pa.binary()), "n": pa.array([state.n.astype(np.float32).tobytes()], pa.binary()), "rows": pa.array([rows.num_rows], pa.int64())})

        return sample.groupBy("shard").applyInArrow(learn, state_type)

    state = Ftrl.empty()
    for _ in range(ROUNDS):
        z, n, seen = np.zeros_like(state.z), np.zeros_like(state.n), 0
        for row in one_round(spark.sparkContext.broadcast((state.z, state.n))).toLocalIterator():
            z += np.frombuffer(row["z"], np.float32) * row["rows"]
            n += np.frombuffer(row["n"], np.float32) * row["rows"]
            seen += row["rows"]
        state.z, state.n = z / max(1, seen), n / max(1, seen)
    return state.weights()


def score_column(spark: SparkSession, weights: np.ndarray, text: Column) -> Column:
    """The score of a text, 0 to 1, by the sparse dot product of its features with the weights."""
    shared = with_package(spark).sparkContext.broadcast(weights.astype(np.float64))

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(scores(texts, shared.value))

    return score(text)


def learning_rows(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of the labelled documents that ``keep`` (of doc_id)
    admits.  Rows with a null id have no label; repeated labels of a document all count."""
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    return docs.select("doc_id", "text").filter(keep).join(known, "doc_id")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classifier(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights from the labelled documents outside the held-out fifth."""
    return train(learning_rows(docs, labels, ~held_out(F.col("doc_id"))), label_col="label")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns.  Null and empty texts
    score like a text without words, equal texts alike; null ids and repeated rows are rows of their own; an empty table
    gives no rows."""
    weights = classifier(docs, labels)
    return docs.filter(score_column(docs.sparkSession, weights, F.col("text")) >= threshold)
