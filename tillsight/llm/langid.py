"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.  The probability
of a word is the sum over all its segmentations into pieces of the product of their
probabilities, found by a forward pass over the word; a text's is the product over its
words.  Piece probabilities are learnt per language by expectation-maximisation over all
segmentations of the words of a bounded sample of documents.

Words are runs of letters, folded to lower case, with the vocabulary's mark of a word's start
before them.  Any single character that is no piece counts as a piece of small probability.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import groups_of, staged, unit_hash, with_package

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Bounds of what a language is learnt from: different texts, and of their words met up to three times
#: as many as make about so many words in all (each stands for those left out).
SAMPLE_DOCS = 800
SAMPLE_WORDS = 30_000
PASSES = 2
SMOOTHING = 0.05
LONGEST = 16
#: Positions after which a word's sums are scaled; they stay in a double's range between.
RESCALE = 16
#: Texts are scored in groups of about so many bytes.
GROUP_BYTES = 1 << 19
#: Numbers that a task keeps of words it has seen: words times languages.
CACHE_NUMBERS = 1_200_000
UNDETERMINED = "und"
_START = "▁"
#: Longer words are learnt from in stretches of so many characters; all but the first have a
#: mark that no word has in place of that of a word's start.
STRETCH = 64
_GOES_ON = "-"
_WORD = re.compile(r"[^\W\d_]+")


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Pieces of letters (and the start mark) of a SentencePiece model; one of over ``LONGEST`` characters is an error."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    pieces = sorted({p for p in found if (p == _START or p.lstrip(_START).isalpha()) and p == p.lower()})
    if max(map(len, pieces), default=0) > LONGEST:
        raise ValueError(f"the vocabulary has pieces of over {LONGEST} characters")
    return pieces


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stretches(word: str) -> list[str]:
    return [word[:STRETCH], *(_GOES_ON + word[at : at + STRETCH] for at in range(STRETCH, len(word), STRETCH))]


def marked(word: str) -> str:
    return word[1:] if word.startswith(_GOES_ON) else _START + word


def _expected(words: list[str], times: list[float], logs: dict[str, float], floor: float) -> dict[str, float]:
    """Expected piece counts over all segmentations (forward-backward), with scaled sums."""
    counts: dict[str, float] = dict.fromkeys(logs, 0.0)
    for word, n in zip(words, times, strict=True):
        word = marked(word)
        size = len(word)
        forward, scale = [1.0] + [0.0] * size, [1.0] * (size + 1)
        arcs: list[tuple[int, int, str, float]] = []
        # Forward sums are kept relative to a running scale, so long words cannot underflow.
        for end in range(1, size + 1):
            total = 0.0
            for begin in range(max(0, end - LONGEST), end):
                piece = word[begin:end]
                p = logs.get(piece)
                if p is None:
                    if end - begin > 1:
                        continue
                    p = floor
                ratio = 1.0
                for k in range(begin + 1, end):
                    ratio *= scale[k]
                weight = p / ratio
                arcs.append((begin, end, piece, weight))
                total += forward[begin] * weight
            scale[end] = total or 1e-300
            forward[end] = total / scale[end]
        backward = [0.0] * size + [1.0]
        for begin, end, piece, weight in reversed(arcs):
            share = backward[end] * weight / scale[end]
            backward[begin] += share
            if piece in counts:
                counts[piece] += n * forward[begin] * share
    return counts


def _learn(pieces: list[str]):
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        words, times = rows["word"].tolist(), rows["n"].astype(float).tolist()
        present: dict[str, float] = {}
        known = set(pieces)
        for word in words:  # pieces that occur at all start out alike
            word = marked(word)
            for begin in range(len(word)):
                for end in range(begin + 1, min(len(word), begin + LONGEST) + 1):
                    if word[begin:end] in known:
                        present[word[begin:end]] = 1.0
        probability = dict.fromkeys(present, 1.0 / max(1, len(present)))
        for _ in range(PASSES):
            counts = _expected(words, times, probability, 1.0 / max(1, 100 * len(pieces)))
            total = sum(counts.values()) or 1.0
            probability = {p: c / total for p, c in counts.items() if c > 1e-6}
        total = sum(times) or 1.0
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "piece": list(probability), "p": list(probability.values())})

    return learn


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", pieces_path: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS):
    """(languages, piece -> vector of probabilities).  Per language at most about
    ``sample_docs`` different texts, chosen by a hash, are learnt from, each once: of their words
    all that are frequent and, if there are over ``sample_words``, a share of the rest.  Rows without a language or a
    text are left out; the model's size is languages times vocabulary."""
    with_package(docs.sparkSession)
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # Copies share one draw, so shares are over different texts.  One number per language; the
    # model to come has a vocabulary of them for each.
    texts = usable.select("lang", F.xxhash64("text").alias("text")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    share = {r["lang"]: sample_docs / r["texts"] for r in texts.toLocalIterator()}
    shares = F.create_map(*(F.lit(x) for pair in sorted(share.items()) for x in pair)) if share else F.create_map().cast("map<string,double>")
    sample = usable.filter(unit_hash(F.col("text"), seed=9) < F.get(F.array(shares[F.col("lang")]), F.lit(0))).distinct()

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([[s for w in words_of(t) for s in stretches(w)] for t in texts.to_pylist()], pa.list_(pa.string()))

    counted = sample.select("lang", F.explode(split("text")).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counted = staged(counted, "language-words")
    best = staged(counted.groupBy("lang").agg(F.max_by(F.col("n"), F.col("n")).alias("top"), F.count(F.lit(1)).alias("words"), F.sum("n").alias("total")), "language-totals")
    # Of the many words that occur once or twice a share is enough: those a hash chooses.
    chance = F.lit(float(sample_words)) / F.col("words")
    chosen = counted.join(best, "lang").filter((F.col("n") > 3) | (unit_hash(F.col("word"), seed=10) < chance)).select("lang", "word", F.when(F.col("n") > 3, F.col("n").cast("double")).otherwise(F.col("n") / F.least(F.lit(1.0), chance)).alias("n"))
    learnt = chosen.groupBy("lang").applyInPandas(_learn(vocabulary(pieces_path)), "lang string, piece string, p double")
    model: dict[str, dict[str, float]] = {lang: {} for lang in share}
    for row in learnt.toLocalIterator():
        model[row["lang"]][row["piece"]] = row["p"]
    languages = sorted(model)
    size = max(1, len({p for m in model.values() for p in m}))
    smooth = SMOOTHING / size
    table = {}
    for piece in {p for m in model.values() for p in m}:
        table[piece] = np.array([(1 - SMOOTHING) * model[lang].get(piece, 0.0) + smooth for lang in languages])
    return languages, table


class PieceTrie:
    """All pieces as a trie in arrays, to find the pieces in many words at once."""

    def __init__(self, pieces: list[str]) -> None:
        letters = sorted({c for p in pieces for c in p})
        self.letters = np.array([*map(ord, letters)], np.int64)
        number = {c: n for n, c in enumerate(letters)}
        nodes: dict[str, int] = {"": 0}
        edges: list[int] = []
        for piece in pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    edges.append(nodes[piece[: n - 1]] * len(letters) + number[piece[n - 1]])
        # Node n > 0 is reached by edge n - 1.  Edges lie in a hash table of free slots.
        self.edges = np.array(edges, np.int64)
        self.piece = np.full(len(nodes), -1, np.int64)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))
        self.bits = max(4, int(4 * len(edges)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        waiting = np.arange(len(edges))
        slot = self._slot(self.edges)
        while len(waiting):
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            self.slots[slot[free[first]]] = waiting[free[first]]
            left = self.slots[slot] != waiting
            waiting, slot = waiting[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, edges: np.ndarray) -> np.ndarray:
        return ((edges.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The node that follows by a letter, or -1."""
        wanted = nodes * len(self.letters) + letters
        out, open_, slot = np.full(len(wanted), -1, np.int64), np.arange(len(wanted)), self._slot(wanted)
        while len(open_):
            edge = self.slots[slot]
            found = edge >= 0
            found[found] = self.edges[edge[found]] == wanted[open_[found]]
            out[open_[found]] = edge[found] + 1
            on = (edge >= 0) & ~found
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begin, length, piece) of all pieces in the words one after the other, and where the
        words end.  A character that is no piece is one, numbered after the last."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum([*map(len, words)])
        until = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
        at = np.minimum(np.searchsorted(self.letters, points), max(0, len(self.letters) - 1))
        letters = np.where(self.letters[at] == points, at, -1) if len(self.letters) else np.full(len(points), -1)
        begin, node, length, found = np.arange(len(points)), np.zeros(len(points), np.int64), 0, []
        while len(begin):
            inside = begin + length < until[begin]
            begin, node = begin[inside], node[inside]
            letter = letters[begin + length]
            after = np.where(letter >= 0, self._next(node, np.maximum(letter, 0)), -1)
            length += 1
            piece = np.where(after >= 0, self.piece[np.maximum(after, 0)], -1)
            if length == 1:
                piece = np.where(piece < 0, self.single, piece)
            hit = piece >= 0
            found.append((begin[hit], np.full(int(hit.sum()), length), piece[hit]))
            begin, node = begin[after >= 0], after[after >= 0]
        return *(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)), ends

    @property
    def single(self) -> int:
        return int(self.piece.max(initial=-1)) + 1


class Scorer:
    """Log-probabilities of words in all languages; seen words are kept, up to a number."""

    def __init__(self, languages: list[str], table: dict[str, np.ndarray]) -> None:
        self.languages = languages
        self.floor = SMOOTHING / max(1, len(table)) / 10
        self.trie = PieceTrie([*table])
        self.table = np.array([*table.values(), np.full(len(languages), self.floor)])
        self.known: dict[str, int] = {}
        self.room = max(64, CACHE_NUMBERS // max(1, len(languages)))
        self.rows = np.empty((self.room, len(languages)))

    def words(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of the sum over all segmentations of each word, per language: forward
        passes side by side, a position at a time, each word's and language's sums kept in
        range by a scale of its own."""
        marked = [_START + w for w in words]
        begin, length, piece, ends = self.trie.arcs(marked)
        starts = np.concatenate(([0], ends[:-1]))
        owner = np.searchsorted(ends, begin, "right")
        position = begin - starts[owner]
        order = np.argsort(position, kind="stable")
        edges = np.searchsorted(position[order], np.arange(int(position.max(initial=0)) + 2))
        # A word of n characters has n + 1 states, one after the other.
        base = starts + np.arange(len(words))
        sums = np.zeros((int(ends[-1]) + len(words) if len(ends) else 0, len(self.languages)))
        sums[base] = 1.0
        shift = np.zeros((len(words), len(self.languages)))
        for at in range(len(edges) - 1):
            own = order[edges[at] : edges[at + 1]]
            who = owner[own]
            here = base[who] + at
            if at % RESCALE == 0 and at:
                some = np.unique(who)
                scale = np.maximum(sums[base[some] + at], 1e-300)
                shift[some] += np.log(scale)
                for ahead in range(LONGEST + 1):
                    still = some[at + ahead <= ends[some] - starts[some]]
                    sums[base[still] + at + ahead] /= scale[: len(some)][np.searchsorted(some, still)]
            # From one position, a word's arcs end at different ones.
            sums[here + length[own]] += sums[here] * self.table[piece[own]]
        return np.log(np.maximum(sums[base + ends - starts], 1e-300)) + shift

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each text in each language, and how many words it has."""
        lists = [words_of(t) for t in texts]
        counts = np.array([*map(len, lists)], np.int64)
        flat = [w for words in lists for w in words]
        total, known, part = np.zeros((len(texts), len(self.languages))), self.known, max(1, self.room // 2)
        owner = np.repeat(np.arange(len(texts)), counts)
        for at in range(0, len(flat) if self.languages else 0, part):
            some = flat[at : at + part]
            new = [w for w in dict.fromkeys(some) if w not in known]
            if len(known) + len(new) > self.room:
                known.clear()
                new = [*dict.fromkeys(some)]
            if new:
                self.rows[len(known) : len(known) + len(new)] = self.words(new)
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            rows = self.rows[np.fromiter(map(known.__getitem__, some), np.int64, len(some))]
            who = owner[at : at + part]
            edges = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            total[who[edges]] += np.add.reduceat(rows, edges, axis=0)
        return total, counts


_scorers: dict[str, Scorer] = {}


def scorer_of(name: str, shared) -> Scorer:
    """The scorer of a model in this worker, which keeps its words from task to task."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(*shared.value)
    return _scorers[name]


def predict_column(spark: SparkSession, model, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score``, the predicted language's share of the whole text's likelihood
    over all languages; ``und`` and 0 if there are no letters (or no languages)."""
    shared, name = with_package(spark).sparkContext.broadcast(model), uuid.uuid4().hex

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = scorer_of(name, shared)
        for texts in batches:
            names, shares = [], []
            for some in groups_of(texts, GROUP_BYTES):
                strings = [t or "" for t in some.to_pylist()]
                for text, logs, words in zip(strings, *scorer.texts(strings), strict=True):
                    # Words may be signs that only count as letters, such as raised figures.
                    if not words or not len(logs) or not any(map(str.isalpha, text)):
                        names.append(UNDETERMINED)
                        shares.append(0.0)
                        continue
                    best = int(np.argmax(logs))
                    names.append(scorer.languages[best])
                    shares.append(float(1 / np.exp(np.clip(logs - logs[best], -700, 0)).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang_pred", "score"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every row; ties go to the first language by name."""
    found = predict_column(docs.sparkSession, model, F.col(text_col))
    return docs.select(id_col, found.alias("__found")).select(id_col, "__found.lang_pred", "__found.score")
