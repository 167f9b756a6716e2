from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pytest

from tests.llm.frames import docs_frame, edge_rows
from tillsight.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = queries.op9_language_id(spark, SF).collect()
    assert len(out) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


@pytest.mark.parametrize("word", ["a", "the", "theing", "ab" * 6, "éa", "thethethethe"])
def test_forward_sums_all_segmentations(word):
    table = {"▁": [0.1, 0.2], "▁t": [0.05, 0.01], "▁the": [0.3, 0.02], "the": [0.1, 0.1], "t": [0.02, 0.03], "h": [0.01, 0.02], "e": [0.05, 0.04], "he": [0.1, 0.2], "a": [0.2, 0.1], "ab": [0.05, 0.1], "▁ab": [0.02, 0.01], "in": [0.1, 0.3], "ing": [0.2, 0.1]}
    scorer = langid.Scorer(["x", "y"], {k: np.array(v) for k, v in table.items()})
    marked = "▁" + word

    @lru_cache(None)
    def plain(at, lang):
        if at == len(marked):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(marked) + 1):
            piece = marked[at:end]
            p = table[piece][lang] if piece in table else scorer.floor if end == at + 1 else 0
            total += p * plain(end, lang) if p else 0
        return total

    wanted = [np.log(plain(0, 0)), np.log(plain(0, 1))]
    assert np.allclose(scorer.words([word])[0], wanted)
    assert np.allclose(scorer.words(["he", word, "x" * 50, "t", "\U0001f600"])[1], wanted)


def test_long_words_neither_underflow_nor_differ():
    scorer = langid.Scorer(["x", "y"], {"a": np.array([1e-3, 1e-4])})
    start = np.log(scorer.floor)
    assert np.allclose(scorer.words(["a" * 5000, "a"])[0], [start + 5000 * np.log(1e-3), start + 5000 * np.log(1e-4)])


def test_expected_counts_against_enumeration():
    logs = {"▁": 0.2, "a": 0.2, "b": 0.1, "ab": 0.3, "▁a": 0.1, "bab": 0.1}

    def segmentations(s):
        if not s:
            yield []
        for n in range(1, len(s) + 1):
            if s[:n] in logs or n == 1:
                for rest in segmentations(s[n:]):
                    yield [s[:n], *rest]

    word, floor = "ababx", 0.01
    weights = [(seg, np.prod([logs.get(p, floor) for p in seg])) for seg in segmentations("▁" + word)]
    total = sum(w for _, w in weights)
    got = langid._expected([word], [2.0], logs, floor)
    for piece in logs:
        assert np.isclose(got[piece], 2 * sum(seg.count(piece) * w for seg, w in weights) / total)


def test_cache_reset_changes_nothing(monkeypatch):
    monkeypatch.setattr(langid, "CACHE_NUMBERS", 130)
    table = {c: np.array([0.1, 0.05]) for c in "abcdefgh▁"}
    text = " ".join(a + b for a in "abcdefgh" for b in "abcdefgh") + " zz 123 éé"
    texts = [text, "", "1 2", "ab ab zz", text[:60]]
    small, counts = langid.Scorer(["x", "y"], table).texts(texts)
    assert counts.tolist()[1:4] == [0, 0, 3]
    monkeypatch.setattr(langid, "CACHE_NUMBERS", 10_000)
    large = langid.Scorer(["x", "y"], table)
    assert np.allclose(small, large.texts(texts)[0])
    assert np.allclose(small[3], large.words(["ab", "ab", "zz"]).sum(axis=0))


def test_edges(spark):
    docs = docs_frame(spark, [*edge_rows(), (20, "123 !!", "en", "a"), (22, "x² "[1:], "en", "a"), (21, "hello world of words", "en", "a")])
    model = langid.train(docs)
    out = {r.doc_id: r for r in langid.identify(docs.withColumnRenamed("n_chars", "score"), model).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 20, 22)] == ["und"] * 5 and out[1].score == 0
    assert out[21].lang_pred in ("en", "de", "fr", "es") and out[9].lang_pred in ("en", "de")
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_sample_is_over_different_texts(spark, monkeypatch):
    """A text in 3,000 copies, 200 others, and a language of few texts in many copies."""
    letters = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(3))
    rows = [("aa", "hotword")] * 3000 + [("aa", f"same {letters(i)}") for i in range(200)] + [("bb", f"rare {letters(n % 3)}") for n in range(2000)]
    counted = []
    staged = langid.staged
    monkeypatch.setattr(langid, "staged", lambda df, purpose, *a: counted.append((purpose, out := staged(df, purpose, *a))) or out)
    langid.train(spark.createDataFrame(rows, "lang string, text string"), sample_docs=100)
    got = {(r.lang, r.word): r.n for purpose, df in counted if purpose == "language-words" for r in df.collect()}
    assert 60 <= got["aa", "same"] <= 140 and got.get(("aa", "hotword"), 1) == 1
    assert got["bb", "rare"] == 3 and all(got["bb", letters(n)] == 1 for n in range(3))


def test_signs_without_letters_have_no_language_at_any_length(spark):
    rows = [(1, "hello world of words", "en", "a"), (2, "½ ¼ ² ³ " * 2, "en", "a"), (3, "½ ¼ ² ³ " * 500, "en", "a"), (4, "½ ¼ ² ³ " * 500 + "the", "en", "a")]
    docs = docs_frame(spark, rows)
    out = {r.doc_id: r for r in langid.identify(docs, langid.train(docs.filter("doc_id = 1"))).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "und", "und", "en"] and out[3].score == 0


def test_long_words_are_learnt_from_in_stretches(spark):
    word = "the" * 100
    assert "".join(langid.marked(s) for s in langid.stretches(word)) == "▁" + word and langid.stretches("a" * 64) == ["a" * 64]
    docs = spark.createDataFrame([("aa", word), ("bb", "of")], "lang string, text string")
    languages, table = langid.train(docs)
    assert languages == ["aa", "bb"] and table["the"][0] > 10 * table["the"][1]
