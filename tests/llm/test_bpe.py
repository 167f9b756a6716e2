from __future__ import annotations

import base64
import codecs
import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.frames import docs_frame, edge_rows
from tillsight.llm import bpe, queries

FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


def rank_file(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@lru_cache
def judge(name: str) -> tiktoken.Encoding:
    """The public library, from the same file."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file(name).splitlines())}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache
def encoder(name: str) -> bpe.Encoder:
    return bpe.Encoder(rank_file(name), public_tokenizers.PATTERN)


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("name", FILES)
def test_pieces_against_library(name):
    own, other, rng = encoder(name).transducer, judge(name), random.Random(3)
    tokens = list(own.ranks)
    pieces = [b"".join(rng.choices(tokens, k=rng.randrange(1, 10))) for _ in range(1500)]
    pieces += [bytes(rng.choices(b"ab= -\xe3\x81\x82", k=rng.randrange(1, 150))) for _ in range(1500)]
    pieces += [unit * n for unit in (b"=", b" ", b"a", b"aab", b"ana", b"\xe3\x82\xa2") for n in (*range(1, 140), 5000)]
    pieces += [rng.randbytes(rng.randrange(1, 60)) for _ in range(500)]
    for piece in pieces:
        assert own.encode(piece) == other._encode_single_piece(piece), piece


@pytest.mark.parametrize("name", FILES)
def test_neighbours_against_plain_merging(name):
    own, rng = encoder(name).transducer, random.Random(5)
    tokens, seen = list(own.ranks), set()
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        if rng.random() < 0.7 and len(b) > 1:  # neighbours that may well be joined
            cut = rng.randrange(1, len(b))
            a, b = (b[:cut], b[cut:]) if b[:cut] in own.ranks and b[cut:] in own.ranks else (a, b)
        pair = [own.ranks[a], own.ranks[b]]
        apart = bpe.merged(a + b, own.ranks) == pair
        seen.add(apart)
        assert own.stay_apart(*pair) == apart, (a, b)
    assert seen == {True, False}


def test_texts_against_library():
    rng = random.Random(7)
    some = ["", " ", "   \n\t x", "it's WE'LL  they'd\r\n\r\n12345 ½ ²", "naïve Ünïcode 東京都 😀👍🏽 ​   é", "<|endoftext|> ok", "a" * 3000, "\x00\x01\x7f", "=" * 1000, " " * 999 + "x"]
    alphabet = "abcdeé \n\t'sSTLM0189.,!=-—東京アイ😀 ́ßſK"
    some += ["".join(rng.choices(alphabet, k=rng.randrange(1, 300))) for _ in range(1500)]
    some += [chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x110000)])) * rng.randrange(1, 4) for _ in range(2000)]
    own, decoder = encoder(FILES[0]), bpe.Decoder(rank_file(FILES[0]))
    for text in some:
        packed = own.encode(text)
        assert ids_of(packed) == judge(FILES[0]).encode_ordinary(text), text
        assert decoder.decode(packed) == text


def test_few_states_and_long_texts_give_the_same(monkeypatch):
    rng = random.Random(9)
    ranks = bpe.ranks_of(rank_file(FILES[0]))
    narrow = bpe.Transducer(ranks, max_states=3)
    for _ in range(200):
        piece = bytes(rng.choices(b"thenig er", k=40))
        assert narrow.encode(piece) == encoder(FILES[0]).transducer.encode(piece)
        assert len(narrow.states) <= 4
    text = " ".join("".join(rng.choices("thenigr\n é", k=rng.randrange(1, 12))) for _ in range(4000))
    whole = encoder(FILES[0]).encode(text)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "MAX_PIECES", 50)
    assert encoder(FILES[0]).encode(text) == whole
    monkeypatch.setattr(bpe, "CHUNK", 3)
    assert bpe.Decoder(rank_file(FILES[0])).decode(whole) == text


def test_streams_cut_anywhere(monkeypatch):
    """Streams side by side, with few states: tokens come out early, and the same ones."""
    rng, own = random.Random(11), bpe.Transducer(bpe.ranks_of(rank_file(FILES[0])), max_states=40)
    longest = max(map(len, own.ranks))
    for window in (1, 7, 1024):
        monkeypatch.setattr(bpe, "WINDOW", window)
        for _ in range(100):
            pieces = [bytes(rng.choices("aenrth é東".encode(), k=rng.randrange(1, 300))) for _ in range(2)] + [b"an" * 400, b"=" * 700]
            streams, outs, at = [bpe.Stream(own) for _ in pieces], [[] for _ in pieces], 0
            while at < max(map(len, pieces)):
                to = at + rng.randrange(1, 90)
                for stream, piece, out in zip(streams, pieces, outs, strict=True):
                    out += stream.feed(piece[at:to])
                at = to
            for stream, piece, out in zip(streams, pieces, outs, strict=True):
                out += stream.finish()
                assert out == judge(FILES[0])._encode_single_piece(piece)
                assert stream.longest_wait <= 2 * longest


def test_utf8_machine():
    rng = random.Random(13)
    samples = [bytes(rng.choices([0x41, 0x7F, 0x80, 0x9F, 0xA0, 0xBF, 0xC0, 0xC2, 0xDF, 0xE0, 0xED, 0xEF, 0xF0, 0xF4, 0xF5, 0xFF], k=rng.randrange(1, 14))) for _ in range(4000)]
    samples += ["aé東😀߿￿\U0010ffff".encode() * 3, b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xf0\x9f\x98"]
    for data in samples:
        machine, plain, at, said = bpe.Utf8Stream(), codecs.getincrementaldecoder("utf-8")("replace"), 0, []
        while at < len(data):
            to = at + rng.randrange(1, 4)
            said.append(machine.feed(data[at:to]))
            at = to
        said.append(machine.close())
        assert "".join(said) == plain.decode(data, True) == data.decode("utf-8", "replace")


def expected(doc_id, text):
    ids = judge(FILES[0]).encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_edge_rows(spark):
    docs = docs_frame(spark, edge_rows()).selectExpr("*", "'x' AS ids", "1 AS n_tokens", "2 AS decoded")
    coded = bpe.encode_texts(docs)
    back = coded.select("doc_id", "n_tokens", "ids", bpe.decode_column(spark, coded["ids"]).alias("text")).collect()
    got = [(r.doc_id, r.n_tokens, hashlib.sha256(bytes(r.ids)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in back]
    assert sorted(got, key=str) == sorted((expected(i, t) for i, t, _, _ in edge_rows()), key=str)
    both = bpe.encode_texts(docs, decode=True).collect()
    assert sorted([(r.doc_id, bytes(r.ids), r.decoded) for r in both], key=str) == sorted([(r.doc_id, bytes(r.ids), r.text) for r in back], key=str)
    assert bpe.encode_texts(docs.limit(0), decode=True).count() == 0


def test_other_vocabulary(spark):
    vocabulary = (rank_file(FILES[1]), public_tokenizers.PATTERN)
    texts = ["東京都 и мир", None, "the end"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: ids_of(bytes(r.ids)) for r in bpe.encode_texts(docs, vocabulary=vocabulary).collect()}
    assert got == {i: judge(FILES[1]).encode_ordinary(t or "") for i, t in enumerate(texts)}
    with pytest.raises(ValueError, match="lacks the bytes"):
        bpe.ranks_of(b"YQ== 0\n")


def test_query_against_library(spark):
    path = "/root/testdata/sf0.01"
    got = [tuple(r) for r in queries.op13_byte_bpe(spark, path).collect()]
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(got) == sorted(expected(*r) for r in rows)
