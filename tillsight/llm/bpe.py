"""Byte-level BPE encoding and decoding with a lazily determinised transducer.

Encoding.  A sequence of tokens is what the merges make of its bytes exactly if every two neighbours
are what they make of those two tokens' bytes.  That is a finite-state transducer over bytes: it has
written some tokens, stands at a node of the trie of all tokens with the bytes since, and may
end a token where the node is one and fits the token before it.  The encoding of every
prefix is unique, so one hypothesis at most lives for each start of the token to come.  The transducer
is determinised as texts need it: a state is the set of live hypotheses (trie node and token before), and
each step tells which token ends the encoding up to there.  Tokens are written once all live hypotheses share
them: no hypothesis lives longer than the longest token, so the lookahead is bounded.  States beyond a
fixed number are forgotten and made anew.

Decoding.  Token ids are turned into bytes in chunks of bounded size; an incremental UTF-8 state machine holds
back the bytes of a character that a chunk leaves open.

Token ids of a text are one binary value, little-endian unsigned 32-bit integers one after the other.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import groups_of, with_package

#: States kept at a time, and pieces of a text whose tokens are remembered (of up to so many characters).
MAX_STATES = 200_000
MAX_PIECES = 600_000
PIECE_CHARS = 32
#: Pairs of tokens whose fitting is remembered.
MAX_PAIRS = 400_000
#: Bytes of a piece after which tokens that are certain are written.
WINDOW = 1024
#: Tokens decoded at a time.
CHUNK = 1 << 16
#: Bytes of the texts that a task encodes before it hands them on.
SLICE = 1 << 21
#: Texts of more characters are split without a list of all their pieces.
LONG_TEXT = 1 << 20
_ROOT = 0


def default_vocabulary() -> tuple[bytes, str]:
    """Rank file and splitting pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def ranks_of(rank_file: bytes) -> dict[bytes, int]:
    """Token bytes and their ids; lines of a rank file are base64 bytes and a number."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, rank_file.splitlines()))}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the bytes {missing[:8]}")
    return ranks


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """What the merges make of a few bytes: the neighbours of lowest rank (the first of them) are
    joined until none can be."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


class History:
    """How the merges make one token: the pieces at its left and right end, each with the rank of the merge
    that formed it (-1: a byte, there from the start) and of the one that used it up (none: infinity)."""

    def __init__(self, data: bytes, ranks: dict[bytes, int]) -> None:
        parts = [data[i : i + 1] for i in range(len(data))]
        left, right, order = [(parts[0], -1)], [(parts[-1], -1)], []
        while found := [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]:
            rank, i = min(found)
            at_end = i == len(parts) - 2
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            order.append(rank)
            if i == 0:
                left.append((parts[0], rank))
            if at_end:
                right.append((parts[-1], rank))
        #: Whether the merges make the token at all, and do so in the order of their ranks.
        self.reached, self.in_order = len(parts) == 1, order == sorted(order)
        ends = lambda pieces: [(p, formed, used) for (p, formed), used in zip(pieces, [*(r for _, r in pieces[1:]), float("inf")], strict=True)]
        self.left, self.right = ends(left), ends(right)


class Transducer:
    """Bytes of one piece in, token ids out; determinised as needed."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES) -> None:
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.arcs: list[dict[int, int]] = [{}]  # of the trie of all tokens
        self.token_at, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = _ROOT
            for b in token:
                to = self.arcs[node].get(b)
                if to is None:
                    to = self.arcs[node][b] = len(self.arcs)
                    self.arcs.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = to
            self.token_at[node] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self.histories: dict[int, History] = {}
        self._forget()

    def _forget(self) -> None:
        #: A state: live hypotheses (trie node, token before or -1) from the earliest start on; the last one has just ended a token.
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.start = self.number(START)

    def number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return number

    def history(self, token: int) -> History:
        known = self.histories.get(token)
        if known is None:
            known = self.histories[token] = History(self.bytes_of[token], self.ranks)
        return known

    def stay_apart(self, before: int, token: int) -> bool:
        """Whether the merges leave two tokens as they are: no merge joins a piece at the right end of the
        first with one at the left end of the second while both are there."""
        a, b = self.history(before), self.history(token)
        if not (a.reached and b.reached):
            return False
        if not (a.in_order and b.in_order):
            return merged(self.bytes_of[before] + self.bytes_of[token], self.ranks) == [before, token]
        for p, p_formed, p_used in a.right:
            for q, q_formed, q_used in b.left:
                rank = self.ranks.get(p + q)
                if rank is None:
                    continue
                # Of equal ranks the merge further left comes first.
                if rank > p_formed and rank > q_formed:
                    if rank < p_used and rank <= q_used:
                        return False
                elif p_formed <= q_used and q_formed < p_used:  # joined as soon as both are there
                    return False
        return True

    def fits(self, before: int, token: int) -> bool:
        """Whether the merges leave ``token`` after ``before`` (-1: at the start) as they are."""
        if before < 0:
            return self.history(token).reached
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[before, token] = self.stay_apart(before, token)
        return known

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """The next state, and the token that ends the encoding of all bytes so far; kept for the next time."""
        arcs, token_at = self.arcs, self.token_at
        live, ended = [], -1
        for node, before in self.states[state]:
            to = arcs[node].get(byte)
            if to is None:
                continue
            if arcs[to]:
                live.append((to, before))
            token = token_at[to]
            if token >= 0 and ended < 0 and self.fits(before, token):
                ended = token
        live.append((_ROOT, ended))
        if len(self.states) >= self.max_states:
            self._forget()
            return self.number(tuple(live)), ended
        move = self.moves[state][byte] = (self.number(tuple(live)), ended)
        return move

    def run(self, state: int, data: bytes, ends: list[int]) -> int:
        """The state after more bytes; ``ends`` gets the token that ends the encoding at each of them."""
        moves = self.moves
        for byte in data:
            move = moves[state].get(byte)
            if move is None:
                move = self.move(state, byte)
                moves = self.moves
            state, ended = move
            ends.append(ended)
        return state

    def written(self, ends: list[int], upto: int) -> list[int]:
        """The tokens of the first ``upto`` bytes, from the last one back."""
        out = []
        while upto:
            token = ends[upto - 1]
            out.append(token)
            upto -= self.length[token]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token is that token, whatever the merges make of it
            return [whole]
        if len(piece) > WINDOW:
            stream = Stream(self)
            return stream.feed(piece) + stream.finish()
        ends: list[int] = []
        self.run(self.start, piece, ends)
        return self.written(ends, len(ends))


#: Nothing read yet.
START = ((_ROOT, -1),)


class Stream:
    """A piece in any cuts; tokens come out as soon as no hypothesis differs in them."""

    def __init__(self, transducer: Transducer) -> None:
        self.transducer, self.state, self.ends = transducer, START, []
        #: Most bytes that were held back.
        self.longest_wait = 0

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), WINDOW):
            number = self.transducer.run(self.transducer.number(self.state), data[at : at + WINDOW], self.ends)
            self.state = self.transducer.states[number]  # numbers may change while others are read
            out += self._settled()
        return out

    def _settled(self) -> list[int]:
        """Tokens up to the last place where the encodings that live hypotheses go on from all end a token."""
        common: set[int] | None = None
        for node, _ in self.state:
            at, places = len(self.ends) - self.transducer.depth[node], set()
            while at:
                places.add(at)
                at -= self.transducer.length[self.ends[at - 1]]
            common = places if common is None else common & places
        upto = max(common or (), default=0)
        out = self.transducer.written(self.ends, upto)
        del self.ends[:upto]
        self.longest_wait = max(self.longest_wait, len(self.ends))
        return out

    def finish(self) -> list[int]:
        out = self.transducer.written(self.ends, len(self.ends))
        self.state, self.ends = START, []
        return out


class Encoder:
    """Texts to packed token ids; pieces met before are remembered, up to a fixed number."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.transducer = Transducer(ranks_of(rank_file))
        self.pattern = regex.compile(pattern)
        self.memo = _Pieces(self.transducer)

    def encode(self, text: str) -> bytes:
        if len(self.memo) > MAX_PIECES:
            self.memo.clear()
        if len(text) <= LONG_TEXT:
            return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))
        out = bytearray()
        for found in self.pattern.finditer(text):
            out += self.memo[found.group()]
            if len(self.memo) > MAX_PIECES:
                self.memo.clear()
        return bytes(out)


class _Pieces(dict):
    """Packed token ids of pieces; short ones are kept."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.transducer.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= PIECE_CHARS:
            self[piece] = ids
        return ids


def _following() -> list[dict[int, int]]:
    """States of the UTF-8 machine: 0 between characters, 1 to 3 with so many continuation bytes to come, 4 to 7
    after E0, ED, F0 and F4, whose next byte is restricted (overlong forms, surrogates, over U+10FFFF)."""
    spans = [
        [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
        [(0x80, 0xBF, 0)], [(0x80, 0xBF, 1)], [(0x80, 0xBF, 2)], [(0xA0, 0xBF, 1)], [(0x80, 0x9F, 1)], [(0x90, 0xBF, 2)], [(0x80, 0x8F, 2)],
    ]
    return [{b: to for low, high, to in state for b in range(low, high + 1)} for state in spans]


class Utf8Stream:
    """Bytes in any cuts in, whole characters out.  Bytes that no character has become U+FFFD."""

    following = _following()

    def __init__(self) -> None:
        self.held = b""

    def open_bytes(self, data: bytes) -> int:
        """How many bytes at the end belong to a character that is not complete yet."""
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] >= 0xC0:  # the last character's first byte
                state: int | None = 0
                for b in data[-back:]:
                    state = self.following[state].get(b)
                    if state is None:
                        return 0
                return back if state else 0
            if data[-back] < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.open_bytes(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        left, self.held = self.held, b""
        return left.decode("utf-8", "replace")


class Decoder:
    """Packed token ids to text; ids that are no token are an error."""

    def __init__(self, rank_file: bytes) -> None:
        self.bytes_of = {rank: token for token, rank in ranks_of(rank_file).items()}

    @classmethod
    def of(cls, bytes_of: dict[int, bytes]) -> Decoder:
        made = cls.__new__(cls)
        made.bytes_of = bytes_of
        return made

    def stream(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Text as it becomes certain, from packed ids in chunks of whole ids."""
        machine = Utf8Stream()
        for chunk in chunks:
            yield machine.feed(b"".join(map(self.bytes_of.__getitem__, np.frombuffer(chunk, "<u4").tolist())))
        yield machine.close()

    def decode(self, ids: bytes) -> str:
        return "".join(self.stream(ids[at : at + 4 * CHUNK] for at in range(0, len(ids), 4 * CHUNK)))


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """No garbage collection meanwhile: states form no cycles, and there are many to walk."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_made: dict[tuple, Encoder | Decoder] = {}


def _in_worker(kind: type, *settings) -> Encoder | Decoder:
    """The encoder or decoder of a vocabulary in this worker, which keeps it from task to task."""
    key = (kind.__name__, *(hashlib.sha256(s if isinstance(s, bytes) else s.encode()).digest() for s in settings))
    if key not in _made:
        for old in [k for k in _made if k[0] == kind.__name__]:
            del _made[old]
        _made[key] = kind(*settings)
    return _made[key]


def encode_column(spark: SparkSession, text: Column, vocabulary: tuple[bytes, str] | None = None) -> Column:
    """Packed token ids (binary) of a text column, as the merges of ``vocabulary`` (rank file, splitting
    pattern) make them, without special tokens.  Null and empty texts have none: an empty value."""
    shared = with_package(spark).sparkContext.broadcast(vocabulary or default_vocabulary())

    @F.arrow_udf(T.BinaryType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _in_worker(Encoder, *shared.value)
        for texts in batches:
            with _uncollected():
                ids = pa.array([encoder.encode(t.as_py() or "") for t in texts], pa.binary())
            yield ids

    return encode(text)


def decode_column(spark: SparkSession, ids: Column, vocabulary: tuple[bytes, str] | None = None) -> Column:
    """Text of packed token ids.  Null and empty ids give an empty text; bytes that are no character U+FFFD."""
    shared = with_package(spark).sparkContext.broadcast((vocabulary or default_vocabulary())[0])

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _in_worker(Decoder, shared.value)
        for packed in batches:
            yield pa.array([decoder.decode(p.as_py() or b"") for p in packed], pa.string())

    return decode(ids)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def encode_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[bytes, str] | None = None, decode: bool = False
) -> DataFrame:
    """``id_col``, ``ids`` (packed) and ``n_tokens`` of every row; with ``decode`` also ``decoded``, the text that the ids
    give back.  Rows are encoded one by one, in slices of bounded size: null or repeated ids, repeated
    rows and other columns change nothing; a null or empty text has no tokens; an empty table gives no rows."""
    spark = with_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary or default_vocabulary())
    kind = T.StructType([docs.schema[id_col], T.StructField("ids", T.BinaryType())])
    if decode:
        kind = kind.add("decoded", T.StringType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _in_worker(Encoder, *shared.value)
        decoder = Decoder.of(encoder.transducer.bytes_of)
        for batch in batches:
            at = 0
            for some in groups_of(batch.column(1), SLICE):
                with _uncollected():
                    ids = [encoder.encode(t.as_py() or "") for t in some]
                    columns = [batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary())]
                    if decode:
                        columns.append(pa.array([decoder.decode(i) for i in ids], pa.string()))
                at += len(ids)
                yield pa.RecordBatch.from_arrays(columns, names=kind.names)

    coded = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, kind)
    return coded.withColumn("n_tokens", n_tokens(F.col("ids")))
