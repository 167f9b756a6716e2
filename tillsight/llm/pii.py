"""PII by pattern, and what else would give it away.

Pattern spans (e-mail, IP address, card, phone) are the protected entities.  Corpus
co-occurrence then tells how much each term says about an entity: with document
frequencies n, a term t near entity c discloses the share PMI(c, t) / IC(c) =
1 + ln(n_ct / n_t) / ln(N / n_c) of the entity's information.  Terms that disclose
``GENERALISE`` of it or more are generalised wherever they occur; from ``REMOVE`` on they are removed.

Chance is told apart by a test over different texts (copies of a whole text count once): that so
many texts have both must have a probability of at most ``CHANCE`` if terms and entities were
spread independently.  Pairs in fewer than ``SUPPORT`` texts are many, so for them the bound holds for
all pairs of the corpus together.

All statistics are sums over all documents.  The terms in question are passed to the tasks
as a bit set of fixed size, only to skip what cannot matter; joins decide.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import ROW_ID, hash_words, staged, text_buffers, with_package, word_spans

KINDS = ("email", "ip", "card", "phone")
NEAR_CHARS = 80
SUPPORT = 3
CHANCE = 0.01
GENERALISE = 0.9
REMOVE = 0.97
FILTER_BITS = 24
MIN_TERM_BYTES = 1
_SLICE_BYTES = 2 << 20
#: Counts that a task holds before it sums or passes them on.
_HELD = 1 << 20

# The patterns of the contract, in a form that reads any text once.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9][0-9. -]*")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_TERM_BYTES = np.zeros(256, bool)
_TERM_BYTES[48:58] = _TERM_BYTES[65:91] = _TERM_BYTES[97:123] = True
_TERM_BYTES[128:] = True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        part = text[done:at]
        start = done + len(part.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _part_ok(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The pattern spans of a text by kind, in code points, end exclusive."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = [*_emails(text)]
    for run in _NUMBERS.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        for m in _DOTTED.finditer(text, a, b):
            at, parts = m.start(), m.group().split(".")
            for i in range(0, len(parts) - 3, 4):
                end = at + sum(map(len, parts[i : i + 4])) + 3
                if all(map(_part_ok, parts[i : i + 4])):
                    found["ip"].append((at, end))
                at = end + 1
        for m in _CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found["phone"].append(m.span())
    return found


def _listed(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])


def _terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of texts: (first text, text of each term, hash, byte start, byte end, bytes)."""
    data, offsets = text_buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE_BYTES, "right")) - 1)
        part = offsets[at : to + 1]
        starts, ends = word_spans(data, part, _TERM_BYTES)
        long = np.flatnonzero(ends - starts >= MIN_TERM_BYTES)
        starts, ends = starts[long], ends[long]
        hashes = hash_words(data, starts, ends, True).view(np.int64)
        owner = np.searchsorted(part, starts, "right") - 1
        yield at, owner, hashes, starts, ends, part
        at = to


def _in_term(c: str) -> bool:
    """Whether a character's UTF-8 bytes are ``_TERM_BYTES``."""
    return c >= "\x80" or bool(_TERM_BYTES[ord(c)])


def _splits(text: str, at: int) -> bool:
    return 0 < at < len(text) and _in_term(text[at - 1]) and _in_term(text[at])


def _near_terms(text: str, start: int, end: int) -> str:
    """The text on both sides of an entity, without runs of letters and digits that the cut or the
    entity's own border splits."""
    a, b, c, d = max(0, start - NEAR_CHARS), start, end, min(len(text), end + NEAR_CHARS)
    while a < b and _splits(text, a):
        a += 1
    while a < b and _splits(text, b):
        b -= 1
    while c < d and _splits(text, c):
        c += 1
    while c < d and _splits(text, d):
        d -= 1
    return text[a:b] + "\n" + text[c:d]


_PAIR = T.StructType([T.StructField("text", T.LongType()), T.StructField("entity", T.LongType()), T.StructField("term", T.LongType())])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, entity in it and distinct term near that entity; a null term
    stands for the entity itself."""
    for batch in batches:
        entities, documents, sides = [], [], []
        for text in batch.column(0):
            if not text.is_valid:
                continue
            text = text.as_py()
            by_entity: dict[int, list[str]] = {}
            for kind, spans in base_spans(text).items():
                for a, b in spans:
                    value = text[a:b].lower() if kind == "email" else "".join(c for c in text[a:b] if c.isdigit() or c == ".")
                    by_entity.setdefault(xxhash.xxh64_intdigest(f"{kind}:{value}") >> 1, []).append(_near_terms(text, a, b))
            if by_entity:
                key = xxhash.xxh64_intdigest(text) >> 1
                for entity, near in by_entity.items():
                    entities.append(entity)
                    documents.append(key)
                    sides.append("\n".join(near))
        rows = [(np.arange(len(sides)), np.full(len(sides), -1))]  # a null term for each entity
        for first, owner, hashes, *_ in _terms(pa.array(sides, pa.string())):
            both = np.unique(np.stack((owner + first, hashes)), axis=1)
            rows.append((both[0], both[1]))
        of = np.concatenate([r[0] for r in rows]).astype(np.int64)
        terms = np.concatenate([r[1] for r in rows])
        null = np.concatenate([np.full(len(r[0]), i == 0) for i, r in enumerate(rows)])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(documents, np.int64)[of]), pa.array(np.array(entities, np.int64)[of]), pa.array(terms, pa.int64(), mask=null),
        ], names=["text", "entity", "term"])


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bit_set(terms: DataFrame) -> np.ndarray:
    """A table over all slots of the hash, true where a term of ``terms`` has its slot: built from bit
    maps of fixed size (``2 ** FILTER_BITS`` bits in all), which alone reach the driver."""
    slot = F.shiftrightunsigned(F.col("term"), 64 - FILTER_BITS)
    maps = terms.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m"))
    bits = np.zeros(1 << FILTER_BITS, bool)
    for row in maps.toLocalIterator():
        own = np.unpackbits(np.frombuffer(row["m"], np.uint8), bitorder="little")
        # Spark's buckets count from 1 and hold the numbers above their start; 0 has bucket 0.
        base = (row["b"] - 1) * len(own) + 1 if row["b"] > 0 else 0
        at = np.flatnonzero(own)
        bits[(base + at) % (1 << FILTER_BITS)] = True
    return np.packbits(bits)


def _counter(shared) -> Callable:
    """Documents by term, summed over a task's slices as far as ``_HELD`` goes."""

    def summed(held: list) -> tuple[np.ndarray, np.ndarray]:
        terms, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        times = np.zeros(len(terms), np.int64)
        np.add.at(times, at, np.concatenate([h[1] for h in held]))
        return terms, times

    def rows(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, summed(held))], names=["term", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).view(bool)
        held: list = []
        for batch in batches:
            for _, owner, hashes, *_ in _terms(batch.column(0)):
                hit = np.flatnonzero(wanted[_slots(hashes)])
                distinct = np.unique(np.stack((hashes[hit], owner[hit])), axis=1)[0]
                held.append(np.unique(distinct, return_counts=True))
                if sum(len(h[0]) for h in held) > _HELD:
                    held = [summed(held)]
                    if len(held[0][0]) > _HELD // 2:
                        yield rows(held)
                        held = []
        if held:
            yield rows(held)

    return count


def _surprise(draws: Column, hits: Column, chance: Column) -> Column:
    """Minus the logarithm of a bound (Chernoff, Hoeffding) on the probability of ``hits`` or more in ``draws``
    with or without putting back; 0 if that many are expected."""
    share = hits / draws
    missed = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
    return F.when(share > chance, draws * (share * F.log(share / chance) + missed)).otherwise(0.0)


def _evidence(texts: Column, of_entity: Column, of_term: Column, both: Column) -> Column:
    """The better of both readings of the hypergeometric tail: the entity's texts as draws, or the term's."""
    return F.greatest(_surprise(of_entity, both, of_term / texts), _surprise(of_term, both, of_entity / texts))


def disclosing_terms(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """``term`` (its hash) and ``share``: the largest share of a protected entity's information
    that the term discloses, for terms that reach ``threshold``."""
    spark = with_package(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text")).filter(F.col(text_col).isNotNull())
    pairs = staged(texts.mapInArrow(_pairs, _PAIR).groupBy("entity", "term", "text").agg(F.count(F.lit(1)).alias("n")), "entity-terms")
    joint = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_ct"), F.count(F.lit(1)).alias("d_ct"))
    n_c = joint.filter("term IS NULL").select("entity", F.col("n_ct").alias("n_c"), F.col("d_ct").alias("d_c"))
    joint = staged(joint.filter(F.col("term").isNotNull()).join(n_c, "entity"), "entity-term-counts")
    total = docs.count()
    different = F.lit(float(max(1, texts.select(F.xxhash64("text")).distinct().count())))
    needed = F.lit(-math.log(CHANCE)) + F.when(F.col("d_ct") < support, math.log(max(1, joint.count()))).otherwise(0.0)
    # An entity in every document holds no information to disclose.
    share = lambda n_t: 1 + F.log(F.col("n_ct") / n_t) / F.log(F.lit(float(max(total, 1))) / F.col("n_c"))
    # The term's other documents are at most so many different texts.
    real = lambda n_t: _evidence(different, F.col("d_c"), F.col("d_ct") + n_t - F.col("n_ct"), F.col("d_ct")) >= needed
    # Both fall with n_t.  What fails with the documents where the term is near any entity, which are
    # fewer, needs no count over the corpus.
    near = pairs.filter("term IS NOT NULL").groupBy("term", "text").agg(F.max("n").alias("n")).groupBy("term").agg(F.sum("n").alias("n_near"))
    joint = joint.filter(F.col("n_c") < total).join(staged(near, "near-terms"), "term")
    joint = staged(joint.filter((share(F.col("n_near")) >= threshold) & real(F.col("n_near"))).drop("n_near"), "entity-term-candidates")
    shared = spark.sparkContext.broadcast(_bit_set(joint.select("term")))
    seen = texts.mapInArrow(_counter(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    told = joint.join(seen, "term").filter(real(F.col("n_t"))).select("term", share(F.col("n_t")).alias("share"))
    return staged(told.groupBy("term").agg(F.max("share").alias("share")).filter(F.col("share") >= threshold), "disclosing-terms")


def find_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, threshold: float = GENERALISE, with_text: bool = False,
) -> DataFrame:
    """One row per document: ``id_col``, the counts ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base`` (pattern spans as ``kind:start:end`` by kind, then start, comma-joined),
    ``terms`` (array of start, end, share of the disclosing terms, by start) and, if asked
    for, ``text``.  Offsets count code points, ends are exclusive.

    Null texts are empty and have no spans; rows with equal or null ids stay apart.  Equal
    texts get equal spans.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    told = disclosing_terms(docs, text_col, support, threshold)
    shared = spark.sparkContext.broadcast(_bit_set(told.select("term")))
    hits_type = T.ArrayType(T.StructType([T.StructField("term", T.LongType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base", T.StringType()), T.StructField("hits", hits_type), *([T.StructField("text", T.StringType())] if with_text else []),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            found = [base_spans(t.as_py()) if t.is_valid else dict.fromkeys(KINDS, []) for t in batch.column(1)]
            hits: list[list] = [[] for _ in found]
            data, _ = text_buffers(batch.column(1))
            for first, owner, hashes, starts, ends, part in _terms(batch.column(1)):
                hit = np.flatnonzero(wanted[_slots(hashes)])
                if not len(hit):
                    continue
                base = int(part[0])
                points = np.concatenate(([0], np.cumsum((data[base : int(part[-1])] & 0xC0) != 0x80)))  # code points before each byte
                begin = points[part[owner[hit]] - base]
                for o, h, s, e in zip(owner[hit], hashes[hit], points[starts[hit] - base] - begin, points[ends[hit] - base] - begin, strict=True):
                    hits[first + o].append({"term": int(h), "start": int(s), "stop": int(e)})
            columns = [batch.column(0), *(pa.array([len(f[k]) for f in found], pa.int64()) for k in KINDS), pa.array([*map(_listed, found)], pa.string())]
            columns.append(pa.array(hits, pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([*columns, *([batch.column(1)] if with_text else [])], names=[f.name for f in schema])

    scanned = staged(docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(scan, schema).withColumn(ROW_ID, F.monotonically_increasing_id()), "pattern-spans")
    terms = (
        scanned.filter(F.size("hits") > 0).select(ROW_ID, F.explode("hits").alias("h")).select(ROW_ID, "h.*").join(told, "term")
        .groupBy(ROW_ID).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "share"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:bigint,stop:bigint,share:double>>")
    return scanned.drop("hits").join(terms, ROW_ID, "left").drop(ROW_ID).withColumn("terms", F.coalesce("terms", none))


def all_spans(base: Column, terms: Column) -> Column:
    """Pattern spans, then terms as ``term:start:end``, comma-joined."""
    added = F.transform(terms, lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["stop"].cast("string")))
    return F.array_join(F.concat(F.filter(F.array(base), lambda b: b != ""), added), ",")


@F.arrow_udf(T.StringType())
def _replaced(texts: pa.Array, base: pa.Array, terms: pa.Array, remove: pa.Array) -> pa.Array:
    out = []
    for text, spans, told, limit in zip(texts.to_pylist(), base.to_pylist(), terms.to_pylist(), remove.to_pylist(), strict=True):
        if text is None:
            out.append(None)
            continue
        cuts = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (s.split(":") for s in (spans or "").split(",") if s)]
        cuts += [(t["start"], t["stop"], "" if t["share"] >= limit else "[TERM]") for t in told or ()]
        pieces, at = [], 0
        for a, b, name in sorted(cuts, key=lambda c: (c[0], -c[1])):
            if a >= at:
                pieces += [text[at:a], name]
            at = max(at, b)
        out.append("".join(pieces) + text[at:])
    return pa.array(out, pa.string())


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, threshold: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``find_spans`` with ``text`` sanitised: pattern spans and terms generalised to their kind in
    brackets, terms that disclose ``remove`` or more cut out.  Of overlapping spans the
    first names the replacement.  A null text stays null."""
    found = find_spans(docs, id_col, text_col, support, threshold, with_text=True)
    return found.withColumn("text", _replaced("text", "base", "terms", F.lit(remove)))
