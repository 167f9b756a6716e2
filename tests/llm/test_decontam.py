from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.llm.frames import docs_frame, edge_rows, prose
from tests.oracle_harness import compare, duck
from tillsight.llm import decontam, queries
from tillsight.llm.oracles import DECONTAMINATION


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def plain(docs, items, window=10):
    """The contract by brute force: (n_words, n_hit, sorted item ids) per document."""
    phrases = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[at : at + window]), set()).add("" if item is None else str(item))
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for at in range(len(w) - n + 1):
                if (own := phrases.get(tuple(w[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


def bench_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def case():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randrange(10, 40), 60)) for i in range(12)]
    items += [(12, "short item, éclair"), (13, "Three words only"), (14, None), (15, " .,; "), (3, prose(rng, 15)), (None, prose(rng, 11))]
    rows = edge_rows()
    for i in range(80):
        text = prose(rng, rng.randrange(5, 120), 60)
        item = items[rng.randrange(12)][1].split()
        at = rng.randrange(len(item) - 9)
        kind = i % 5
        middle = {0: item, 1: item[at : at + 10], 2: item[at : at + 9], 3: "Three, WORDS\nonly!".split(), 4: []}[kind]
        rows.append((100 + i, f"{text} {' - '.join(middle)}, {prose(rng, 5)}", "en", "a"))
    rows += [(300, items[0][1][: len(items[0][1]) // 2], "en", "a"), (301, items[0][1][len(items[0][1]) // 2 :], "en", "a")]
    return rows, items


@pytest.mark.parametrize(("block_words", "segment", "candidates"), [(200_000, 4 << 20, 1 << 20), (25, 300, 3)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block_words, segment, candidates):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    rows, items = case()
    docs_frame(spark, rows).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    bench_frame(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = queries.op10_decontamination(spark, str(tmp_path)).collect()
    wanted = [(i, *p) for (i, *_), p in zip(rows, plain([r[1] for r in rows], items), strict=True)]
    sha = lambda found: hashlib.sha256(",".join(found).encode()).hexdigest()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out), key=key)
    assert got == sorted(((i, n, h, len(f), sha(f), h > 0) for i, n, h, f in wanted), key=key)


def test_small_segments_and_candidate_chunks(monkeypatch):
    """Segments of a document each and single candidates give what one segment gives."""
    import numpy as np
    import pyarrow as pa

    rows, items = case()
    blocks = decontam.PhraseBlock([(i, decontam.word_hashes(pa.array([t], pa.string()))[0]) for i, t in items if words(t)], 10)

    def matches(texts):
        hashes, counts = decontam.word_hashes(pa.array(texts, pa.string()))
        position = (np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)).astype(np.int32)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        segment = decontam.Segment(ordered[first].tobytes(), first.astype(np.int32).tobytes(), position[order].tobytes(), counts)
        return {d: rest for d, *rest in decontam._match_segment(segment, blocks, 20)}

    texts = [r[1] for r in rows]
    together = matches(texts)
    monkeypatch.setattr(decontam, "CANDIDATES", 2)
    assert matches(texts) == together
    for n, text in enumerate(texts):
        alone = matches([text])
        assert alone.get(0) == together.get(n)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    near = "gamma then alpha and epsilon so beta but delta"
    far = "gamma alpha epsilon beta " + "x " * 40 + "delta"
    docs = docs_frame(spark, [(1, near, "en", "a"), (2, far, "en", "a"), (3, f"x {item} y", "en", "a")])
    found = decontam.find_matches(decontam.build_index(docs), bench_frame(spark, [(7, item)]), window=5, slop=10)
    got = {r.doc_id: (r.n_hit, r.item_ids, r.near_item_ids, [tuple(s) for s in r.spans]) for r in found.collect()}
    assert got == {1: (0, [], ["7"], []), 2: (0, [], [], []), 3: (5, ["7"], ["7"], [(1, 5)])}


def test_decontaminate_and_empty_tables(spark):
    rows, items = case()
    docs, bench = docs_frame(spark, rows), bench_frame(spark, items)
    kept = decontam.decontaminate(docs, bench)
    clean = [r for r, p in zip(rows, plain([r[1] for r in rows], items), strict=True) if not p[1]]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(((i, t) for i, t, *_ in clean), key=key)
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    result = compare(spark, duck(sf), "op10", queries.op10_decontamination, DECONTAMINATION, sf)
    assert result["columns_match"] and result["match"], result


def test_clashing_columns_and_plans(spark):
    """Columns named like the index's change nothing; the plan of the matches is the same for one block and for many."""
    rng = random.Random(21)
    items = [(i, prose(rng, 30, 2000)) for i in range(40)]
    rows = [(i, prose(rng, 50, 2000) + (f" {items[i % 40][1]} " if i % 3 == 0 else " ") + prose(rng, 20, 2000), "en", "a") for i in range(60)]
    docs = docs_frame(spark, rows)
    more = docs.selectExpr("*", "1 AS segment", "2 AS n_words", "'x' AS terms", "3 AS n_hit", "4 AS spans", "5 AS block")
    bench = spark.createDataFrame([(*r, 7, "y") for r in items], "item_id int, text string, block int, packed string")
    told = lambda found: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in found.collect())
    plans = []
    for words_a_block in (200_000, 60):
        decontam.BLOCK_WORDS, before = words_a_block, decontam.BLOCK_WORDS
        try:
            found = decontam.find_matches(decontam.build_index(more), bench)
        finally:
            decontam.BLOCK_WORDS = before
        wanted = plain([r[1] for r in rows], items)
        assert told(found) == sorted((r[0], w[0], w[1], tuple(w[2])) for r, w in zip(rows, wanted, strict=True))
        plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert plans[0] == plans[1]
    assert decontam.decontaminate(more, bench).columns == more.columns
