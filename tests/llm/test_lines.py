from __future__ import annotations

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import docs_frame, edge_rows
from tests.oracle_harness import compare, duck
from tillsight.llm import lines, queries
from tillsight.llm.oracles import LINE_DEDUP


def plain(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, _, source in rows:
        for line in (text or "").split("\n"):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                sites[line] |= {source} - {None}
                if i is not None:
                    first[line] = min(first.get(line, i), i)
    out = []
    for i, text, _, _ in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        own = text.split("\n")
        kept = [x for x in own if len(sites[k := x.strip(" \t\r\x0b\x0c")]) < min_sites or not k or first.get(k) == i]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[3] or ""))


@pytest.mark.parametrize("min_sites", [2, 5, 30])
def test_against_brute_force(spark, min_sites):
    rng = random.Random(min_sites)
    rows = [r for r in edge_rows() if r[0] not in (9, 10)]
    for i in range(400):
        own = [f"line {rng.randrange(60)}" if rng.random() < 0.7 else f" own {i} {rng.random()}\t" for _ in range(rng.randrange(1, 9))]
        own += ["  © all rights reserved \r", ""] * (rng.random() < 0.5)
        rows.append((100 + i, "\n".join(own), "en", f"site{rng.randrange(40) if rng.random() < 0.6 else 0}"))
    out = lines.drop_boilerplate_lines(docs_frame(spark, rows), min_sites=min_sites)
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[3] or ""))
    assert got == plain(rows, min_sites)


def test_edges(spark):
    rows = edge_rows()
    out = lines.drop_boilerplate_lines(docs_frame(spark, rows).withColumn("line", F.lit("clash")), min_sites=2)
    assert out.count() == len(rows)
    assert lines.drop_boilerplate_lines(docs_frame(spark, rows).limit(0)).count() == 0


def test_texts_of_many_lines(spark):
    """20,000 lines each, half of them boilerplate: work grows with the lines, not with lines times marks."""

    def seconds(n):
        shared = [f"shared line {i}" for i in range(n // 2)]
        rows = [(i, "\n".join([x for j, s in enumerate(shared) for x in (s, f"own {i} {j}")]), "en", f"site{i}") for i in range(6)]
        rows += [(100 + i, shared[7] + "\nrest " + str(i), "en", f"other{i}") for i in range(3)]
        frame = docs_frame(spark, rows)
        start = time.perf_counter()
        out = lines.drop_boilerplate_lines(frame).collect()
        took = time.perf_counter() - start
        assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out), key=lambda x: x[0]) == plain(rows, 5)
        return took

    small = seconds(2_500)
    assert seconds(20_000) < 8 * small + 2


def test_unmarked_texts_are_not_shuffled(spark):
    rows = [(i, f"line {i}\nmore", "en", f"s{i}") for i in range(50)] + [(90 + i, f"© all\nown {i}", "en", f"s{i}") for i in range(9)]
    docs = docs_frame(spark, rows)
    hashed = lines.hashed_lines(docs.filter("doc_id >= 90"), "doc_id", "text", "source")
    marks = lines.marked_texts(hashed, lines.boilerplate_lines(hashed, 5, lines.LG_K))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), F.lit("clash").alias("marks"))
    got = {r.doc_id: r["__maybe"] for r in lines.may_be_marked(keyed, marks, "key").collect()}
    assert got == {i: i >= 90 for i, *_ in rows}


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    result = compare(spark, duck(sf), "op1", queries.op1_line_dedup, LINE_DEDUP, sf)
    assert result["columns_match"] and result["match"], result
