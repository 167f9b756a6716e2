from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import DOCS, docs_frame, edge_rows
from tests.oracle_harness import compare, duck
from tillsight.llm import merkle, queries
from tillsight.llm.oracles import ORACLES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """All levels of a tree over hex digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][at : at + 8])) for at in range(0, len(levels[-1]), 8)])
    return levels


def way_up(levels, i):
    steps = []
    for level in levels[:-1]:
        first = i - i % 8
        steps.append((i - first, level[first:i] + level[i + 1 : first + 8]))
        i //= 8
    return steps


def plain_fold(digest, steps):
    for place, others in steps:
        digest = sha("".join([*others[:place], digest, *others[place:]]))
    return digest


def tampered(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 0


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) from (doc_id, source, lang, n_chars, text) rows."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {la: plain_tree([x[2] for x in sorted(by_lang[la], key=lambda x: x[:3])]) for la in langs}
    top = plain_tree([trees[la][-1][0] for la in langs])
    out = []
    for at, la in enumerate(langs):
        for i, (*_, leaf, r) in enumerate(sorted(by_lang[la], key=lambda x: x[:3])):
            steps = way_up(trees[la], i) + way_up(top, at)
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            claimed = plain_leaf(*r[:4], lower) if tampered(r[0]) else leaf
            out.append((r[0], leaf, trees[la][-1][0], top[-1][0], sha("".join("".join(o) for _, o in steps)), plain_fold(claimed, steps)))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_a_block_once(levels):
    full = 8 ** (levels - 1)
    for n in {full, 1, max(1, full // 8 + 1), max(1, full // 2 - 1), max(1, full - 1), max(1, full // 64 * 9)}:
        places = np.concatenate([merkle.address(levels, t, np.arange(-(-n // 8**t)), n) for t in range(levels)])
        assert sorted(places) == list(range(merkle.nodes_in(levels, n)))


def test_addresses_are_recursive():
    """Five levels: the upper three first, then pairs of lower levels, each run of 64 leaves next to its parents."""
    assert merkle.address(5, 4, np.array([0]), 4096)[0] == 0
    assert merkle.address(5, 2, np.arange(64), 4096).max() == 1 + 8 + 64 - 1
    lower = [merkle.address(5, t, np.arange(8**(1 - t)) + k * 8**(1 - t), 4096) for k in (0, 511) for t in (1, 0)]
    assert [x.tolist() for x in lower[:2]] == [[73], list(range(74, 82))]
    assert [x.tolist() for x in lower[2:]] == [[73 + 511 * 9], list(range(74 + 511 * 9, 82 + 511 * 9))]


def test_blocks_and_siblings():
    rng = random.Random(1)
    for n in (1, 2, 7, 8, 9, 64, 65, 500, 512):
        leaves = np.frombuffer(rng.randbytes(32 * n), np.uint8).reshape(n, 32)
        plain_levels = plain_tree([x.tobytes().hex() for x in leaves])
        levels = merkle.levels_over(n)
        stored = merkle.build_block(leaves, levels)
        assert [merkle.stored_level(stored, levels, n, t).decode() for t in range(levels)] == ["".join(x) for x in plain_levels]
        for i in rng.sample(range(n), min(n, 20)):
            steps = merkle.steps_up(stored, levels, n, i)
            assert [(p, o.decode()) for p, o in steps] == [(p, "".join(o)) for p, o in way_up(plain_levels, i)]
            assert merkle.fold(leaves[i].tobytes().hex().encode(), steps).decode() == plain_levels[-1][0]


def manifest_of(docs, height):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    fields = [F.col(c) for c in merkle.FIELDS]
    rows = docs.select("doc_id", "lang", merkle.leaf(*fields).alias("leaf"), F.when(crc % 3 == 0, merkle.leaf(*fields[:4], lower)).alias("claimed"))
    return merkle.build_manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "claimed"], height)


def check(docs, height):
    got = merkle.proofs(manifest_of(docs, height), "claimed", with_steps=True).collect()
    wanted = plain([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got), key=str) == wanted
    for r in got:
        assert r.verified == (r.folded_root == r.root)
        steps = [(s.place, s.others.encode()) for s in r.steps]
        assert merkle.fold(r.leaf.encode(), steps).decode() == r.root
        assert sha("".join(o.decode() for _, o in steps)) == r.proof_sha256


@pytest.mark.parametrize("height", [1, 2, 4])
def test_against_brute_force(spark, height):
    """A hot language over several levels of blocks, a full power of 8, a lone leaf, many languages, copies."""
    rng = random.Random(height)
    words = ["Ab", "c", "É", "Z9", ""]
    sizes = {"hot": 530, "full": 64, None: 9, "": 8, "lone": 1, "Zz": 2, "é": 3} | {f"l{n}": 1 + n % 3 for n in range(12)}
    rows = []
    for la, n in sizes.items():
        rows += [(rng.randrange(5000), " ".join(rng.choices(words, k=3)), la, rng.choice(["a", None, "b"])) for _ in range(n)]
    rows += [(77, "Same Row", "hot", "a")] * 90 + [(77, "other", "hot", "a"), (None, "X", "hot", "b"), (None, None, "hot", None)]
    rng.shuffle(rows)
    check(docs_frame(spark, rows).repartition(5), height)


def test_edge_rows(spark):
    docs = docs_frame(spark, edge_rows()).selectExpr("*", "'x' AS leaf", "1 AS pos", "2 AS size", "3 AS tree", "4 AS block", "5 AS kept")
    check(docs, 4)
    assert merkle.proofs(manifest_of(spark.createDataFrame([], DOCS), 4), "claimed").count() == 0
    assert manifest_of(spark.createDataFrame([], DOCS), 4).root is None
    check(docs_frame(spark, [(3, "A", "en", "s")]), 4)


def test_any_change_is_seen(spark):
    docs = docs_frame(spark, [(i, f"Text {i}", "en", "s") for i in range(40)])
    before = manifest_of(docs, 1).root
    assert manifest_of(docs.repartition(3), 2).root == before
    assert manifest_of(docs.withColumn("text", F.when(F.col("doc_id") == 17, F.lit("Text 18")).otherwise(F.col("text"))), 1).root != before
    assert manifest_of(docs.filter("doc_id <> 39"), 1).root != before


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path, key = f"/root/testdata/{sf}", "op11_merkle_manifest"
    result = compare(spark, duck(path), key, queries.op11_merkle_manifest, ORACLES[key], path)
    assert result["match"], result
