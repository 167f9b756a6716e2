"""Small frames for the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, schema=DOCS):
    """Documents from (doc_id, text, lang, source) tuples."""
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], schema)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def edge_rows():
    """Null and empty texts, null and repeated ids, repeated rows, a long text."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    same = prose(rng, 40)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", "a"), (None, same, "en", "b"), (None, same, "en", "b"),
        (5, same, "en", "c"), (5, same, "en", "c"), (5, prose(rng, 12), None, "a"), (9, long, "de", None), (10, long, "de", "x"), (11, "éÉ ß 😀 x", "fr", "x"),
    ]
