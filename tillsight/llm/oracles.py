"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_BLANK = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
placed AS (
  SELECT doc_id, source, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM split),
trimmed AS (SELECT doc_id, source, raw, pos, trim(raw, {_BLANK}) AS line FROM placed),
boiler AS (
  SELECT line, min(doc_id) AS first_id FROM trimmed WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= 5),
marked AS (
  SELECT t.*, b.line IS NOT NULL AND b.first_id IS DISTINCT FROM t.doc_id AS goes
  FROM trimmed t LEFT JOIN boiler b ON t.line = b.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_removed,
       coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '') AS text
FROM marked GROUP BY doc_id
"""

_CONTROLS = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")


def _inserted(text: str) -> str:
    """Characters that escaping adds: one per backslash and per control string."""
    parts = [f"(length({text}) - length(replace({text}, '\\', '')))"]
    parts += [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in _CONTROLS]
    return " + ".join(parts)


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
seen AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS starts FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + {_inserted("text")}
           + CASE WHEN starts THEN 12 + 10 + 10 + length(role) + {_inserted("role")} ELSE 11 END) AS BIGINT) AS formatted_chars
FROM seen GROUP BY conv_id
"""

TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spots AS (
  SELECT item_id, s, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS ws
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
windows AS (SELECT DISTINCT item_id, n, ws, array_to_string(ws, ' ') AS phrase FROM spots),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM docs),
lengths AS (SELECT DISTINCT n FROM windows),
hits AS (
  SELECT p.doc_id, p.s, x.n, x.item_id
  FROM (SELECT doc_id, s, l.n AS n, array_to_string(list_slice(w, s, s + l.n - 1), ' ') AS phrase
        FROM placed, lengths l WHERE s + l.n - 1 <= len(w)) p
  JOIN windows x ON p.phrase = x.phrase AND p.n = x.n),
covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS spot FROM hits) GROUP BY doc_id),
exact_items AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM exact_items GROUP BY doc_id),
tokens AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
frequency AS (SELECT word, count(*) AS c FROM tokens GROUP BY word),
phrases AS (SELECT phrase, any_value(ws) AS ws FROM windows GROUP BY phrase),
terms AS (SELECT phrase, unnest(ws) AS word, generate_subscripts(ws, 1) AS off FROM phrases),
leads AS (
  SELECT phrase, arg_min(word, (c, off)) AS word, count(DISTINCT word) AS distinct_terms
  FROM (SELECT t.phrase, t.word, t.off, f.c FROM terms t LEFT JOIN frequency f ON f.word = t.word)
  GROUP BY phrase HAVING count(*) = count(c)),
candidates AS (SELECT l.phrase, l.distinct_terms, k.doc_id, k.pos FROM leads l JOIN tokens k ON k.word = l.word),
nearby AS (
  SELECT c.phrase, c.doc_id, c.pos
  FROM candidates c JOIN (SELECT DISTINCT phrase, word FROM terms) t ON t.phrase = c.phrase
  JOIN tokens k ON k.doc_id = c.doc_id AND k.word = t.word AND k.pos BETWEEN c.pos - 20 AND c.pos + 20
  GROUP BY c.phrase, c.doc_id, c.pos, c.distinct_terms HAVING count(DISTINCT t.word) = c.distinct_terms),
near_items AS (
  SELECT DISTINCT n.doc_id, CAST(x.item_id AS VARCHAR) AS i FROM nearby n JOIN windows x ON x.phrase = n.phrase),
near_only AS (
  SELECT n.doc_id, count(*) AS n_near FROM near_items n ANTI JOIN exact_items e ON e.doc_id = n.doc_id AND e.i = n.i GROUP BY n.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(o.n_near, 0) AS BIGINT) AS n_near_items
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id LEFT JOIN near_only o ON o.doc_id = d.doc_id
"""



def _clustering(k: int = 40, rounds: int = 5) -> str:
    """Lloyd rounds one after the other: distances as list sums, means as exact floors."""
    parts = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT k.row, c.cluster, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM kept k, c{n} c)
  GROUP BY row)""")
        if n < rounds:
            parts.append(f"""m{n} AS MATERIALIZED (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v
  FROM (SELECT a.cluster, t.pos, sum(k.v[t.pos]) AS s, count(*) AS n
        FROM a{n} a JOIN kept k ON k.row = a.row, (SELECT unnest(range(1, 65)) AS pos) t GROUP BY a.cluster, t.pos)
  GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON m.cluster = c.cluster)""")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k ON k.row = a.row JOIN c{rounds} c ON c.cluster = a.cluster
"""
    )


def _tree(name: str, levels: int) -> list[str]:
    """Levels of all trees over ``{name}0`` (k, i, h: tree, number, digest), each with the digests left (l) and right (r) of
    a node in its run; a tree of one node stays as it is."""
    parts = []
    for n in range(levels + 1):
        parts.append(f"""{name}s{n} AS MATERIALIZED (
  SELECT a.k, a.i, any_value(a.h) AS h, any_value(a.c) AS c, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM {name}{n}) a JOIN {name}{n} b ON a.k = b.k AND a.i // 8 = b.i // 8
  GROUP BY a.k, a.i)""")
        if n < levels:
            parts.append(f"""{name}{n + 1} AS MATERIALIZED (
  SELECT k, i // 8 AS i, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}s{n} GROUP BY k, i // 8)""")
    return parts


def _manifest(levels: int = 8, top: int = 3) -> str:
    """Up to 8**8 rows a language and 8**3 languages."""
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    digest = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        """crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)""",
        f"""docs AS MATERIALIZED (
  SELECT coalesce('=' || lang, '') AS k, doc_id, {digest("text")} AS leaf, {digest(lower)} AS folded,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c // 256, crc.t[(xor(c, b) % 256) + 1]))) % 3 = 0 AS tampered
  FROM documents, crc)""",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs)",
        "n0 AS MATERIALIZED (SELECT k, i, leaf AS h FROM placed)", *_tree("n", levels),
        f"t0 AS MATERIALIZED (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, h, k AS lang_key FROM n{levels})", *_tree("t", top),
        "f0 AS (SELECT *, CASE WHEN tampered THEN folded ELSE leaf END AS h, '' AS p FROM placed)",
    ]
    step = "SELECT f.* REPLACE (CASE WHEN s.c = 1 THEN f.h ELSE sha256(s.l || f.h || s.r) END AS h, f.p || s.l || s.r AS p) FROM"
    for n in range(levels):
        parts.append(f"f{n + 1} AS ({step} f{n} f JOIN ns{n} s ON s.k = f.k AND s.i = f.i // {8**n})")
    parts.append(f"g0 AS (SELECT f.*, t.i AS ti, t.h AS subroot FROM f{levels} f JOIN t0 t ON t.lang_key = f.k)")
    for n in range(top):
        parts.append(f"g{n + 1} AS ({step} g{n} f JOIN ts{n} s ON s.i = f.ti // {8**n})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT g.doc_id, g.leaf, g.subroot, t.h AS root, sha256(g.p) AS proof_sha256, g.h AS folded_root, g.h = t.h AS verified
FROM g{top} g, t{top} t
"""


ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op6_chat_formatting": CHAT,
    "op8_exact_topk": TOPK,
    "op10_decontamination": DECONTAMINATION,
    "op11_merkle_manifest": _manifest(),
    "op12_centroid_clustering": _clustering(),
}
