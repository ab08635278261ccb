"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
        lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
    FROM words
), flat AS (SELECT doc_id, unnest(s) AS h, len(s) AS n FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS id, doc_id AS root FROM documents
    UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT id, min(root) AS component_id FROM reach GROUP BY id) r ON r.id = s.doc_id
"""

OP8 = """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

# The licences' statements, again: the digests are those of their canonical forms.
OP3 = r"""
WITH known(license, form) AS (VALUES
    ('MIT', 'released under the mit license'),
    ('MIT', 'licensed under the mit license'),
    ('Apache-2.0', 'licensed under the apache license version 2 0'),
    ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'),
    ('GPL-2.0', 'this work is licensed under the gnu general public license version 2'),
    ('CC-BY-NC-4.0', 'licensed under cc by nc 4 0'),
    ('CC-BY-4.0', 'licensed under cc by 4 0'),
    ('CC-BY-SA-4.0', 'licensed under cc by sa 4 0')
), parts AS (
    SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))) + 1)) AS line, unnest(list_concat([text], string_split(text, chr(10)))) AS part
    FROM documents
), forms AS (
    SELECT doc_id, line, trim(regexp_replace(replace(lower(part), 'licence', 'license'), '[^\p{L}\p{N}]+', ' ', 'g')) AS form FROM parts
)
SELECT doc_id, license, bool_or(line = 0) AS whole, count(*) FILTER (WHERE line > 0) AS n_lines, min(line) FILTER (WHERE line > 0) AS first_line
FROM forms JOIN known USING (form)
GROUP BY doc_id, license
"""

OP4 = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND list_max(list_transform(embedding, lambda y: abs(y))) > 0
), u AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS n FROM v),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95
), reach AS (
    SELECT vec_id AS id, vec_id AS root FROM embeddings
    UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id
), c AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""

# A column as a leaf has it; bit by bit, the crc32 of the id's text (reflected polynomial 0xEDB88320).
_FIELDS = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "text")]
_LEAF = " || ".join(_FIELDS)
_BITS = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(0, 8), lambda k: (ascii(c) >> k) & 1)))"
_CRC = f"xor(list_reduce(list_concat([4294967295], {_BITS}), lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"


def _siblings(table: str, key: str) -> str:
    run = f"OVER (PARTITION BY {key}, level, pos // 3 ORDER BY pos ROWS BETWEEN"
    return (f"SELECT {key}, level, pos, coalesce(string_agg(node, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
            f"coalesce(string_agg(node, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {table} WHERE n > 1")


OP11 = f"""
WITH RECURSIVE l AS (
    SELECT doc_id, source, sha256({_LEAF}) AS leaf,
        CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed, lang, n_chars
    FROM documents
), r AS (SELECT doc_id, source, leaf, sha256({_LEAF.replace("text", "changed")}) AS received FROM l),
t AS (
    SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM r
), up AS (
    SELECT source, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM t
    UNION ALL
    SELECT source, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM up WHERE n > 1 GROUP BY source, level, pos // 3
), sub AS (
    SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), tops AS (
    SELECT 0 AS tree, 0 AS level, pos, node, n FROM sub
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM tops WHERE n > 1 GROUP BY tree, level, pos // 3
), near AS ({_siblings("up", "source")}),
far AS ({_siblings("tops", "tree")}),
inner_fold AS (
    SELECT rid, source, 0 AS level, pos, received AS node, '' AS proof FROM t
    UNION ALL
    SELECT f.rid, f.source, f.level + 1, f.pos // 3, sha256(s.b || f.node || s.a), f.proof || s.b || s.a
    FROM inner_fold f JOIN near s ON s.source IS NOT DISTINCT FROM f.source AND s.level = f.level AND s.pos = f.pos
), at_sub AS (SELECT rid, source, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM inner_fold GROUP BY rid, source),
outer_fold AS (
    SELECT a.rid, 0 AS level, sub.pos, a.node, a.proof FROM at_sub a JOIN sub ON sub.source IS NOT DISTINCT FROM a.source
    UNION ALL
    SELECT f.rid, f.level + 1, f.pos // 3, sha256(s.b || f.node || s.a), f.proof || s.b || s.a
    FROM outer_fold f JOIN far s ON s.level = f.level AND s.pos = f.pos
), at_top AS (SELECT rid, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM outer_fold GROUP BY rid),
top AS (SELECT node AS root FROM tops WHERE n = 1)
SELECT t.doc_id, t.leaf, sub.node AS subroot, top.root, sha256(at_top.proof) AS proof_sha256, at_top.node AS folded_root, at_top.node = top.root AS verified
FROM t JOIN sub ON sub.source IS NOT DISTINCT FROM t.source JOIN at_top USING (rid), top
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = f"""
WITH d AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS term FROM documents
), q AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS term FROM benchmark)
    GROUP BY item_id, term
), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, total GROUP BY term, docs
), s AS (
    SELECT item_id, doc_id, sum(CAST(repeats AS HUGEINT) * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN len USING (doc_id), total
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

OP13 = """
WITH v AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND list_max(list_transform(embedding, lambda y: abs(y))) > 0
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, c.x), c.vec_id) AS INTEGER) AS rank,
    c.vec_id, list_distance(q.x, c.x) AS score
FROM v q JOIN v c ON len(q.x) = len(c.x) AND c.vec_id <> q.vec_id
WHERE q.vec_id % 100 = 0
QUALIFY rank <= 10
"""

ORACLE = {
    "op1_minhash": OP1,
    "op3_licences": OP3,
    "op4_covertree": OP4,
    "op8_arc_warc": OP8,
    "op11_merkle": OP11,
    "op12_lexical": OP12,
    "op13_block_knn": OP13,
}
