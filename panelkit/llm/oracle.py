"""DuckDB SQL of the corpus queries that SQL can express, by brute force."""

from __future__ import annotations

_LINKS_TO_COMPONENTS = """
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),""" + _LINKS_TO_COMPONENTS + """
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(l.b, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.a = d.doc_id"""

OP5 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE s IN (SELECT s FROM repeated)),
place AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM place ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)"""

_VECTORS = """
vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

OP6 = "WITH RECURSIVE" + _VECTORS + """,
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),""" + _LINKS_TO_COMPONENTS + """
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(l.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN lowest l ON l.a = e.vec_id"""

# the true nearest; the forest finds them all where it has one leaf (up to
# 512 vectors) and the wanted recall of them beyond
OP8 = "WITH" + _VECTORS + """,
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

_CELLS = "concat(" + ", ".join(
    f"coalesce(strlen(CAST({{{c}}} AS VARCHAR)) || ':' || CAST({{{c}}} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"


def _leaf(text: str) -> str:
    return f"sha256({_CELLS.format(doc_id='doc_id', source='source', lang='lang', n_chars='n_chars', text=text)})"


# crc32 bit by bit: each byte, then eight shifts
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

OP11 = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN
           {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes(lang, level, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, n, pos // 8),
langs AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
over_nodes(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM langs
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM over_nodes WHERE n > 1 GROUP BY level, n, pos // 8),
inner_fold(r, lang, level, pos, n, folded, proof) AS (
  SELECT r, lang, 0, pos, n, coalesce(tampered, leaf), '' FROM placed
  UNION ALL
  SELECT f.r, f.lang, f.level + 1, f.pos // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN m.pos = f.pos THEN f.folded ELSE m.h END, '' ORDER BY m.pos)),
         f.proof || string_agg(CASE WHEN m.pos = f.pos THEN '' ELSE m.h END, '' ORDER BY m.pos)
  FROM inner_fold f JOIN nodes m
    ON m.lang IS NOT DISTINCT FROM f.lang AND m.level = f.level AND m.pos // 8 = f.pos // 8
  WHERE f.n > 1 GROUP BY f.r, f.lang, f.level, f.pos, f.n, f.folded, f.proof),
outer_fold(r, level, pos, n, folded, proof) AS (
  SELECT f.r, 0, l.pos, l.n, f.folded, f.proof
  FROM inner_fold f JOIN langs l ON l.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL
  SELECT f.r, f.level + 1, f.pos // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN m.pos = f.pos THEN f.folded ELSE m.h END, '' ORDER BY m.pos)),
         f.proof || string_agg(CASE WHEN m.pos = f.pos THEN '' ELSE m.h END, '' ORDER BY m.pos)
  FROM outer_fold f JOIN over_nodes m ON m.level = f.level AND m.pos // 8 = f.pos // 8
  WHERE f.n > 1 GROUP BY f.r, f.level, f.pos, f.n, f.folded, f.proof)
SELECT p.doc_id, p.leaf, l.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root,
       o.folded = t.h AS verified
FROM placed p JOIN langs l ON l.lang IS NOT DISTINCT FROM p.lang
JOIN outer_fold o ON o.r = p.r AND o.n = 1, (SELECT h FROM over_nodes WHERE n = 1) t"""

_WORDS12 = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS12} AS w FROM documents),
items AS (SELECT item_id, {_WORDS12} AS w FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(s) AS n FROM asked),
places AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
found AS (SELECT r, i, n, item_id FROM places JOIN asked USING (s)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON h.r = d.r LEFT JOIN named m ON m.r = d.r"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS s
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
QUALIFY rank <= 5"""

ORACLE = {
    "op13_anchor_tree": OP13,
    "op12_positional_index": OP12,
    "op11_butterfly_manifest": OP11,
    "op3_minhash_inverted_join": OP3,
    "op5_fm_substrings": OP5,
    "op6_sorted_projections": OP6,
    "op8_projection_forest": OP8,
}
