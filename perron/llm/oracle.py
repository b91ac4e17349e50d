"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: One step of CRC-32 (reflected polynomial 0xEDB88320) over eight bits, unrolled by a list of eight.
_BIT = "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"


def crc32(expr: str) -> str:
    """Unsigned CRC-32 of the digits (and sign) of an integer, as a BIGINT; null for null."""
    byte = f"list_reduce(range(1, 9), {_BIT}, xor(c, b))"
    return (f"xor(list_reduce(list_transform(string_split(CAST({expr} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
            f"lambda c, b: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)")


_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, first: str) -> str:
    """Levels of the trees over ``first`` (grp, i, node): grp, level, i, n (nodes of the level), node."""
    return f"""
{name} AS (
  SELECT grp, 0 AS level, i, n, node FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {first})
  UNION ALL
  SELECT grp, level, i, (n + 15) // 16, node FROM (
    SELECT grp, level + 1 AS level, i // 16 AS i, max(n) AS n, sha256(string_agg(node, '' ORDER BY i)) AS node
    FROM {name} WHERE n > 1 GROUP BY grp, level, i // 16)
)"""


#: Leaves, trees by level, and for each leaf a walk up its tree that gathers siblings and folds.
OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {crc32("doc_id")} % 5 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS altered
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves
), firsts AS (SELECT grp, i, leaf AS node FROM placed),
{_tree("low", "firsts")},
subroots AS (SELECT 0 AS grp, grp AS i, node FROM low WHERE n = 1),
{_tree("high", "subroots")},
levels AS (
  SELECT grp, level, i, n, node, max(level) OVER (PARTITION BY grp) AS height FROM low
), walk AS (
  SELECT grp AS g, i AS spot, 0 AS step, i AS place, '' AS gathered, altered AS folded FROM placed
  UNION ALL
  SELECT g, spot, step + 1, place // 16, gathered || others, sha256(before || folded || behind) FROM (
    SELECT w.g, w.spot, w.step, w.place, w.gathered, w.folded,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i <> w.place), '') AS others,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i < w.place), '') AS before,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i > w.place), '') AS behind
    FROM walk w JOIN levels l ON l.grp = w.g AND l.level = w.step AND l.i // 16 = w.place // 16
    WHERE w.step < l.height
    GROUP BY ALL)
), top AS (
  SELECT w.g, w.spot, w.gathered, w.folded FROM walk w JOIN (SELECT DISTINCT grp, height FROM levels) h ON h.grp = w.g AND h.height = w.step
), crowns AS (
  SELECT level, i, node, max(level) OVER () AS height FROM high
), upper AS (
  SELECT g, spot, 0 AS step, g AS place, gathered, folded FROM top
  UNION ALL
  SELECT g, spot, step + 1, place // 16, gathered || others, sha256(before || folded || behind) FROM (
    SELECT w.g, w.spot, w.step, w.place, w.gathered, w.folded,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i <> w.place), '') AS others,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i < w.place), '') AS before,
           coalesce(string_agg(l.node, '' ORDER BY l.i) FILTER (WHERE l.i > w.place), '') AS behind
    FROM upper w JOIN crowns l ON l.level = w.step AND l.i // 16 = w.place // 16
    WHERE w.step < l.height
    GROUP BY ALL)
)
SELECT p.doc_id, p.leaf, s.node AS subroot, r.node AS root, sha256(u.gathered) AS proof_sha256, u.folded AS folded_root, u.folded = r.node AS verified
FROM placed p
JOIN upper u ON u.g = p.grp AND u.spot = p.i
JOIN subroots s ON s.i = p.grp
JOIN (SELECT node FROM high WHERE n = 1) r ON true
WHERE u.step = (SELECT max(level) FROM high)
"""

#: Rebuilt conversations as strings of turn hashes; every prefix of each is grouped, and each node counts for all above it.
OP13 = f"""
WITH said AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
  FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, bytes, mark, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos FROM said
), c AS (
  SELECT conv_id, count(*) AS n, {crc32("conv_id")} % 9 AS h, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, 0 AS side, t.pos, bytes, mark FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, bytes, mark FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h
), whole AS (
  SELECT c.conv_id, count(r.mark) AS len, coalesce(string_agg(r.mark, '' ORDER BY side, pos), '') AS marks, list(r.bytes ORDER BY side, pos) AS bytes
  FROM c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), starts AS (
  SELECT conv_id, len, bytes, unnest(range(0, len + 1)) AS depth, marks FROM whole
), nodes AS (
  SELECT substr(marks, 1, 64 * depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(CASE WHEN depth = 0 THEN 0 ELSE bytes[depth] END) AS bytes,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = depth), '') AS ends,
         bool_and(len = depth) AS childless
  FROM starts GROUP BY ALL
), ups AS (
  SELECT substr(path, 1, 64 * k) AS path, k AS depth, sum(CAST(childless AS BIGINT)) AS n_leaves, sum((n_convs - 1) * bytes) AS saved,
         count(*) FILTER (WHERE d = k + 1) AS n_children
  FROM (SELECT path, depth AS d, n_convs, bytes, childless, unnest(range(0, depth + 1)) AS k FROM nodes) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(u.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN ups u ON u.depth = n.depth AND u.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 64 * (n.depth - 1))
"""

#: All pairs of usable vectors, and for each the least vec_id within reach.
OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE list_inner_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings WHERE vec_id IS NOT NULL
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT e.vec_id, count(l.b) AS n_links, (SELECT min(other) FROM reach r WHERE r.vec_id = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(other) FROM reach r WHERE r.vec_id = e.vec_id) AS kept
FROM embeddings e LEFT JOIN links l ON l.a = e.vec_id
GROUP BY e.vec_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

#: Shingles of every text, counted together by pairs of documents, and for each document the least one within reach.
OP4 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), together AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM together JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""

#: Equal lines in pairs with an earlier one; pairs that follow each other in both texts are a run.
OP5 = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq
  FROM (SELECT *, len({_WORDS.format("line")}) AS words FROM split) WHERE words > 0
), pairs AS (
  SELECT a.doc_id, a.seq, a.words, b.doc_id AS other, a.seq - b.seq AS shift
  FROM lines a JOIN lines b ON a.line = b.line AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.seq < a.seq))
), runs AS (
  SELECT *, seq - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY seq) AS run FROM pairs
), dead AS (
  SELECT DISTINCT doc_id, seq FROM (SELECT *, sum(words) OVER (PARTITION BY doc_id, other, shift, run) AS held FROM runs) WHERE held >= 50
), marked AS (
  SELECT s.doc_id, s.pos, s.line, d.seq IS NOT NULL AS gone
  FROM split s LEFT JOIN lines l ON l.doc_id = s.doc_id AND l.pos = s.pos LEFT JOIN dead d ON d.doc_id = l.doc_id AND d.seq = l.seq
), left_over AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_deleted, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(o.n_deleted, 0) AS n_deleted, length(CASE WHEN o.n_deleted > 0 THEN o.text ELSE d.text END) AS n_chars,
       CASE WHEN o.n_deleted > 0 THEN o.text ELSE d.text END AS text
FROM documents d LEFT JOIN left_over o ON o.doc_id = d.doc_id
"""

SQL: dict[str, str] = {"op4_jaccard_join": OP4, "op5_line_dedup": OP5, "op11_embedding_dedup": OP11, "op12_merkle_manifest": OP12, "op13_prefix_trie": OP13}
