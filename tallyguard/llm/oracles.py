"""SQL that must give the same rows as the queries of this package, where SQL can express them."""

from __future__ import annotations

MERKLE = """
WITH RECURSIVE
-- CRC-32 byte by byte, with the table of the reversed polynomial 0xEDB88320.
crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS bytes(b)),
fields AS (
  SELECT doc_id, lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, crc_table),
hashed AS (
  SELECT doc_id, lang, sha256(head || body) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(octet_length(encode(lowered)) || ':' || lowered, '-')) ELSE sha256(head || body) END AS altered
  FROM fields),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
levels(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM levels WHERE n > 1 GROUP BY tree, level, pos // 8, n),
subroots AS (SELECT tree, level, digest, count(*) OVER () AS n FROM levels WHERE n = 1),
-- The tree over the subroots is tree 0.
higher(tree, level, pos, n, digest) AS (
  SELECT 0, 0, tree - 1, n, digest FROM subroots
  UNION ALL
  SELECT 0, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM higher WHERE n > 1 GROUP BY level, pos // 8, n),
beside AS (
  SELECT tree, level, pos,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT * FROM levels WHERE n > 1 UNION ALL SELECT * FROM higher WHERE n > 1)
  WINDOW w AS (PARTITION BY tree, level, pos // 8 ORDER BY pos)),
climb(doc_id, home, leaf, tree, level, pos, folded, siblings) AS (
  SELECT doc_id, tree, leaf, tree, 0, pos, altered, '' FROM leaves
  UNION ALL
  SELECT doc_id, home, leaf, tree, level, pos, folded, siblings FROM (
    SELECT c.doc_id, c.home, c.leaf, b.tree, b.level + 1 AS level, b.pos // 8 AS pos, sha256(b.before || c.folded || b.after) AS folded,
           c.siblings || b.before || b.after AS siblings
    FROM climb c JOIN beside b USING (tree, level, pos)
    UNION ALL
    SELECT c.doc_id, c.home, c.leaf, 0, 0, c.home - 1, c.folded, c.siblings
    FROM climb c JOIN subroots s ON c.tree = s.tree AND c.level = s.level))
SELECT c.doc_id, c.leaf, s.digest AS subroot, r.digest AS root, sha256(c.siblings) AS proof_sha256,
       c.folded AS folded_root, c.folded = r.digest AS verified
FROM climb c JOIN (SELECT level, digest FROM higher WHERE n = 1) r ON c.tree = 0 AND c.level = r.level
JOIN subroots s ON s.tree = c.home
"""

COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
sequences AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, w[i:i + k - 1] AS words FROM sequences, range(1, 5) AS sizes(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, words, count(*) AS n FROM grams GROUP BY lang, words),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE len(words) = 1 GROUP BY lang),
candidates AS (SELECT lang, words, n AS a FROM f WHERE len(words) > 1 AND n >= 30),
cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.words, c.a, c.k, h.n AS l, t.n AS r, ((2000000::HUGEINT * c.a) // (h.n::HUGEINT + t.n))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.words = c.words[1:c.k] JOIN f t ON t.lang = c.lang AND t.words = c.words[c.k + 1:]),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT c.lang, c.words[i:i + k - 1] AS words, c.a AS around
  FROM candidates c, range(2, 4) AS sizes(k), range(1, 5) AS starts(i) WHERE k < len(c.words) AND i + k - 1 <= len(c.words)),
covered AS (SELECT DISTINCT i.lang, i.words FROM inner_ i JOIN candidates c USING (lang, words) WHERE 100::HUGEINT * i.around >= 80::HUGEINT * c.a),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank
  FROM worst w WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = w.lang AND c.words = w.words))
SELECT ranked.lang, rank, phrase, a, l, r, totals.n AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
