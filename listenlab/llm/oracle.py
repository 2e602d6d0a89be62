"""DuckDB texts of those queries that SQL can express over whole tables."""

from __future__ import annotations

#: Water-filling by levels: at the level where just the sources below it are capped, all sizes are shared.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM sized GROUP BY source
), trial AS (
  SELECT b.source, b.w, b.source_size,
         (sum(a.source_size) - sum(CASE WHEN a.source_size * 3.0 / a.w < b.source_size * 3.0 / b.w THEN a.source_size * 3.0 ELSE 0 END))
         / sum(CASE WHEN a.source_size * 3.0 / a.w < b.source_size * 3.0 / b.w THEN 0 ELSE a.w END) AS level
  FROM per a JOIN per b ON true GROUP BY b.source, b.w, b.source_size
), pick AS (
  SELECT arg_min(level, source_size * 3.0 / w) FILTER (WHERE level <= source_size * 3.0 / w) AS level FROM trial
), targets AS (
  SELECT source, source_size, least(source_size * 3.0, level * w) AS target FROM per, pick
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM rated
"""

#: All windows, numbered by place among equal ones; a word goes if a window after the first covers it.
SUBSTRINGS = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS w FROM texts, unnest(range(1, len(words) - 18)) AS t(i)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM later
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM texts
), kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.k) AS body
  FROM placed p ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k GROUP BY p.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""

#: Pairs by their common shingles, components by walking the links.
SIMILAR = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 3
           THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS grams FROM texts
), each AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM each x JOIN each y ON x.gram = y.gram AND x.doc_id <> y.doc_id
    AND 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reached AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN least l ON l.doc_id = s.doc_id
"""

#: All pairs of a label; components by walking the links.
NEAR_VECTORS = r"""
WITH RECURSIVE held AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM held a JOIN held b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93
), reached AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.vec_id = e.vec_id LEFT JOIN least l ON l.vec_id = e.vec_id
"""

#: All anchors against all rows.
NEGATIVES = r"""
WITH held AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM held a JOIN held b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""

#: Base32 takes five bits at a time from two hex digits of the digest.
WARC = r"""
WITH held AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), hashed AS (
  SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex,
         row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS place,
         first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS first_id FROM held
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         ((strpos('0123456789abcdef', substr(hex, 5 * i // 4 + 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(hex, 5 * i // 4 + 2, 1)) - 1)
         // CAST(pow(2, 3 - 5 * i % 4) AS BIGINT) % 32 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM hashed
"""

#: Trees by level: each level groups runs of three of the one below; every row then walks up its runs.
MANIFEST = r"""
WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda acc, b: xor(acc >> 8, list_reduce([xor(acc, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda e, z: CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384::BIGINT) ELSE e >> 1 END))) & 1 = 1 AS even
  FROM documents WHERE doc_id IS NOT NULL
), fields AS (
  SELECT d.doc_id, source, text,
         coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         CASE WHEN c.even THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents d LEFT JOIN crc c ON c.doc_id = d.doc_id
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS changed FROM fields
), placed AS (
  SELECT doc_id, leaf, changed, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER () AS r FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, idx, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY level, tree, idx // 3, n
), tops AS (
  SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM nodes WHERE n = 1) AS n, digest FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 3, n
), runs AS (
  SELECT tree, level, idx // 3 AS run, list(digest ORDER BY idx) AS held FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, idx // 3, list(digest ORDER BY idx) FROM tops WHERE n > 1 GROUP BY ALL
), walk AS (
  SELECT r, tree, 0 AS level, idx, changed AS acc, '' AS sibs FROM placed
  UNION ALL
  SELECT w.r, w.tree, w.level + 1, w.idx // 3, sha256(array_to_string(held[1:w.idx % 3], '') || acc || array_to_string(held[w.idx % 3 + 2:], '')),
         sibs || array_to_string(held[1:w.idx % 3], '') || array_to_string(held[w.idx % 3 + 2:], '')
  FROM walk w JOIN runs s ON s.tree = w.tree AND s.level = w.level AND s.run = w.idx // 3
), over AS (
  SELECT r, 0 AS level, tree AS idx, acc, sibs FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1)
  UNION ALL
  SELECT w.r, w.level + 1, w.idx // 3, sha256(array_to_string(held[1:w.idx % 3], '') || acc || array_to_string(held[w.idx % 3 + 2:], '')),
         sibs || array_to_string(held[1:w.idx % 3], '') || array_to_string(held[w.idx % 3 + 2:], '')
  FROM over w JOIN runs s ON s.tree = -1 AND s.level = w.level AND s.run = w.idx // 3
), root AS (
  SELECT digest FROM tops WHERE n = 1
)
SELECT p.doc_id, p.leaf, t.digest AS subroot, root.digest AS root, sha256(o.sibs) AS proof_sha256, o.acc AS folded_root,
       o.acc = root.digest AS verified
FROM placed p JOIN (SELECT * FROM over QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1) o ON o.r = p.r
JOIN nodes t ON t.tree = p.tree AND t.n = 1 CROSS JOIN root
"""

ORACLE: dict[str, str] = {"op4_embedding_near_dedup": NEAR_VECTORS, "op6_ngram_jaccard_join": SIMILAR, "op9_substring_dedup": SUBSTRINGS, "op10_mixing": MIXING,
                          "op11_hard_negatives": NEGATIVES, "op12_warc": WARC, "op13_merkle_manifest": MANIFEST}
