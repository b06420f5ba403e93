"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op3_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
"""

ORACLE_SQL["op6_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), tri AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM tri) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), c AS (
  SELECT d.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    10 * n_symbols > n_words
    OR (len(lines) > 1 AND 2 * n_dup_lines > len(lines))
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 3 * (length(t) - length(replace(t, '!', ''))) > n_words
    OR 3 * length(regexp_replace(t, '[^0-9]', '', 'g')) > word_chars
    OR 3 * length(regexp_replace(t, '\P{Lu}', '', 'g')) > word_chars
    OR 10 * len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{L}'))) > 3 * len(words)
    OR (len(lines) > 4 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) > 9 * len(lines))
  ) AS kept
FROM b
"""

#: Weights as in ``queries.MIX_WEIGHTS``; seed 17 and one pass are the operator's defaults.
ORACLE_SQL["op10_mixing"] = """
WITH s AS (
  SELECT coalesce(source, '') AS src, CAST(count(*) AS DOUBLE) AS size, CASE WHEN coalesce(source, '') = 'src0' THEN 4.0 ELSE 1.0 END AS weight
  FROM documents GROUP BY ALL
), r AS (
  SELECT src, 1.0 * (sum(size) OVER () * weight / (sum(weight) OVER () * size)) AS rate FROM s
), u AS (
  SELECT d.*, rate,
    CAST(('0x' || substr(md5('17:count:' || doc_id), 1, 13)) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents d JOIN r ON coalesce(d.source, '') = r.src
), p AS (
  SELECT src, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY src ORDER BY k) AS upto
  FROM (SELECT src, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r)
), c AS (
  SELECT u.* EXCLUDE (rate, u), (SELECT count(*) FROM p WHERE p.src = coalesce(u.source, '') AND p.upto <= u.u) AS n FROM u
), e AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1)) AS copy FROM c)
SELECT *, CAST(('0x' || substr(md5('17:order:' || doc_id || ':' || copy), 1, 13)) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS shuffle_key
FROM e
"""

ORACLE_SQL["op13_merkle_proofs"] = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
), d AS (
  SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, c: xor(a >> 8, crc[CAST(xor(a, c) & 255 AS INTEGER) + 1])), 4294967295) % 5 = 0, false) AS marked
  FROM documents, t
), f AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body, marked FROM d
), l AS (
  SELECT doc_id, tree, sha256(head || body) AS leaf,
    sha256(head || CASE WHEN marked THEN translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE body END) AS claimed FROM f
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n
), subs AS (
  SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, place AS pos, trees AS n, subroot AS hash FROM subs
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16, n
), r AS (SELECT hash AS root FROM top WHERE n = 1
), runs AS (
  SELECT tree, level, pos // 16 AS run, list(hash ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT 't', level, pos // 16, list(hash ORDER BY pos) FROM top WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT v.doc_id, v.tree, v.pos, v.leaf, 0 AS stage, runs.level, hs, (v.pos // CAST(16 ** runs.level AS BIGINT)) % 16 AS i
  FROM leaves v JOIN runs ON runs.tree = v.tree AND runs.run = v.pos // CAST(16 ** (runs.level + 1) AS BIGINT)
  UNION ALL
  SELECT v.doc_id, v.tree, v.pos, v.leaf, 1, runs.level, hs, (s.place // CAST(16 ** runs.level AS BIGINT)) % 16
  FROM leaves v JOIN subs s USING (tree) JOIN runs ON runs.tree = 't' AND runs.run = s.place // CAST(16 ** (runs.level + 1) AS BIGINT)
), paths AS (
  SELECT tree, pos, list({'pre': array_to_string(hs[:i], ''), 'post': array_to_string(hs[i + 2:], '')} ORDER BY stage, level) AS p FROM steps GROUP BY ALL
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(p, lambda x: x.pre || x.post), ''), '')) AS proof_sha256,
  list_reduce(list_prepend(claimed, list_transform(coalesce(p, []), lambda x: x.pre || '|' || x.post)),
    lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root,
  folded_root = root AS verified
FROM leaves JOIN subs USING (tree) CROSS JOIN r LEFT JOIN paths USING (tree, pos)
"""
