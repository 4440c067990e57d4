"""The queries that SQL can express, as SQL."""

# Words of each text, and those of A-Z in lower case.
_WORDS = r"""
words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents
)"""
_LOWER = """
lowered AS (
  SELECT doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                  FOR x IN w] AS w
  FROM words
)"""

ORACLE: dict[str, str] = {
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM documents
), keyed AS (
  SELECT doc_id, line, line_no,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines
), shared AS (
  SELECT line_key, max(doc_id) AS keeper
  FROM keyed
  WHERE length(line_key) >= 40
  GROUP BY line_key
  HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, shared.line_key IS NOT NULL AND doc_id <> keeper AS dropped
  FROM keyed LEFT JOIN shared USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked
GROUP BY doc_id
""",
    "op3_top_k": """
WITH vectors AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op13_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
         CAST(list_dot_product(a.v, d.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors d ON a.vec_id <> d.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored
  WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id,
         score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                 ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked
WHERE rank <= 5
""",
    "quality_base": f"""
WITH {_WORDS}, windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS hash
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, hash) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM repeated, range(8) AS r(k)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY doc_id
), counted AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
""",
    "op9_substring_dedup": f"""
WITH {_WORDS}, windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS hash
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY hash) > 1
), removed AS (
  SELECT DISTINCT doc_id, i + k AS spot FROM repeated, range(35) AS r(k)
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS spot FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS text, count(*) AS n
  FROM placed ANTI JOIN removed USING (doc_id, spot)
  GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op12_ngram_join": f"""
WITH RECURSIVE {_WORDS}, {_LOWER}, shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM lowered WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y
  FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common.n >= 80 * (a.n + b.n - common.n)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT x, x AS y FROM both_ways
  UNION
  SELECT reached.x, both_ways.y FROM reached JOIN both_ways ON reached.y = both_ways.x
), least AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""",
}
