"""DuckDB SQL for those queries whose rows SQL can express."""

OP1_LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) t, range(1, len(l) + 1) r(i)
), inked AS (
  SELECT doc_id, pos, line, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS n,
         lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2, lead(pos, 1) OVER w AS a1, lead(pos, 2) OVER w AS a2
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), windows AS (
  SELECT doc_id, pos AS first, coalesce(a2, a1, pos) AS last, [line, l1, l2] AS w FROM inked WHERE k <= greatest(n - 3, 0)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, first) AS r FROM windows
), gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN ranked w ON w.doc_id = l.doc_id AND w.r > 1 AND l.pos BETWEEN w.first AND w.last
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, bool_or(regexp_matches(l.line, '[^\\x20\\x09-\\x0D]')) AS inked
  FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
), counts AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed FROM lines l LEFT JOIN gone g USING (doc_id, pos) GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL WHEN c.n_removed = 0 THEN d.text WHEN k.inked THEN k.text ELSE '' END AS text,
       coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP9_NGRAM_JACCARD = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s FROM words
), classes AS (
  SELECT min(doc_id) AS rep, key, any_value(s) AS s, len(any_value(s)) AS n FROM (SELECT doc_id, s, list_sort(s) AS key FROM sets WHERE len(s) > 0) t GROUP BY key
), items AS (
  SELECT rep, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rep, rep AS other FROM classes UNION SELECT r.rep, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), comp AS (SELECT rep, min(other) AS component_id FROM reach GROUP BY rep),
degree AS (SELECT a AS rep, count(*) AS n_links FROM both_ways GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = c.key LEFT JOIN comp m ON m.rep = c.rep
"""

OP10_EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

OP12_LEXICAL_SEARCH = """
WITH terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents
), stats AS (
  SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM terms WHERE len(t) > 0
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
  ) b GROUP BY item_id, term
), postings AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM terms) p
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, stats GROUP BY term, n_docs
), impacts AS (
  SELECT doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS impact
  FROM postings p JOIN weights USING (term), stats
), scored AS (
  SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0
)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 20
"""

OP13_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, list_inner_product(a.e, o.e)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

SEGMENTATION_ROUND_TRIP = """
SELECT item_id, rank::INTEGER AS rank, text FROM benchmark, range(1, 3) r(rank)
"""
