"""The same results in SQL, for the operators that SQL can express."""

from __future__ import annotations

EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
shared(per_weight, full_words, full_weight, step) AS (
  SELECT 150 * sum(source_size)::DOUBLE / (100 * sum(weight)), 0::BIGINT, 0::BIGINT, 0 FROM sources
  UNION ALL
  SELECT (150 * all_words - 200 * words)::DOUBLE / (100 * (all_weight - w)), words, w, step + 1
  FROM (SELECT coalesce(sum(source_size) FILTER (weight * per_weight >= 2 * source_size), 0)::BIGINT AS words,
               coalesce(sum(weight) FILTER (weight * per_weight >= 2 * source_size), 0)::BIGINT AS w,
               sum(source_size)::BIGINT AS all_words, sum(weight)::BIGINT AS all_weight,
               max(full_words) AS full_words, max(full_weight) AS full_weight, max(step) AS step
        FROM sources, shared)
  WHERE (words, w) <> (full_words, full_weight) AND all_weight > w),
targets AS (
  SELECT source, source_size, CASE WHEN source_size = 0 THEN 0 ELSE least(weight * per_weight, 2.0 * source_size) END AS target
  FROM sources, (SELECT arg_max(per_weight, step) AS per_weight FROM shared)),
budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS times FROM targets),
placed AS (
  SELECT doc_id, source, size, h, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY source, h) AS together FROM sized)
SELECT doc_id, p.source, size, source_size, target,
       (size * (times + CASE WHEN target > times * source_size AND upto - together / 2.0 <= target - times * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""

URLS = r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest
  FROM (SELECT page_id, url, coalesce(instr(url, '://'), 0) AS p FROM pages)),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM split s LEFT JOIN fits f ON s.page_id = f.page_id
"""

LINES = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered),
repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT k.*, coalesce(doc_id <> first_doc, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

TOP_K = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END ||
         CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END ||
         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END ||
         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
         CASE WHEN texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
steps AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, step::INTEGER AS step
  FROM letters a, letters b, letters c, letters d, letters e, range(1, 6) r(step)
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
seen AS (
  SELECT part, filter_order, step, n, n_good, n_toxic, substr(filter_order, step, 1) AS filter, fails,
         contains(fails, substr(filter_order, step, 1)) AS fails_here,
         length(translate(fails, substr(filter_order, 1, step - 1), '')) < length(fails) AS gone
  FROM cells, steps),
counted AS (
  SELECT part, filter_order, step, filter, sum(n * (NOT gone AND NOT fails_here)::INT)::BIGINT AS kept,
         sum(n * (NOT gone AND fails_here)::INT)::BIGINT AS removed, sum(n * (gone AND fails_here)::INT)::BIGINT AS redundant,
         sum(n * (fails = filter)::INT)::BIGINT AS unique_fails, sum(n_good * (NOT gone AND fails_here)::INT)::BIGINT AS good_lost,
         sum(n_toxic * (NOT gone AND fails_here)::INT)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, filter)
SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM counted
"""

# the checksum is computed bit by bit: 3988292384 is the reversed polynomial of CRC-32
SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT run, hex(encode(d || ':' || run)) AS code, count(*) AS n FROM runs GROUP BY d, run),
sums AS (
  SELECT run, n, xor(list_reduce(list_transform(range(4 * length(code)),
           lambda i: CASE WHEN i % 8 = 0 THEN ('0x' || substr(code, (i // 4 + 1)::BIGINT, 2))::BIGINT ELSE 0 END),
         lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295) AS h
  FROM counted),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON less.rest = words.word
  UNION SELECT words.word, less.word FROM less JOIN words ON less.rest = words.word),
ranked AS (
  SELECT p.word, near, f.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY f.n DESC, near) AS k
  FROM pairs p JOIN words f ON p.near = f.word),
spelled AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r ON w.word = r.word),
chains AS (
  SELECT word, form AS root FROM spelled WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, s.form FROM chains c JOIN spelled s ON c.root = s.word WHERE s.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chains c JOIN spelled s ON c.root = s.word WHERE s.form IS NULL)
SELECT s.word, form, coalesce(root, s.word) AS root, n, n_near, form_n FROM spelled s LEFT JOIN ends e ON s.word = e.word
"""

ORACLES = {"op2_exact_dedup": EXACT, "op3_mix_sources": MIX, "op5_url_filter": URLS, "op8_line_dedup": LINES, "op9_exact_top_k": TOP_K,
           "op11_spelling_variants": SPELLING, "op12_filter_audit": AUDIT}
