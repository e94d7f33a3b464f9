"""The registered queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

import re

from wordkin.suite.fixtures import GAZETTEER, LEXICON, MIN_NPMI, MIN_REL

# fixed values, written out once more: what the reports must hold
COLORS = ["DARK_RED", "RED", "BLACK", "LIGHT_GREEN", "DARK_GREEN"]
ENTITY_TYPES = ["LOCATION", "ORGANIZATION", "PERSON"]
HTML_HEADER = "<html>\n<head>\n</head>\n<body>"
HTML_FOOTER = "</body>\n</html>"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


# Named parts; a query pulls in the ones it names, with what those name in turn.
PARTS = {
    "words": r"SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents",
    "pairs_of_words": "SELECT doc_id, unnest(w[1:len(w) - 1]) AS w1, unnest(w[2:len(w)]) AS w2 FROM words WHERE len(w) >= 2",
    "ngrams": """SELECT w1, w2, CAST(1480 + (doc_id * 7) % 560 AS INTEGER) AS year, count(*) AS match_count
        FROM pairs_of_words GROUP BY ALL""",
    "stopwords": """SELECT w1 AS word FROM (SELECT w1, sum(match_count) AS n FROM ngrams GROUP BY w1)
        ORDER BY n DESC, w1 LIMIT 20""",
    "kept": """SELECT * FROM ngrams WHERE NOT EXISTS (SELECT 1 FROM stopwords WHERE word = w1)
        AND NOT EXISTS (SELECT 1 FROM stopwords WHERE word = w2)""",
    "all_pairs": """SELECT year - year % 10 AS decade, w1, w2, CAST(sum(match_count) AS BIGINT) AS c
        FROM ngrams WHERE year BETWEEN 1500 AND 2029 GROUP BY ALL""",
    "d": """SELECT year - year % 10 AS decade, w1, w2, CAST(sum(match_count) AS BIGINT) AS c
        FROM kept WHERE year BETWEEN 1500 AND 2029 GROUP BY ALL""",
    "m1": "SELECT decade, w1, CAST(sum(c) AS BIGINT) AS c1 FROM d GROUP BY ALL",
    "m2": "SELECT decade, w2, CAST(sum(c) AS BIGINT) AS c2 FROM d GROUP BY ALL",
    "sizes": "SELECT decade, CAST(2 * sum(c) AS BIGINT) AS n FROM d GROUP BY ALL",
    "scored": """SELECT decade, w1, w2, c, c1, c2, n, ln(c) + ln(n) - ln(c1) - ln(c2) AS pmi,
        (ln(c) + ln(n) - ln(c1) - ln(c2)) / -ln(c::DOUBLE / n::DOUBLE) AS npmi
        FROM d JOIN m1 USING (decade, w1) JOIN m2 USING (decade, w2) JOIN sizes USING (decade) WHERE c > 0""",
    "totals": """SELECT decade, sum(s // 1000000)::DOUBLE / 1000 AS s
        FROM (SELECT decade, w2, sum(CAST(round(npmi * 1e9) AS BIGINT)) AS s FROM scored GROUP BY ALL) GROUP BY decade""",
    "found": f"""SELECT decade, w1, w2, npmi FROM scored JOIN totals USING (decade)
        WHERE NOT (c = c1 AND c = c2)
        AND (npmi >= {MIN_NPMI} OR CASE WHEN s <> 0 THEN npmi / s >= {MIN_REL} ELSE npmi > 0 END)""",
    "raw_lines": r"""SELECT CASE ascii(w1) % 10
        WHEN 0 THEN w1 || chr(9) || year || chr(9) || match_count || chr(9) || '1'
        WHEN 1 THEN w1 || ' ' || w2 || chr(9) || substr(CAST(year AS VARCHAR), 1, 3) || chr(9) || match_count || chr(9) || '1'
        WHEN 2 THEN w1 || ' ' || w2 || chr(9) || year || chr(9) || match_count || 'x' || chr(9) || '1'
        WHEN 3 THEN w1 || ' ' || w2 || chr(9) || year || chr(9) || '-' || match_count || chr(9) || '1'
        WHEN 4 THEN w1 || ' ' || w2 || ' ' || w1 || chr(9) || year || chr(9) || match_count || chr(9) || '1'
        ELSE w1 || ' ' || w2 || chr(9) || year || chr(9) || match_count || chr(9) || '1' END AS value FROM ngrams""",
    "tokens": r"""SELECT t[1] AS w1, t[2] AS w2, t[3] AS year_token, t[4] AS count_token, len(t)::INTEGER AS n_tokens
        FROM (SELECT list_filter(string_split_regex(value, '[ \t\n\r\f]+'), lambda x: x <> '') AS t FROM raw_lines)""",
    "valid": """SELECT w1, w2, CAST(year_token AS INTEGER) AS year, CAST(count_token AS BIGINT) AS match_count FROM tokens
        WHERE n_tokens >= 4 AND regexp_full_match(year_token, '[0-9]{4}') AND TRY_CAST(year_token AS INTEGER) > 0
        AND regexp_full_match(count_token, '[+-]?[0-9]+') AND TRY_CAST(count_token AS BIGINT) >= 0""",
    "lexicon": f"SELECT * FROM (VALUES {_values(LEXICON)}) AS v(word, polarity)",
    "gazetteer": f"SELECT * FROM (VALUES {_values(GAZETTEER)}) AS v(word, type)",
    "reviews": """SELECT conv_id AS product_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
        'https://example.org/r/' || conv_id || '-' || turn AS link, text, 1 + (conv_id + turn) % 5 AS rating,
        role AS author FROM conversations""",
    "longest": r"""SELECT product_id, pos, s.sentence AS sentence FROM (
        SELECT product_id, pos, list_max(list_transform(cut, lambda x, i: {'len': length(x), 'place': -i, 'sentence': x})) AS s
        FROM (SELECT product_id, pos, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'),
            lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(12))), lambda x: x <> '') AS cut FROM reviews))""",
    "polarity": r"""SELECT product_id, pos, sum(polarity) AS p FROM (
        SELECT product_id, pos, unnest(regexp_extract_all(lower(sentence), '\p{L}+')) AS word FROM longest)
        JOIN lexicon USING (word) GROUP BY ALL""",
    "classes": """SELECT product_id, pos, CAST(CASE WHEN sentence IS NULL THEN 0
        ELSE greatest(-2, least(2, coalesce(p, 0))) + 2 END AS INTEGER) AS sentiment
        FROM longest LEFT JOIN polarity USING (product_id, pos)""",
    "names": rf"""SELECT product_id, pos, string_agg(word, ', ' ORDER BY i) AS names FROM (
        SELECT product_id, pos, unnest(t) AS word, unnest(range(len(t))) AS i
        FROM (SELECT product_id, pos, regexp_extract_all(text, '[\p{{L}}0-9]+') AS t FROM reviews))
        JOIN (SELECT DISTINCT word FROM gazetteer WHERE type IN {tuple(ENTITY_TYPES)}) USING (word) GROUP BY ALL""",
    "entities": """SELECT product_id, pos, '[' || coalesce(names, '') || ']' AS entities
        FROM reviews LEFT JOIN names USING (product_id, pos)""",
    "colors": f"""SELECT product_id, pos, sentiment, ({COLORS!r})[sentiment + 1] AS color FROM classes""",
    "processed": """SELECT product_id, pos, link, color, entities, coalesce((sentiment >= 3 AND rating <= 2)
        OR (sentiment <= 1 AND rating >= 4), false) AS is_sarcastic
        FROM reviews JOIN colors USING (product_id, pos) JOIN entities USING (product_id, pos)""",
    "entry": """SELECT product_id, pos, '{"link":"' || link || '","color":"' || color || '","namedEntities":['
        || CASE entities WHEN '[]' THEN '' ELSE '"' || replace(entities[2:length(entities) - 1], ', ', '","') || '"' END
        || '],"isSarcastic":' || CASE WHEN is_sarcastic THEN 'true' ELSE 'false' END || '}' AS entry FROM processed""",
    "json_lines": """SELECT product_id, '{"processedEntries":[' || string_agg(entry, ',' ORDER BY pos) || ']}' AS line
        FROM entry GROUP BY product_id""",
    "products": """SELECT product_id, 'p' || product_id AS title, list({'id': product_id || '-' || turn, 'link': link,
        'title': 'review ' || turn, 'text': text, 'rating': rating, 'author': author,
        'date': '2024-01-' || lpad(CAST(1 + turn % 28 AS VARCHAR), 2, '0')} ORDER BY turn) AS reviews
        FROM reviews GROUP BY product_id""",
    "product_lines": """SELECT product_id // 7 AS file_key, product_id,
        CAST(to_json({'title': title, 'reviews': reviews}) AS VARCHAR) AS line FROM products""",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY product_id) AS fragment_no,
        count(*) OVER (PARTITION BY file_key) AS expected FROM product_lines""",
    "arrived": "SELECT * FROM numbered WHERE product_id % 13 <> 5",
    "complete": """SELECT file_key, max(expected) AS fragments FROM arrived GROUP BY file_key
        HAVING count(*) = max(expected)""",
    "requests": """SELECT event_id AS seq, user_id AS client_key, event_id % 500 AS file_key,
        'input ' || user_id || ' ' || (event_id % 500) AS body, 'task ' || (event_id % 500) || '-' || user_id AS task
        FROM events""",
    "html": f"""SELECT 'f' || (product_id % 5) AS report, 1 AS section, product_id, pos,
        '<div style="color: ' || replace(lower(color), '_', '') || ';">' || chr(10) || '<p>Link: <a href="' || link
        || '">' || link || '</a></p>' || chr(10) || '<p>Named Entities: ' || entities || '</p>' || chr(10)
        || '<p>Sarcasm Detection: ' || CASE WHEN is_sarcastic THEN 'Sarcastic' ELSE 'Not Sarcastic' END || '</p>'
        || chr(10) || '</div>' AS html FROM processed
        UNION ALL SELECT 'f' || i, 0, NULL::BIGINT, NULL::BIGINT, '{HTML_HEADER}' FROM range(6) AS t(i)
        UNION ALL SELECT 'f' || i, 2, NULL::BIGINT, NULL::BIGINT, '{HTML_FOOTER}' FROM range(6) AS t(i)""",
}

SPAN_MS = 5 * 86_400_000
_PROCESSED = "SELECT link, color, entities, is_sarcastic FROM processed"
_MARGINALS = """SELECT 'n' AS kind, decade, NULL AS word, n AS total FROM sizes UNION ALL
    SELECT 'c1', decade, w1, c1 FROM m1 UNION ALL SELECT 'c2', decade, w2, c2 FROM m2"""
_LINES = """SELECT decade, w1 || chr(9) || w2 || chr(9) || 'NPMI:' || printf('%.6f', round(npmi, 6)) AS line FROM found"""

SELECTS = {
    "extract_collocations": "SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM found",
    "scan_seqfile": "SELECT * FROM valid",
    "scan_text": "SELECT * FROM valid",
    "ngram_parse": "SELECT * FROM tokens",
    "ngram_validity": "SELECT * FROM valid",
    "stopword_filter": "SELECT * FROM kept",
    "decade_bucket": """SELECT w1, w2, year, year - year % 10 AS decade, (year - year % 10) || '''s' AS label FROM ngrams""",
    "decade_window": "SELECT * FROM ngrams WHERE year BETWEEN 1500 AND 2029",
    "decade_rollup": "SELECT * FROM all_pairs",
    "decade_partition_read": "SELECT * FROM all_pairs WHERE decade IN (1900, 1950)",
    "corpus_size": "SELECT * FROM sizes",
    "left_marginal": "SELECT * FROM m1",
    "right_marginal": "SELECT * FROM m2",
    "marginals_grouping_sets": _MARGINALS,
    "join_w1": "SELECT decade, w1, w2, c, c1 FROM d JOIN m1 USING (decade, w1)",
    "join_w2": "SELECT decade, w1, w2, c, c1, c2 FROM d JOIN m1 USING (decade, w1) JOIN m2 USING (decade, w2)",
    "pmi": "SELECT decade, w1, w2, round(pmi, 6) AS pmi, round(c::DOUBLE / n::DOUBLE, 9) AS p FROM scored",
    "npmi": "SELECT decade, w1, w2, c, c1, c2, n, round(npmi, 6) AS npmi FROM scored",
    "npmi_sum": """SELECT decade, s, s_exact FROM totals
        JOIN (SELECT decade, sum(CAST(round(npmi * 1e9) AS BIGINT))::DOUBLE / 1e9 AS s_exact FROM scored GROUP BY decade) USING (decade)""",
    "filter_abs": f"SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM scored WHERE npmi >= {MIN_NPMI}",
    "filter_rel": f"""SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM scored JOIN totals USING (decade)
        WHERE CASE WHEN s <> 0 THEN npmi / s >= {MIN_REL} ELSE npmi > 0 END""",
    "filter_perfect": "SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM scored WHERE NOT (c = c1 AND c = c2)",
    "collocations_ranked": """SELECT decade, row_number() OVER (PARTITION BY decade ORDER BY round(npmi, 6) DESC, w1, w2) AS rank,
        w1, w2, round(npmi, 6) AS npmi FROM found""",
    "format_collocation": _LINES.replace("decade,", "decade || '''s' AS decade,", 1),
    "write_collocations": _LINES,
    "resume_collocations": "SELECT decade, w1, w2, round(npmi, 6) AS npmi, n FROM found JOIN sizes USING (decade)",
    "stage_counts": f"""SELECT 'lines' AS stage, count(*) AS rows FROM raw_lines
        UNION ALL SELECT 'valid', count(*) FROM valid UNION ALL SELECT 'kept', count(*) FROM kept
        UNION ALL SELECT 'pairs', count(*) FROM d UNION ALL SELECT 'marginals', count(*) FROM ({_MARGINALS})
        UNION ALL SELECT 'found', count(*) FROM found""",
    "explode_reviews": """SELECT product_id, pos, product_id || '-' || turn AS id, link, 'review ' || turn AS title, text,
        rating, author, '2024-01-' || lpad(CAST(1 + turn % 28 AS VARCHAR), 2, '0') AS date FROM reviews""",
    "longest_sentence": "SELECT * FROM longest",
    "sentiment_class": "SELECT * FROM classes",
    "color_map": "SELECT * FROM colors",
    "sarcasm": """SELECT product_id, pos, rating, sentiment, (sentiment >= 3 AND rating <= 2)
        OR (sentiment <= 1 AND rating >= 4) AS is_sarcastic FROM classes JOIN reviews USING (product_id, pos)""",
    "named_entities": "SELECT * FROM entities",
    "process_reviews": "SELECT * FROM processed",
    "processed_json": "SELECT product_id, line FROM json_lines",
    "reserialize_input": "SELECT product_id, line FROM product_lines",
    "render_html_rows": "SELECT * FROM html",
    "write_html": "SELECT report, unnest(string_split(html, chr(10))) AS line FROM html",
    "fragment_lines": "SELECT file_key, product_id, fragment_no FROM numbered",
    "assemble_file": """SELECT file_key, fragment_no, line || CASE WHEN fragment_no % 4 = 2 THEN ' ' ELSE '' END AS line
        FROM arrived JOIN complete USING (file_key)""",
    "parse_request_key": """SELECT seq, split_part(body, ' ', 1) AS kind, split_part(body, ' ', 2) AS client_key,
        split_part(body, ' ', 3) AS file_key, split_part(task, ' ', 1) AS task_kind,
        split_part(split_part(task, ' ', 2), '-', 1) AS task_file,
        CAST(split_part(split_part(task, ' ', 2), '-', 2) AS INTEGER) AS fragment_no FROM requests""",
    "dedup_requests": "SELECT DISTINCT client_key, file_key FROM requests",
    "route_results": """SELECT product_id % 500 AS file_key, product_id, pos, client_key FROM reviews
        JOIN (SELECT file_key, arg_max(client_key, seq) AS client_key FROM requests GROUP BY file_key) r
        ON r.file_key = product_id % 500""",
    "quarantine_bad_lines": """SELECT line_no, NOT json_valid(line) AS is_bad,
        CASE WHEN json_valid(line) THEN 'p' || line_no ELSE line END AS content
        FROM (SELECT product_id AS line_no, CASE WHEN product_id % 9 = 4 THEN line[:length(line) - 1] || ',' ELSE line END AS line
              FROM product_lines)""",
    "charset_fallback": "SELECT link, pos, text FROM reviews",
    "multi_file_outputs": """SELECT 'report' || (product_id % 4) AS out,
        CASE WHEN product_id % 4 = 3 OR product_id % 11 = 7 THEN '{"processedEntries":[]}' ELSE line END AS line FROM json_lines""",
    "stream_process_reviews": _PROCESSED,
    "stream_restart": _PROCESSED,
    "stream_dedup": f"""WITH spans AS (SELECT user_id AS client_key, event_id % 500 AS file_key, ts,
        (epoch_ms(ts) // {SPAN_MS} + 1) * {SPAN_MS} AS span_end FROM events)
        SELECT DISTINCT client_key, file_key, span_end, 1::BIGINT AS n, 'requests' AS kind FROM spans
        UNION ALL SELECT client_key, file_key, span_end, count(*), 'late' FROM spans WHERE ts < '2024-01-03' GROUP BY ALL""",
    "stream_assemble": "SELECT file_key, fragments FROM complete",
}


# the stages are counted from the raw lines on
OTHER_PARTS = {"stage_counts": {"kept": PARTS["kept"].replace("FROM ngrams", "FROM valid")}}


def _parts_of(sql: str, parts: dict[str, str], found: list[str]) -> list[str]:
    """The parts ``sql`` reads, each after those it needs itself."""
    for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
        if name in parts and name not in found:
            _parts_of(parts[name], parts, found)
            found.append(name)
    return found


def _query(name: str) -> str:
    sql, parts = SELECTS[name], {**PARTS, **OTHER_PARTS.get(name, {})}
    found = _parts_of(sql, parts, [])
    return ("WITH " + ",\n".join(f"{part} AS ({parts[part]})" for part in found) + "\n" if found else "") + sql


ORACLES = {name: _query(name) for name in SELECTS}
