"""DuckDB SQL for the rows of the queries that SQL can express, stated on its own terms."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('13:' || coalesce(CAST(doc_id AS varchar), '')), 1, 15) AS bigint) AS u FROM documents),
sources AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS double) AS weight, CAST(2 * source_size AS double) AS cap,
                   1.5 * sum(source_size) OVER () AS budget FROM sources),
levels AS (SELECT *, (CAST(budget AS double) - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM weighed),
targets AS (SELECT source, rank, source_size, CAST(budget AS double) AS budget, least(max(lv) OVER () * weight, cap) AS target FROM levels),
queues AS (SELECT s.doc_id, s.size, s.u, t.rank, t.source_size, t.target, t.budget,
                  sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.u, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS queued,
                  row_number() OVER () AS row_no
           FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
items AS (SELECT row_no, rank, size, budget, CAST(queued + r * source_size AS double) / target AS finish FROM queues, (VALUES (0), (1)) AS v(r) WHERE size > 0),
taken AS (SELECT row_no, size, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) <= budget AS ok FROM items),
summed AS (SELECT row_no, sum(size) AS taken FROM taken WHERE ok GROUP BY row_no)
SELECT q.doc_id, CAST(q.size AS bigint) AS size, CAST(q.source_size AS bigint) AS source_size, q.target, CAST(coalesce(s.taken, 0) AS bigint) AS taken
FROM queues q LEFT JOIN summed s ON q.row_no = s.row_no
"""

WARC = r"""
WITH pages2 AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS b, url, html, md5(coalesce(CAST(page_id AS varchar), '') || ' ' || coalesce(url, '')) AS m FROM pages),
records AS (
  SELECT page_id, url, html, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:uuid:',
           substr(m, 1, 8), '-', substr(m, 9, 4), '-', substr(m, 13, 4), '-', substr(m, 17, 4), '-', substr(m, 21, 12), '>', chr(13), chr(10),
           'WARC-Target-URI: ', regexp_replace(u, '[\r\n]', '', 'g'), chr(13), chr(10), 'WARC-Date: 2024-01-01T00:00:00Z', chr(13), chr(10),
           'X-Key: ', coalesce(CAST(page_id AS varchar), ''), chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10),
           'Content-Length: ', CAST(strlen(b) AS varchar), chr(13), chr(10), chr(13), chr(10), b) AS r FROM pages2)
SELECT page_id, CAST(coalesce(sum(strlen(r) + 4) OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, html NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS archive_offset,
       CAST(strlen(r) + 4 AS bigint) AS record_bytes, sha256(r) AS record_sha256,
       CASE substr(md5(coalesce(CAST(page_id AS varchar), '')), 1, 2) WHEN '00' THEN 'corrupt' WHEN '01' THEN 'missing' ELSE 'ok' END AS status
FROM records
"""

TOP_K = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS double)) AS bigint)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS double[]), CAST(c.v AS double[])) AS bigint) AS score
           FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# The words of three-word windows that a text has twice, and limits from counted buckets of whole values.
RULES = r"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS no FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
windows AS (SELECT no, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT no, w, unnest(range(1, len(w) - 1)) AS p FROM worded)),
twice AS (SELECT no, p FROM (SELECT no, p, count(*) OVER (PARTITION BY no, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT no, sum(least(3, p - coalesce(prev, -3))) AS n FROM (SELECT no, p, lag(p) OVER (PARTITION BY no ORDER BY p) AS prev FROM twice) GROUP BY no),
counts AS (
  SELECT a.doc_id, a.lang, a.source, CAST(len(w) AS bigint) AS n_words, CAST(length(array_to_string(w, '')) AS bigint) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS bigint) AS n_symbols, CAST(len(regexp_extract_all(t, '[A-Z]')) AS bigint) AS n_capitals, CAST(len(l) AS bigint) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, CAST(coalesce(c.n, 0) AS bigint) AS n_repeat_words
  FROM worded a LEFT JOIN covered c ON a.no = c.no),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols, CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals,
         CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length, CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS copied_lines,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats FROM counts),
long AS (SELECT lang, source, m, v FROM judged, LATERAL (VALUES ('symbols', symbols), ('capitals', capitals), ('word_length', word_length), ('copied_lines', copied_lines), ('repeats', repeats)) AS x(m, v)
         WHERE NOT base_failed),
bucketed AS (SELECT lang, source, m, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b FROM long),
levels AS (SELECT 1 AS lv, lang, source, m, b FROM bucketed UNION ALL SELECT 2, lang, NULL, m, b FROM bucketed UNION ALL SELECT 3, NULL, NULL, m, b FROM bucketed),
quartiles AS (SELECT lv, lang, source, m, count(*) AS docs, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM levels GROUP BY ALL),
fences AS (SELECT *, q3 + 3 * greatest(q3 - q1, CASE m WHEN 'symbols' THEN 10 WHEN 'capitals' THEN 40 WHEN 'word_length' THEN 50 WHEN 'copied_lines' THEN 150 ELSE 100 END) AS high,
                  CASE WHEN m = 'word_length' THEN q1 - 3 * greatest(q3 - q1, 50) ELSE -1 END AS low FROM quartiles),
cells AS (SELECT o.lang, o.source, o.m, CASE WHEN o.docs >= 100 THEN o.low WHEN t.docs >= 100 THEN t.low ELSE e.low END AS low,
                 CASE WHEN o.docs >= 100 THEN o.high WHEN t.docs >= 100 THEN t.high ELSE e.high END AS high
          FROM fences o JOIN fences t ON o.lv = 1 AND t.lv = 2 AND o.m = t.m AND o.lang IS NOT DISTINCT FROM t.lang JOIN fences e ON e.lv = 3 AND e.m = o.m),
wide AS (SELECT lang, source, max(CASE WHEN m = 'symbols' THEN high END) AS sh, max(CASE WHEN m = 'capitals' THEN high END) AS ch, max(CASE WHEN m = 'word_length' THEN high END) AS wh,
                max(CASE WHEN m = 'word_length' THEN low END) AS wl, max(CASE WHEN m = 'copied_lines' THEN high END) AS lh, max(CASE WHEN m = 'repeats' THEN high END) AS rh FROM cells GROUP BY lang, source)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(symbols > sh OR capitals > ch OR word_length > wh OR word_length < wl OR copied_lines > lh OR repeats > rh, false) AS kept
FROM judged j LEFT JOIN wide x ON j.lang IS NOT DISTINCT FROM x.lang AND j.source IS NOT DISTINCT FROM x.source
"""

# Trees by grouping the nodes of a level by runs of three; CRC-32 bit by bit; one walk up per document.
MANIFEST = r"""
WITH RECURSIVE
fields AS (
  SELECT row_number() OVER () AS no, doc_id, source, text, CAST(doc_id AS varchar) AS k,
         coalesce(strlen(CAST(doc_id AS varchar)) || ':' || CAST(doc_id AS varchar), '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS varchar)) || ':' || CAST(n_chars AS varchar), '-') AS head,
         replace(text, chr(10), '') AS joined FROM documents),
crcs AS (
  SELECT *, list_reduce(list_prepend(CAST(4294967295 AS bigint), list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS bigint))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS bigint[])), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM fields),
leaves AS (
  SELECT no, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN strlen(joined) || ':' || joined ELSE strlen(text) || ':' || text END, '-')) AS as_found
  FROM crcs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, no) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (
  SELECT 0 AS lv, source, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lv + 1, source, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY lv, source, pos // 3),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lv, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lv + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lv, pos // 3),
low_runs AS (
  SELECT lv, source, pos // 3 AS run, coalesce(max(h) FILTER (pos % 3 = 0), '') AS a, coalesce(max(h) FILTER (pos % 3 = 1), '') AS b, coalesce(max(h) FILTER (pos % 3 = 2), '') AS c
  FROM low WHERE n > 1 GROUP BY lv, source, pos // 3),
high_runs AS (
  SELECT lv, pos // 3 AS run, coalesce(max(h) FILTER (pos % 3 = 0), '') AS a, coalesce(max(h) FILTER (pos % 3 = 1), '') AS b, coalesce(max(h) FILTER (pos % 3 = 2), '') AS c
  FROM high WHERE n > 1 GROUP BY lv, pos // 3),
walk AS (
  SELECT no, source, 0 AS lv, pos, n, '' AS proof, as_found AS folded FROM placed
  UNION ALL
  SELECT w.no, w.source, w.lv + 1, w.pos // 3, (w.n + 2) // 3,
         w.proof || CASE w.pos % 3 WHEN 0 THEN b || c WHEN 1 THEN a || c ELSE a || b END,
         sha256(CASE w.pos % 3 WHEN 0 THEN w.folded || b || c WHEN 1 THEN a || w.folded || c ELSE a || b || w.folded END)
  FROM walk w JOIN low_runs r ON w.lv = r.lv AND w.source IS NOT DISTINCT FROM r.source AND w.pos // 3 = r.run WHERE w.n > 1),
upper_walk AS (
  SELECT w.no, s.subroot, 0 AS lv, s.pos, s.n, w.proof, w.folded FROM walk w JOIN subroots s ON w.n = 1 AND w.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.no, w.subroot, w.lv + 1, w.pos // 3, (w.n + 2) // 3,
         w.proof || CASE w.pos % 3 WHEN 0 THEN b || c WHEN 1 THEN a || c ELSE a || b END,
         sha256(CASE w.pos % 3 WHEN 0 THEN w.folded || b || c WHEN 1 THEN a || w.folded || c ELSE a || b || w.folded END)
  FROM upper_walk w JOIN high_runs r ON w.lv = r.lv AND w.pos // 3 = r.run WHERE w.n > 1)
SELECT l.doc_id, l.leaf, w.subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = t.h AS verified
FROM upper_walk w JOIN leaves l ON w.no = l.no AND w.n = 1 CROSS JOIN (SELECT h FROM high WHERE n = 1) t
"""
