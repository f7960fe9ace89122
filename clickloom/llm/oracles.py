"""Check SQL of the corpus queries, where SQL can express them on whole tables."""

from __future__ import annotations

OP2 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP3 = """
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       unnest(range(1, len(parts) + 1)) AS r(i)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), owned AS (
  SELECT *, length(k) >= 10 AND min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""

OP4 = """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), word AS (
  SELECT doc_id, w[s] AS b, CASE WHEN s = 1 THEN '' ELSE w[s - 1] END AS a
  FROM doc, unnest(range(1, len(w) + 1)) AS r(s)
), one AS (
  SELECT b AS x, count(*) AS c FROM word GROUP BY b
  UNION ALL SELECT '', count(*) FROM word WHERE a = ''
), two AS (SELECT a, b, count(*) AS c FROM word GROUP BY a, b
), scored AS (
  SELECT doc_id, two.c < 2 AS backed,
         CASE WHEN two.c >= 2 THEN ln(two.c) - ln(ca.c) ELSE ln(0.4) + ln(cb.c) - ln((SELECT count(*) FROM word)) END AS s
  FROM word JOIN two USING (a, b) JOIN one ca ON ca.x = a JOIN one cb ON cb.x = b
), summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (backed) AS n_backoff, sum(s) AS s FROM scored GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backoff, 0) AS n_backoff, round(s / n_words, 6) AS mean_log_score
FROM doc LEFT JOIN summed USING (doc_id)
"""

OP7 = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), part AS (
  -- A thousand bytes and the windows that begin in them: taking strings out of short ones is quick.
  SELECT doc_id, c, x[2000 * c + 1 : 2000 * c + 2098] AS y, least(1000, length(x) // 2 - 1000 * c) AS m
  FROM doc, unnest(range(0, (length(x) // 2 + 999) // 1000)) AS r(c)
), byte AS (
  SELECT doc_id, 1000 * c + j AS i, y[2 * j - 1 : 2 * j] AS b,
         CASE WHEN 2 * j + 98 <= length(y) THEN y[2 * j - 1 : 2 * j + 98] END AS win
  FROM part, unnest(range(1, m + 1)) AS r(j)
), owned AS (
  SELECT doc_id, i, b, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS hit FROM byte
), covered AS (
  SELECT doc_id, i, b, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM owned
), runs AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS opens FROM covered
), summed AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed, count(*) FILTER (opens) AS spans,
         string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept
  FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM doc LEFT JOIN summed USING (doc_id)
"""

OP8 = """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g
  FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(s)
  WHERE len(w) > 0
), size AS (SELECT DISTINCT n FROM win
), hit AS (
  SELECT d.doc_id, d.s, d.n, d.g
  FROM (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS g
        FROM doc, size, unnest(range(1, len(w) - n + 2)) AS r(s)) d
  WHERE EXISTS (SELECT 1 FROM win WHERE win.n = d.n AND win.g = d.g)
), places AS (SELECT DISTINCT doc_id, p FROM hit, unnest(range(s, s + n)) AS r(p)
), counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS i FROM hit JOIN win USING (n, g)) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP11 = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents
), word AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece
), total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang
), f AS (
  SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase, count(*) AS f
  FROM word, unnest(range(1, len(w) + 1)) AS r(s), (VALUES (1), (2), (3), (4)) AS v(k)
  WHERE s + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
), cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2
), cut AS (
  SELECT c.lang, c.phrase, a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : j], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1 : c.k], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_ AS (
  SELECT lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(2, k)) AS m FROM cand), unnest(range(1, k - m + 2)) AS r(s) GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
  FROM best LEFT JOIN inner_ USING (lang, phrase) JOIN total USING (lang)
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
)
SELECT * FROM ranked WHERE rank <= 2000
"""

OP12 = """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), total AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM doc
), tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM doc) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total WHERE term IN (SELECT term FROM item) GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM tf JOIN weight USING (term) JOIN item USING (term), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

ORACLES = {"op2_exact_dedup": OP2, "op3_line_dedup": OP3, "op4_lm_scores": OP4, "op7_suffix_dedup": OP7, "op8_decontamination": OP8, "op11_collocations": OP11, "op12_search": OP12}
