"""SQL over the same tables, for those operators that SQL can express. Numbers and lists are written out anew."""

from rivertally.llm.licenses import RULES, SENTENCES

QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS s
  FROM d WHERE len(w) >= 3),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM g) WHERE c > 1),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: list_contains(string_split('the of and to in a is that for it as was with be by on are or this from at not have which de la le et les des en un du une que est pour qui dans sur pas au par der die und den von zu das mit sich des auf für ist im dem nicht ein eine el y los se del las por con una su para al lo como', ' '), lower(x)))) AS BIGINT) AS n_stop_words,
         CAST(len(l) AS BIGINT) AS n_lines
  FROM d LEFT JOIN r USING (rid)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         concat_ws(',', CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 'word_length' END,
           CASE WHEN 10 * n_symbols > n_words AND n_words > 0 THEN 'symbols' END,
           CASE WHEN 100 * n_stop_words < 2 * n_words THEN 'stop_words' END,
           CASE WHEN 2 * n_dup_lines > n_lines THEN 'repeated_lines' END) AS broken
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines,
       base_failed, NOT base_failed AND broken = '' AS kept, broken
FROM v
"""

_SENTENCES = ", ".join(f"('{sentence}', '{name}')" for name, sentence in SENTENCES.items())
_RULES = ", ".join(f"({i}, '{r.licence}', '|{'||'.join(r.sentences)}|')" for i, r in enumerate(RULES))

LICENCE_SCAN = rf"""
WITH known(sentence, name) AS (VALUES {_SENTENCES}),
rules(i, licence, stretch) AS (VALUES {_RULES}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT rid, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS s
  FROM (SELECT rid, string_split_regex(regexp_replace(lower(t), '[.;:!?](\s|$)', E'\n', 'g'), '\n') AS parts FROM d)),
ids AS (SELECT rid, pos, name FROM cut JOIN known ON trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) = sentence),
line AS (SELECT rid, count(*) AS n, string_agg(name, ', ' ORDER BY pos) AS names, string_agg('|' || name || '|', '' ORDER BY pos) AS line FROM ids GROUP BY rid),
steps AS (
  WITH RECURSIVE r(rid, i, line, found) AS (
    SELECT rid, 0, line, [] :: VARCHAR[] FROM line
    UNION ALL
    SELECT rid, r.i + 1, replace(r.line, stretch, '||'),
           CASE WHEN contains(r.line, stretch) AND NOT list_contains(found, licence) THEN list_append(found, licence) ELSE found END
    FROM r JOIN rules ON rules.i = r.i)
  SELECT rid, line AS rest, found FROM r WHERE i = (SELECT count(*) FROM rules))
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(names, '') AS sentences,
       coalesce(array_to_string(found, ', '), '') AS licences,
       coalesce(array_to_string(list_filter(string_split(rest, '|'), lambda x: x <> ''), ', '), '') AS unmatched
FROM d LEFT JOIN line USING (rid) LEFT JOIN steps USING (rid)
"""

WARC = """
WITH d AS (SELECT page_id, sha1(coalesce(html, '')) AS s, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
t AS (SELECT s, n, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY s, n)
SELECT page_id, n AS payload_bytes, s AS payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM d LEFT JOIN t USING (s, n)
"""

RANKED_SEARCH = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
d AS (SELECT rid, doc_id, CAST(len(t) AS BIGINT) AS n FROM cut WHERE len(t) > 0),
sizes AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM cut) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, sizes GROUP BY term, n_docs),
item AS (
  SELECT item_id, row_number() OVER () AS ik, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
s AS (
  SELECT ik, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN w USING (term) JOIN tf USING (term) JOIN d USING (rid), sizes GROUP BY ALL)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY ik ORDER BY score DESC, doc_id NULLS FIRST) AS r FROM s WHERE score > 0) WHERE r <= 50
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS pid, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f1 AS (SELECT lang, w[i] AS x, count(*) AS f FROM spots GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM spots WHERE i + 1 <= len(w) GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM spots WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
around AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, 1 AS k, f2.f AS a, l.f AS l, r.f AS r
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  LEFT JOIN around ON around.lang = f2.lang AND around.x = f2.x AND around.y = f2.y
  WHERE f2.f >= 10 AND NOT coalesce(100 * around.f >= 50 * f2.f, false)
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 1, f3.f, l.f, r.f
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.x = f3.x JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 2, f3.f, l.f, r.f
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM scored) WHERE c = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest) JOIN n USING (lang) WHERE rank <= 2000
"""
