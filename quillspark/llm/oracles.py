"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quillspark.llm.quality import STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP7 = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, r, t,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM docs),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM parts WHERE len(w) >= 5)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM repeated) GROUP BY r),
m AS (
  SELECT p.doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop
  FROM parts p LEFT JOIN covered c USING (r)),
j AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND n_words BETWEEN 10 AND 1000000
   AND word_chars / n_words BETWEEN 2.0 AND 14.0
   AND n_symbols / word_chars <= 0.10
   AND (n_stop + 1) / n_words >= 0.02
   AND (CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END) <= 0.35) AS kept
FROM j
"""

OP8 = """
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS size,
    CASE source WHEN 'src0' THEN 4.0 WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 0.5 ELSE 1.0 END::DOUBLE AS weight
  FROM documents GROUP BY source),
rates AS (
  SELECT source, weight * (SELECT sum(size) FROM sizes)::DOUBLE
    / ((SELECT sum(weight) FROM sizes WHERE size > 0) * size) AS rate
  FROM sizes WHERE size > 0),
grid AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 21)::BIGINT)) AS k FROM rates),
cdf AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (
    PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM grid),
drawn AS (
  SELECT *, (('0x' || substr(md5('mix:' || name), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u FROM (
    SELECT *, coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) AS name FROM documents)),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.name,
    (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c < d.u) AS n
  FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
  substr(md5('mix:' || copy || ':' || name), 1, 16) AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counted)
"""

OP9 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
judged AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM hosts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
f AS (
  SELECT lang, k, phrase, count(*) AS c FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k)))
  GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.c AS l, y.c AS r, cut, ((2000000::HUGEINT * a) // (x.c + y.c))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, a FROM (
    SELECT lang, w, a, s, unnest(range(1, k - s + 2)) AS i FROM (
      SELECT *, unnest(range(2, k)) AS s FROM cand WHERE k > 2))),
longest AS (SELECT lang, phrase, max(a) AS within FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longest x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.within IS NULL OR 100 * x.within < 80 * b.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
  phrase, a, l, r, totals.n, score
FROM kept JOIN totals ON totals.lang = kept.lang QUALIFY rank <= 2000
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n_chars DESC, doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_quality": OP7, "op8_mixing": OP8, "op9_url_filter": OP9, "op12_phrases": OP12, "op13_exact_dedup": OP13}
