"""DuckDB SQL of the package's queries that SQL can express on whole tables."""

from __future__ import annotations

#: Words of a text as the contract defines them.
_WORDS = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(t=_LOWER.format(t="text"))} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i+4], ' ') ELSE array_to_string(w, ' ') END AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) t(i)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS k FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * p.k >= 75 * (a.k + b.k - p.k)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT x, x FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.k, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS.format(t="text")} AS w FROM documents),
g AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i+49], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 48, 1))) t(i)),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
cut AS MATERIALIZED (SELECT DISTINCT doc_id, j AS i FROM g JOIN f USING (k), unnest(range(i, i + 50)) t(j) WHERE first < doc_id),
kept AS (SELECT x.doc_id, string_agg(x.v, ' ' ORDER BY x.i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM d) x LEFT JOIN cut c ON c.doc_id = x.doc_id AND c.i = x.i WHERE c.i IS NULL GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM q
"""

QUALITY = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host, {_WORDS.format(t="text")} AS w FROM documents),
l AS MATERIALIZED (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
g AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 6, 1))) x(i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS times FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM h, unnest(range(i, i + 8)) x(j) WHERE times > 1 GROUP BY 1),
m AS MATERIALIZED (SELECT doc_id, host, t, {_WORDS.format(t="regexp_replace(" + _LOWER.format(t="line") + ", '[0-9]+', '0', 'g')")} AS v FROM l),
c AS (SELECT host, v, count(DISTINCT doc_id) AS docs FROM m WHERE len(v) > 0 GROUP BY 1, 2),
o AS (SELECT host, greatest(10, 0.1 * count(DISTINCT doc_id)) AS most FROM d GROUP BY 1),
x AS (SELECT doc_id, sum(len(v)) AS lost FROM m JOIN c USING (host, v) JOIN o USING (host) WHERE docs > most GROUP BY 1),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda y: length(y))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (lost > 0 AND (n_words - lost < 20 OR n_words - lost < 0.3 * n_words)) AS kept
FROM f
"""
