"""DuckDB SQL over whole tables for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op3_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_starts AS (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
  FROM items WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM item_starts),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_starts AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs JOIN sizes ON len(w) >= k),
hits AS (
  SELECT d.doc_id, d.i, d.k, x.item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM doc_starts) d
  JOIN item_windows x ON d.k = x.k AND d.g = x.g),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLE["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op8_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
pairs AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM docs)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS n FROM pairs),
lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM docs),
long_ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS n
  FROM lines WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 13),
gone AS (
  SELECT doc_id, unnest([i, i + 1]) AS i FROM ranked WHERE n > 1 UNION SELECT doc_id, i FROM long_ranked WHERE n > 1),
kept AS (
  SELECT k.doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY k.i) AS text
  FROM lines k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.i = g.i WHERE g.i IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLE["op10_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM starts),
firsts AS (SELECT g, min(doc_id) AS first FROM grams GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM grams JOIN firsts USING (g) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
kept AS (
  SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k.i) AS text
  FROM words k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.i = g.i WHERE g.i IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def _digamma(x: str) -> str:
    y = f"({x} + 6)"
    return (f"(ln{y} - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6)"
            + "".join(f" - 1 / ({x} + {i})" for i in range(6)) + ")")


def _trigamma(x: str) -> str:
    y = f"({x} + 6)"
    return (f"(1 / {y} + 1 / (2 * {y} ** 2) + 1 / (6 * {y} ** 3) - 1 / (30 * {y} ** 5) + 1 / (42 * {y} ** 7)"
            + "".join(f" + 1 / ({x} + {i}) ** 2" for i in range(6)) + ")")


def _spread(table: str) -> str:
    return f"""
  SELECT 1 / round(coalesce(least(0.5, greatest(0.0001, (sum((k - n * m) ** 2 / (m * (1 - m))) - sum(n)) / nullif(sum(n * (n - 1)), 0))),
                            0.5), 9) - 1 AS s
  FROM (SELECT CAST(n AS DOUBLE) AS n, CAST(k AS DOUBLE) AS k, m FROM {table})"""


ORACLE["op13_url_filter"] = rf"""
WITH cut AS (
  SELECT page_id, strpos(url, '://') > 0 AS ok, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
urls AS (
  SELECT page_id,
    CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path FROM cut),
judged AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
numbered AS (
  SELECT host, bad FROM urls JOIN judged ON try_cast(regexp_extract(path, '/([0-9]{{1,18}})([./][^/]*)?$', 1) AS BIGINT) = doc_id),
hosts AS (
  SELECT u.host, regexp_replace(regexp_replace(u.host, '^.*@', ''), ':[0-9]*$', '') AS bare,
         coalesce(any_value(x.n), 0) AS n, coalesce(any_value(x.k), 0) AS k
  FROM urls u LEFT JOIN (SELECT host, count(*) AS n, sum(bad) AS k FROM numbered GROUP BY host) x ON u.host = x.host GROUP BY u.host),
split AS (
  SELECT host, n, k, bare, regexp_matches(bare, '^[0-9.]+$') AS digits,
         regexp_extract(bare, '[^.]*$') AS one, regexp_extract(bare, '([^.]*\.)?[^.]*$') AS two,
         regexp_extract(bare, '([^.]*\.)?([^.]*\.)?[^.]*$') AS three FROM hosts),
named AS (
  SELECT host, n, k, CASE WHEN digits THEN bare WHEN known THEN three ELSE two END AS domain,
         CASE WHEN digits THEN '' WHEN known THEN two ELSE one END AS suffix
  FROM (SELECT *, two IN ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.in', 'co.jp', 'ne.jp', 'or.jp',
                          'co.kr', 'co.nz', 'co.za', 'com.br', 'com.cn', 'com.mx', 'com.tr') AS known FROM split)),
whole AS (SELECT (coalesce(sum(k), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS m FROM named),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM named, whole GROUP BY suffix),
s1 AS ({_spread('suffixes')}),
domains AS (
  SELECT domain, sum(d.n) AS n, sum(d.k) AS k, any_value((s * x.m + x.k) / (s + x.n)) AS m
  FROM named d JOIN suffixes x USING (suffix), s1 GROUP BY domain),
s2 AS ({_spread('domains')}),
last AS (
  SELECT host, d.n, d.k, (s * x.m + x.k) / (s + x.n) AS m FROM named d JOIN domains x USING (domain), s2),
s3 AS ({_spread('last')}),
beta AS (SELECT host, n, k, s * m + k AS a, s * (1 - m) + (n - k) AS b FROM last, s3),
bounds AS (
  SELECT host, n, k, 1 / (1 + exp(-({_digamma('a')} - {_digamma('b')}
                                    - 1.6448536269514715 * sqrt({_trigamma('a')} + {_trigamma('b')})))) AS low FROM beta),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                 WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                 WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                 WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM urls)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(n AS BIGINT) AS n_labelled, CAST(k AS BIGINT) AS n_bad
FROM ruled JOIN bounds USING (host)
"""

ORACLE["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
counted AS (SELECT doc_id, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, whole GROUP BY t),
parts AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))) AS part
  FROM counted JOIN weights USING (t) JOIN sizes USING (doc_id), whole),
scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (t) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
