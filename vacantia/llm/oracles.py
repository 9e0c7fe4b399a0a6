"""DuckDB SQL for the operators that SQL can express."""

OP7 = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, pos, ls[pos + 1] AS line FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS pos FROM d)),
t AS (SELECT doc_id, pos, list_sort(list_distinct(list_filter(string_split(translate(lower(line), chr(9) || chr(13) || chr(11) || chr(12), '    '), ' '), lambda x: x <> ''))) AS ts FROM l),
s AS (SELECT ts, len(ts) AS n, min(doc_id * 1000000 + pos) AS f FROM t WHERE len(ts) >= 1 GROUP BY ts),
w AS (SELECT f, n, unnest(ts) AS w FROM s),
p AS (SELECT f, n, w FROM (SELECT f, n, w, row_number() OVER (PARTITION BY f ORDER BY k, w) AS r FROM w JOIN (SELECT w, count(*) AS k FROM w GROUP BY w) USING (w)) WHERE r <= n - ceil(n * 90 / 100.0) + 1),
c AS (SELECT DISTINCT a.f AS fa, b.f AS fb FROM p a JOIN p b ON a.w = b.w AND a.f < b.f AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
v AS (SELECT DISTINCT fb FROM c JOIN s a ON a.f = fa JOIN s b ON b.f = fb WHERE 100 * len(list_intersect(a.ts, b.ts)) >= 90 * (a.n + b.n - len(list_intersect(a.ts, b.ts)))),
g AS (SELECT t.doc_id, t.pos FROM t JOIN s ON t.ts = s.ts WHERE t.doc_id * 1000000 + t.pos > s.f OR s.f IN (SELECT fb FROM v)),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n FROM l WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = l.doc_id AND g.pos = l.pos) GROUP BY l.doc_id)
SELECT d.doc_id, CAST(len(d.ls) AS BIGINT) AS n_lines, CAST(len(d.ls) - coalesce(k.n, 0) AS BIGINT) AS n_removed, coalesce(k.text, '') AS text FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

OP5 = """
WITH m AS (SELECT DISTINCT conv_id, turn, lower(role) AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
u AS (SELECT conv_id, turn, text, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM m WHERE role = 'user'),
q AS (SELECT conv_id, turn, text, CAST(row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS INTEGER) AS level FROM u),
a AS (SELECT conv_id, turn, text FROM m WHERE role = 'assistant'),
j AS (SELECT coalesce(q.conv_id, a.conv_id) AS conv_id, q.turn AS turn, q.text AS asked, q.level AS level, a.turn AS result_turn, a.text AS result,
  'c' || coalesce(q.conv_id, a.conv_id) || '-' || coalesce(q.turn, a.turn - 1) AS call_id
  FROM q FULL JOIN a ON q.conv_id = a.conv_id AND q.turn = a.turn - 1),
r AS (SELECT *, CASE WHEN turn IS NULL THEN 'orphan' WHEN result_turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status FROM j)
SELECT conv_id, turn, CASE WHEN turn IS NULL THEN NULL ELSE 0 END AS place, call_id, CASE WHEN turn IS NULL THEN NULL ELSE 'reply' END AS name, status, level, result_turn,
  CASE WHEN turn IS NULL THEN '' ELSE concat_ws('; ', CASE WHEN length(asked) < 1 THEN 'n_chars: below 1' END, CASE WHEN length(asked) < 1 THEN 'text: below 1' WHEN length(asked) > 400 THEN 'text: above 400' END) END AS errors,
  CASE WHEN turn IS NULL THEN '{"call_id":' || CAST(to_json(call_id) AS VARCHAR) || ',"conv_id":' || conv_id || ',"result":' || CAST(to_json(result) AS VARCHAR) || ',"result_turn":' || result_turn || ',"status":"orphan"}'
  ELSE '{"arguments":{"n_chars":' || length(asked) || ',"text":' || CAST(to_json(asked) AS VARCHAR) || '},"call_id":' || CAST(to_json(call_id) AS VARCHAR) || ',"conv_id":' || conv_id || ',"level":' || level || ',"name":"reply"'
  || coalesce(',"result":' || CAST(to_json(result) AS VARCHAR) || ',"result_turn":' || result_turn, '') || ',"status":"' || status || '","turn":' || turn || '}' END AS json
FROM r
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY_BASE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(8) AS t(k) GROUP BY doc_id),
l AS (SELECT doc_id, count(line) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b
"""

LICENSE_BASE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (SELECT * FROM (VALUES (['cc', 'by'], 'cc-by'), (['general', 'public', 'license'], 'gpl'), (['all', 'rights', 'reserved'], 'reserved')) AS v(phrase, label)),
h AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) JOIN p ON ws[i] = phrase[1] AND ws[i : i + len(phrase) - 1] = phrase)
SELECT d.doc_id, CAST(len(any_value(ws)) AS BIGINT) AS n_words, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id
"""

URL_RULES = f"""
WITH u AS (SELECT page_id, {_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT rule, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM (VALUES ('com/en/'), ('example.com/en/7'), ('net/de/'), ('example.net/de/8'), ('org/es/')) AS v(rule))
SELECT page_id, host, path, (SELECT arg_max(rule, length(rule)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule FROM u
"""


def _kmeans(k: int, rounds: int, size: int, scale: int, seed: int) -> str:
    """The rounds of k-means, one behind the other; all distances of all vectors in each."""
    steps = [
        f"""
p AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v FROM p ORDER BY c LIMIT {k})"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT i, c, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.v, c{r}.v)]) AS d FROM p CROSS JOIN c{r}) GROUP BY i)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (SELECT c, list(m ORDER BY j) AS v FROM (
  SELECT c, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
  FROM (SELECT c, unnest(v) AS x, unnest(range({size})) AS j FROM p JOIN a{r} USING (i)) GROUP BY c, j) GROUP BY c) m USING (c))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM p JOIN a{rounds} USING (i) JOIN c{rounds} USING (c)
"""


OP11 = _kmeans(8, 10, 64, 1024, 3)

OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ts, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, CAST(len(ts) AS BIGINT) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS hs FROM d),
f AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 90 THEN 'plain' WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
s AS (SELECT *, array_to_string(ts[1 : a], '') AS prefix, array_to_string(ts[a + 1 : b], '') AS middle, array_to_string(ts[b + 1 :], '') AS suffix FROM f)
SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT k, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h FROM (SELECT k, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
g AS (SELECT k, i FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
c AS (SELECT k, list(DISTINCT i + j) AS gone FROM g, range(35) AS t(j) GROUP BY k),
r AS (SELECT d.k, doc_id, ws, coalesce(len(gone), 0) AS n_removed FROM d LEFT JOIN c USING (k)),
l AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT k, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d) u
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT k, i + j AS i FROM g, range(35) AS t(j)) x WHERE x.k = u.k AND x.i = u.i) GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM r LEFT JOIN l USING (k)
"""
