"""DuckDB SQL of the operators' queries, where SQL can express them."""

# Fixed values of the contracts.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = _LOWER.format(f"trim(line, {_SPACES})")

LINE_DEDUP = f"""
WITH lines AS (
  SELECT d.rowid AS r, d.doc_id, u.pos, u.line, {_KEY.replace('line', 'u.line')} AS k
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos) u),
common AS (
  SELECT k, max(doc_id) AS top FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.r, l.doc_id, l.pos, l.line, c.k IS NOT NULL AND l.doc_id <> c.top AS gone
  FROM lines l LEFT JOIN common c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|'
              || md5(coalesce(text, ''))), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
ranked AS (
  SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                      WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM per),
-- the level at which the targets come to 150 %: try each cap as the last that is reached
caps AS (
  SELECT c, sum(2 * s) OVER (ORDER BY c) AS capped, sum(w) OVER () - sum(w) OVER (ORDER BY c) AS rest
  FROM (SELECT *, CAST(2 * s AS DOUBLE) / w AS c FROM ranked)),
total AS (SELECT CAST(sum(s) AS DOUBLE) * 150 / 100 AS t FROM ranked),
levels AS (
  SELECT t / (SELECT sum(w) FROM ranked) AS level, CAST(-1 AS DOUBLE) AS c FROM total
  UNION ALL
  SELECT (t - capped) / rest, c FROM caps, total WHERE rest > 0),
level AS (SELECT arg_max(level, c) AS level FROM levels WHERE level >= c),
targets AS (
  SELECT source, s, CASE WHEN 2 * s <= level * w THEN CAST(2 * s AS DOUBLE) ELSE level * w END AS target
  FROM ranked, level)
SELECT doc_id, size, s AS source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (SELECT d.doc_id, d.size, d.u, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0.0 END AS rate
      FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
"""

DECONTAM = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g
  FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 9))) AS i) WHERE len(w) > 0),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
lengths AS (SELECT DISTINCT n FROM item_windows),
hits AS (
  SELECT d.r, d.i, x.n, x.item_id
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n) d
  JOIN item_windows x ON x.n = d.n AND x.g = array_to_string(list_slice(d.w, d.i, d.i + d.n - 1), ' ')),
words AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

_AUTHORITY = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1)"
_HOST = _LOWER.format(rf"regexp_replace(regexp_replace({_AUTHORITY}, '^.*@', ''), ':[0-9]*$', '')")


def _digits(start: int, n: int) -> str:
    return f"CAST('0x' || substr(md5(pattern), {start}, {n}) AS BIGINT)"


# every capture against every interval
URL_LISTS = rf"""
WITH p AS (
  SELECT page_id, url, 1704067200 + (page_id * 86413) % 31622400 AS t,
         nullif(regexp_replace({_HOST}, '\.$', ''), '') AS host,
         coalesce(nullif({_PATH}, ''), '/') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host, regexp_extract(path, '^(/[^/]+/)', 1) AS part FROM p WHERE host IS NOT NULL),
pats AS (
  SELECT 'blocklist' AS list, 'domain' AS kind, host AS pattern FROM hosts
  UNION SELECT 'parents', 'domain', regexp_replace(host, '^[^.]*\.', '') FROM hosts
  UNION SELECT 'sections', 'prefix', {_LOWER.format('host || part')} FROM hosts WHERE part <> ''),
dated AS (
  SELECT *, 1704067200 + 86400 * ({_digits(1, 6)} % 250) AS added, 86400 * (1 + {_digits(7, 4)} % 90) AS on_list,
         86400 * ({_digits(11, 4)} % 60) AS off_list,
         CASE WHEN {_digits(15, 2)} % 4 = 0 THEN 'allow' ELSE 'block' END AS action, {_digits(17, 2)} % 3 AS n
  FROM pats),
valid AS (
  SELECT list, kind, pattern, action, added AS lo, CASE WHEN n > 0 THEN added + on_list END AS hi FROM dated
  UNION ALL
  SELECT list, kind, pattern, action, added + on_list + off_list, NULL FROM dated WHERE n > 1),
hit AS (
  SELECT p.page_id, v.*, row_number() OVER (PARTITION BY p.page_id ORDER BY kind <> 'prefix', -length(pattern),
                                            action <> 'allow', list, pattern, lo) AS rank,
         count(*) OVER (PARTITION BY p.page_id) AS n_active
  FROM p JOIN valid v ON v.lo <= p.t AND (v.hi IS NULL OR p.t < v.hi)
   AND CASE v.kind WHEN 'domain' THEN p.host = v.pattern OR ends_with(p.host, '.' || v.pattern)
                   ELSE starts_with(p.host || {_LOWER.format('p.path')}, v.pattern) END)
SELECT p.page_id, p.url, p.t AS fetched_at, p.host, h.action, h.list, h.pattern, h.lo AS valid_from,
       coalesce(h.n_active, 0) AS n_active
FROM p LEFT JOIN hit h ON h.page_id = p.page_id AND h.rank = 1
"""

# the only dependencies that point forward are those of turn 1 on turn 3, which waits for it in turn
TOOL_CALLS = """
WITH c AS (
  SELECT conv_id, turn, text, 'c' || conv_id || '-' || turn AS id, (conv_id * 7 + turn) % 11 AS fault,
         (conv_id + turn) % 3 AS kind, length(coalesce(text, '')) AS n, CAST(to_json(coalesce(text, '')) AS VARCHAR) AS q
  FROM conversations WHERE role = 'assistant'),
r AS (SELECT conv_id, turn, turn - 1 AS answers, text, 'c' || conv_id || '-' || (turn - 1) AS id
      FROM conversations WHERE role = 'user'),
deps AS (
  SELECT conv_id, turn, turn - 2 AS dep FROM c WHERE turn >= 2
  UNION SELECT conv_id, turn, turn - 4 FROM c WHERE turn >= 5
  UNION SELECT conv_id, turn, turn + 2 FROM c WHERE conv_id % 50 = 7 AND turn = 1),
known AS (SELECT d.* FROM deps d JOIN c ON c.conv_id = d.conv_id AND c.turn = d.dep),
lost AS (SELECT DISTINCT conv_id, turn FROM (SELECT * FROM deps EXCEPT SELECT * FROM known)),
round AS (SELECT conv_id, unnest([1, 3]) AS turn FROM known WHERE dep > turn),
calls AS (
  SELECT c.*, CASE WHEN round.turn IS NULL THEN c.turn ELSE 3 END AS place, CASE WHEN round.turn IS NULL THEN 0 END AS step,
         CASE WHEN fault = 4 THEN 'lookup' WHEN kind = 0 THEN 'search' WHEN kind = 1 THEN 'fetch' ELSE 'total' END AS name,
         list_sort(list_filter([
           CASE WHEN fault = 4 THEN 'tool' WHEN kind = 0 AND fault = 0 THEN 'type:limit'
                WHEN kind = 0 AND fault = 1 THEN 'missing:query' WHEN kind = 1 AND fault = 2 THEN 'unknown:extra'
                WHEN kind = 1 AND fault = 3 THEN 'json' END,
           CASE WHEN lost.turn IS NOT NULL THEN 'dependency' END, CASE WHEN round.turn IS NOT NULL THEN 'cycle' END],
           lambda x: x IS NOT NULL)) AS errs,
         CASE WHEN kind = 0 AND fault = 0 THEN '{"limit":"' || n || '","query":' || q || '}'
              WHEN kind = 0 AND fault = 1 THEN '{"lang":"en"}'
              WHEN kind = 0 THEN '{"lang":"en","limit":' || n || ',"query":' || q || '}'
              WHEN kind = 1 AND fault = 2 THEN '{"depth":' || c.turn || ',"extra":1,"path":' || q || '}'
              WHEN kind = 1 AND fault = 3 THEN '"{\\"path\\":\\""'
              WHEN kind = 1 THEN '{"depth":' || c.turn || ',"path":' || q || '}'
              ELSE '{"exact":true,"values":[' || c.turn || ',' || n || ']}' END AS arguments
  FROM c LEFT JOIN lost ON lost.conv_id = c.conv_id AND lost.turn = c.turn
  LEFT JOIN round ON round.conv_id = c.conv_id AND round.turn = c.turn)
SELECT coalesce(k.conv_id, r.conv_id) AS conv_id, coalesce(k.id, r.id) AS call_id, coalesce(k.turn, r.turn) AS turn,
       k.place, k.step,
       CASE WHEN k.id IS NULL THEN 'orphan_result' WHEN len(errs) > 0 THEN 'invalid' WHEN r.id IS NULL THEN 'no_result'
            ELSE 'ok' END AS status,
       coalesce(array_to_string(errs, ','), '') AS errors, CAST(r.id IS NOT NULL AS BIGINT) AS n_results,
       '{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || coalesce(k.id, r.id) || '","name":'
       || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS json
FROM calls k FULL OUTER JOIN r ON r.conv_id = k.conv_id AND r.answers = k.turn
"""

# base32 of a SHA-1: each 5 hex digits are 4 characters
WARC = """
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
encoded AS (
  SELECT page_id, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS latest,
         list_aggregate(list_transform(generate_series(0, 31), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + (CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) % 32, 1)),
           'string_agg', '') AS payload_digest
  FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM encoded
"""

# crc32 of a decimal number: the table of bytes, then a fold over the digits
_CRC_TABLE = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda a, x: CASE WHEN a % 2 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS v
        FROM range(256) r(i)))"""
_CRC = ("xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST({} AS VARCHAR), ''), lambda d: ascii(d)), "
        "lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)))")

RUNS = rf"""
WITH {_CRC_TABLE.strip()},
hashed AS (
  SELECT doc_id, {_CRC.format('doc_id')} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own
  FROM documents, crc_table),
placed AS (SELECT *, len(own) AS n, CASE WHEN len(own) > 0 THEN (h // 10) % len(own) END AS a FROM hashed),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: own[
           1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE own END AS w
  FROM placed),
words AS (SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs),
equal AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.word = y.word
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM equal)
  GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches p WHERE p.r = s.r AND p.q < s.q AND s.q % p.q = 0 AND p.start <= s.start
                                AND p.start + p.length >= s.start + s.length)),
dropped AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS text,
         first({{'start': start, 'length': length, 'q': q}} ORDER BY length DESC, start, q) AS top
  FROM runs GROUP BY r),
kept AS (
  SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM words w ANTI JOIN dropped d ON d.r = w.r AND d.i = w.i GROUP BY w.r)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, CAST(l.top.start AS BIGINT) AS start,
       CAST(l.top.length AS BIGINT) AS length, CAST(l.top.q AS BIGINT) AS period,
       CAST(1000 * l.top.length // l.top.q AS BIGINT) AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON l.r = d.r LEFT JOIN kept k ON k.r = d.r
"""

PREFIX_TRIE = rf"""
WITH {_CRC_TABLE.strip()},
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, n, {_CRC.format('c')} % 4 AS h
          FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc_table),
rebuilt AS (
  SELECT v.c, b.pos AS d, b.k, b.n_words FROM convs v JOIN turns b ON b.c = v.c - v.c % 20 AND b.pos <= v.h
  UNION ALL
  SELECT v.c, t.pos - v.h + least(v.h, coalesce(b.n, 0)), t.k, t.n_words
  FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h LEFT JOIN convs b ON b.c = v.c - v.c % 20),
prefixes AS (
  SELECT c, 0 AS d, 0 AS n_words, md5('') AS p FROM convs
  UNION ALL
  SELECT c, d, n_words, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) FROM rebuilt),
members AS (
  SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS above, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends
  FROM prefixes),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, max(n_words) AS n_words, any_value(above) AS above,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends) AS ids
  FROM members GROUP BY p, d),
children AS (SELECT above AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
weighed AS (
  SELECT n.conv_id, n.d, (n.n_convs - 1) * n.n_words AS saved, CAST(x.n IS NULL AS INT) AS leaf
  FROM nodes n LEFT JOIN children x ON x.p = n.p AND x.d = n.d),
sums AS (
  SELECT m.p, m.d, sum(w.saved) AS saved, sum(w.leaf) AS leaves
  FROM members m JOIN weighed w ON w.conv_id = m.c AND w.d >= m.d GROUP BY m.p, m.d)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(x.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.p = n.p AND s.d = n.d
LEFT JOIN children x ON x.p = n.p AND x.d = n.d
LEFT JOIN nodes a ON a.p = n.above AND a.d = n.d - 1
"""

ORACLES = {"op1_url_lists": URL_LISTS, "op2_warc": WARC, "op4_decontam": DECONTAM, "op6_line_dedup": LINE_DEDUP, "op8_mixing": MIXING, "op9_tool_calls": TOOL_CALLS,
           "op11_runs": RUNS, "op12_prefix_trie": PREFIX_TRIE}
