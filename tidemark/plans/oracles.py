"""Reference SQL (DuckDB dialect) for the registered queries, over the driver tables.

Each statement restates the adapter rules of :mod:`tidemark.sources.adapters` and computes the result by
brute force (every window of every row listed, every pair compared), so it checks the Spark plans rather
than repeating their strategy. Epoch times use ``epoch_us(ts) // 10^k`` (floor, like Spark).
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
T_S = "(epoch_us(ts) // 1000000)"
T_MS = "(epoch_us(ts) // 1000)"


def _ts_string(ms: str) -> str:
    return (f"(strftime(make_timestamp({ms} * 1000), '%Y-%m-%d %H:%M:%S') || '.' || "
            f"CASE WHEN {ms} % 1000 = 0 THEN '0' ELSE rtrim(lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0'), '0') END)")


def _ip(u: str = "user_id") -> str:
    return (f"('10.' || CAST({u} // 65536 % 256 AS VARCHAR) || '.' || CAST({u} // 256 % 256 AS VARCHAR) || '.' "
            f"|| CAST({u} % 256 AS VARCHAR))")


def _offset(u: str = "user_id") -> str:
    return (f"list_reduce(list_transform(string_split(CAST({u} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),"
            f" lambda a, b: (a * 61 + b) % 536870912)")


PV = f"SELECT user_id, {K} AS item_id, {T_S} AS t, event_id AS seq FROM events WHERE event_type = 'view'"

ITEM_COUNTS = f"""WITH pv AS ({PV}),
w AS (SELECT item_id, (t // 300 + 1 + j) * 300000 AS window_end FROM pv, range(12) r(j))
SELECT item_id, window_end, count(*) AS cnt FROM w GROUP BY item_id, window_end"""

HOT_ITEMS = f"""WITH c AS ({ITEM_COUNTS})
SELECT window_end, rank, item_id, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM c)
WHERE rank <= 5"""

HOT_ITEMS_SQL = f"""WITH c AS ({ITEM_COUNTS})
SELECT item_id, window_end, cnt, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM c)
WHERE row_num <= 5"""


# Every ranking of every window at every epoch, compared with the one before.
HOT_ITEMS_CHANGELOG = f"""WITH pv AS ({PV}),
counted AS (
  SELECT item_id, w AS window_end, e AS epoch, count(*) AS cnt
  FROM (SELECT item_id, (t // 300 + 1 + j) * 300000 AS w, (t // 300 + 1 + i) * 300000 AS e FROM pv, range(12) r(j), range(12) s(i)
        WHERE i <= j)
  GROUP BY ALL),
ranked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end, epoch ORDER BY cnt DESC, item_id) AS rank FROM counted)
  WHERE rank <= 5),
steps AS (
  SELECT a.window_end, a.epoch, a.rank, a.item_id, a.cnt, b.item_id AS old_item, b.cnt AS old_cnt
  FROM ranked a LEFT JOIN ranked b ON b.window_end = a.window_end AND b.rank = a.rank AND b.epoch = a.epoch - 300000
  WHERE b.rank IS NULL OR a.item_id <> b.item_id OR a.cnt <> b.cnt)
SELECT true AS op, epoch, window_end, rank, item_id, cnt FROM steps
UNION ALL SELECT false, epoch, window_end, rank, old_item, old_cnt FROM steps WHERE old_item IS NOT NULL"""


def _report(ranked: str, id_col: str, labels: tuple[str, str]) -> str:
    return f"""WITH r AS ({ranked})
SELECT window_end, '============================' || chr(10) || '窗口结束时间：' || {_ts_string('window_end')} || chr(10)
  || string_agg('NO ' || CAST(rank AS VARCHAR) || ':' || '{labels[0]}' || CAST({id_col} AS VARCHAR) || '{labels[1]}'
                || CAST(cnt AS VARCHAR) || chr(10), '' ORDER BY rank)
  || '===============================' || chr(10) AS report
FROM r GROUP BY window_end"""


LOG = f"""WITH ev AS (SELECT event_id, user_id, event_type, ts, {K} AS page_id FROM events),
pg AS (SELECT page_id, url FROM pages),
lg AS (
  SELECT ev.event_id AS seq, {_ip('ev.user_id')} AS ip, '-' AS user_id,
    ({T_S.replace('ts', 'ev.ts')} - CASE WHEN ev.event_id % 50 = 7 THEN 900 WHEN ev.event_id % 10 = 3 THEN 90 ELSE 0 END) * 1000
      AS t,
    CASE WHEN ev.event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
    coalesce(pg.url, '/page/' || CAST(ev.page_id AS VARCHAR))
      || coalesce(['.css', '.js', '.png', '.ico', '.css?x=1'][ev.page_id % 10 + 1], '') AS url
  FROM ev LEFT JOIN pg ON ev.page_id = pg.page_id),
wm AS (SELECT *, max(t) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000 AS wm FROM lg),
req AS (SELECT * FROM wm WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$'))"""

PAGE_COUNTS = f"""{LOG},
w AS (SELECT url, (t // 5000 + 1 + j) * 5000 AS window_end, wm FROM req, range(120) r(j)),
c AS (SELECT url, window_end, count(*) AS cnt FROM w WHERE wm IS NULL OR window_end - 1 + 60000 > wm
      GROUP BY url, window_end)"""

# Every (request, window) pair: before the window's first firing, a firing of its own, or too late.
PAGE_FIRINGS = f"""{LOG},
w AS (SELECT url, seq, (t // 5000 + 1 + j) * 5000 AS window_end, wm FROM req, range(120) r(j)),
kept AS (SELECT url, seq, window_end, wm IS NULL OR window_end - 1 > wm AS on_time FROM w
         WHERE wm IS NULL OR window_end - 1 + 60000 > wm),
numbered AS (
  SELECT url, window_end, on_time, row_number() OVER (PARTITION BY url, window_end ORDER BY NOT on_time, seq) AS cnt,
         count(*) FILTER (WHERE on_time) OVER (PARTITION BY url, window_end) AS n_first FROM kept)
SELECT url, window_end, CASE WHEN on_time THEN 1 ELSE cnt - n_first + CASE WHEN n_first > 0 THEN 1 ELSE 0 END END AS firing, cnt
FROM numbered WHERE NOT on_time OR cnt = n_first"""

HOT_PAGES_RANKED = f"""{PAGE_COUNTS}
SELECT window_end, rank, url, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM c)
WHERE rank <= 3"""

LATE_PAGES = f"""{LOG}
SELECT ip, user_id, t AS timestamp, method, url FROM req
WHERE wm IS NOT NULL AND (t // 5000) * 5000 + 600000 - 1 + 60000 <= wm"""

PAGE_VIEW = f"""WITH pv AS ({PV})
SELECT 'pv' AS url, (t * 1000 // 3600000 + 1) * 3600000 AS window_end, count(*) AS cnt FROM pv GROUP BY 2"""

UNIQUE_VISITOR = f"""WITH pv AS ({PV})
SELECT 'uv' AS url, (t * 1000 // 3600000 + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS cnt
FROM pv GROUP BY 2"""

UV_BITMAP = f"""WITH pv AS ({PV})
SELECT 'uv' AS url, (t * 1000 // 3600000 + 1) * 3600000 AS window_end, count(DISTINCT {_offset()}) AS cnt
FROM pv GROUP BY 2"""

UV_RUNNING = f"""WITH pv AS ({PV}),
o AS (SELECT (t * 1000 // 3600000 + 1) * 3600000 AS window_end, {_offset()} AS off, seq, user_id FROM pv),
f AS (SELECT window_end, off, arg_min(user_id, seq) AS user_id, min(seq) AS first_seq FROM o GROUP BY 1, 2)
SELECT 'uv' AS url, window_end, row_number() OVER (PARTITION BY window_end ORDER BY first_seq) AS cnt, user_id
FROM f"""

MARKETING = f"""SELECT user_id,
  CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD' WHEN 'purchase' THEN 'INSTALL'
                  WHEN 'signup' THEN 'INSTALL' WHEN 'error' THEN 'UNINSTALL' END AS behavior,
  ['app store', 'wechat', 'weibo'][{K} % 3 + 1] AS channel, {T_MS} AS t
FROM events"""

CHANNEL_COUNTS = f"""WITH m AS ({MARKETING}), f AS (SELECT * FROM m WHERE behavior IS DISTINCT FROM 'UNINSTALL'),
w AS (SELECT channel, behavior, (t // 5000 + 1 + j) * 5000 AS e FROM f, range(720) r(j))
SELECT channel, behavior, {_ts_string('e')} AS window_end, count(*) AS cnt FROM w GROUP BY channel, behavior, e"""

CHANNEL_TOTAL = f"""WITH m AS ({MARKETING}), f AS (SELECT * FROM m WHERE behavior IS DISTINCT FROM 'UNINSTALL'),
w AS (SELECT (t // 5000 + 1 + j) * 5000 AS e FROM f, range(720) r(j))
SELECT 'total' AS channel, 'total' AS behavior, {_ts_string('e')} AS window_end, count(*) AS cnt FROM w GROUP BY e"""

CLICKS = f"""WITH c AS (
  SELECT e.user_id, {K} % 5 AS ad_id, n.n_name AS province, n.n_name || '-' || CAST(e.user_id % 3 AS VARCHAR) AS city,
         {T_S.replace('ts', 'e.ts')} AS timestamp, e.event_id AS seq
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id ORDER BY seq) AS pos FROM c)"""

AD_PASSED = f"""{CLICKS}
SELECT user_id, ad_id, province, city, timestamp FROM r WHERE pos <= 12"""

AD_BLACKLIST = f"""{CLICKS}
SELECT user_id, ad_id, 'click over 12times.' AS warning_msg FROM r WHERE pos = 13"""

AD_PROVINCE = f"""{CLICKS},
w AS (SELECT province, (timestamp // 300 + 1 + j) * 300000 AS e FROM r, range(12) q(j) WHERE pos <= 12)
SELECT province, {_ts_string('e')} AS window_end, count(*) AS cnt FROM w GROUP BY province, e"""

LOGINS = f"""SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS st, {T_S} AS t,
  event_id AS seq FROM events"""

LOGIN_FAIL = f"""WITH l AS ({LOGINS}),
p AS (SELECT *, lag(st) OVER w AS pst, lag(t) OVER w AS pt FROM l WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, pt AS first_fail_time, t AS last_fail_time, 'login fail 2 times in 3600s' AS warning_msg
FROM p WHERE st = 'fail' AND pst = 'fail' AND t - pt <= 3600"""

LOGIN_FAIL_STREAK = f"""WITH l AS ({LOGINS}),
p AS (SELECT *, lead(st, 1) OVER w AS s1, lead(st, 2) OVER w AS s2, lead(t, 2) OVER w AS t2
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY t, seq))
SELECT user_id, t AS first_fail_time, t2 AS last_fail_time, 'login fail 3 times' AS warning_msg
FROM p WHERE st = 'fail' AND s1 = 'fail' AND s2 = 'fail' AND t2 - t < 86400"""

LOGIN_FAIL_TIMED = f"""WITH RECURSIVE l AS ({LOGINS}),
o AS (SELECT *, lag(st) OVER w AS pst, lag(t) OVER w AS pt FROM l WINDOW w AS (PARTITION BY user_id ORDER BY t, seq)),
r AS (SELECT *, sum(CASE WHEN st = 'fail' AND (pst IS NULL OR pst <> 'fail' OR t - pt >= 7200) THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM o),
f AS (SELECT user_id, run, t, row_number() OVER (PARTITION BY user_id, run ORDER BY t, seq) - 1 AS i
      FROM r WHERE run > 0 AND st = 'fail'),
ends AS (SELECT user_id, run, min(t) AS succ FROM r WHERE run > 0 AND st <> 'fail' GROUP BY user_id, run),
n AS (SELECT user_id, run, count(*) AS n FROM f GROUP BY user_id, run),
nx AS (SELECT a.user_id, a.run, a.i, coalesce(min(b.i), any_value(n.n)) AS p
       FROM f a JOIN n ON n.user_id = a.user_id AND n.run = a.run
       LEFT JOIN f b ON b.user_id = a.user_id AND b.run = a.run AND b.t >= a.t + 7200
       GROUP BY a.user_id, a.run, a.i),
path AS (SELECT user_id, run, 0 AS i FROM n
         UNION ALL
         SELECT nx.user_id, nx.run, nx.p FROM path
         JOIN nx ON nx.user_id = path.user_id AND nx.run = path.run AND nx.i = path.i
         JOIN n ON n.user_id = nx.user_id AND n.run = nx.run
         WHERE nx.p < n.n),
g AS (SELECT path.user_id, path.run, path.i AS s, nx.p AS e, n.n FROM path
      JOIN nx ON nx.user_id = path.user_id AND nx.run = path.run AND nx.i = path.i
      JOIN n ON n.user_id = path.user_id AND n.run = path.run)
SELECT g.user_id, a.t AS first_fail_time, b.t AS last_fail_time,
       'login fail in 7200s for ' || CAST(g.e - g.s AS VARCHAR) || ' times' AS warning_msg
FROM g JOIN f a ON a.user_id = g.user_id AND a.run = g.run AND a.i = g.s
JOIN f b ON b.user_id = g.user_id AND b.run = g.run AND b.i = g.e - 1
LEFT JOIN ends ON ends.user_id = g.user_id AND ends.run = g.run
WHERE g.e - g.s >= 2 AND NOT (g.e = g.n AND ends.succ IS NOT NULL AND ends.succ < a.t + 7200)"""

ORDER_ROWS = """WITH o AS (SELECT o_orderkey AS k, epoch_us(o_orderdate) // 1000000 AS tc FROM orders),
cr AS (SELECT k AS order_id, tc AS t FROM o WHERE k % 13 <> 0),
py AS (SELECT k AS order_id, 'tx' || CAST(k AS VARCHAR) AS tx_id, tc + (k * 7919) % 1800 AS t FROM o WHERE k % 11 <> 0),
rc AS (SELECT CASE WHEN k % 19 = 0 THEN 'rx' ELSE 'tx' END || CAST(k AS VARCHAR) AS tx_id,
              CASE WHEN k % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
              tc + (k * 7919) % 1800 + k % 13 - 6 AS t
       FROM o WHERE k % 11 <> 0 AND k % 17 <> 0)"""

ORDER_PAY_TIMEOUT = f"""{ORDER_ROWS},
m AS (SELECT cr.order_id, cr.t, min(py.t) AS next_pay FROM cr LEFT JOIN py ON py.order_id = cr.order_id AND py.t >= cr.t
      GROUP BY cr.order_id, cr.t)
SELECT order_id, CASE WHEN next_pay IS NOT NULL AND next_pay - t < 300 THEN 'payed'
                      ELSE 'timeout ' || CAST((t + 300) * 1000 AS VARCHAR) END AS result_state FROM m"""

ORDER_TIMEOUT = f"""{ORDER_ROWS},
a AS (SELECT coalesce(cr.order_id, py.order_id) AS order_id, cr.t AS c, py.t AS p
      FROM cr FULL OUTER JOIN py ON cr.order_id = py.order_id)
SELECT order_id, CASE WHEN c IS NOT NULL AND p IS NOT NULL AND p < c + 900 THEN 'payed successfully'
                      WHEN c IS NOT NULL AND p IS NOT NULL THEN 'payed but already timeout'
                      WHEN c IS NOT NULL THEN 'timeout'
                      ELSE 'payed but not found created log' END AS result_state FROM a"""


def _tx_match(interval: bool) -> str:
    ok = "py.order_id IS NOT NULL AND rc.t IS NOT NULL"
    if interval:
        ok += " AND rc.t BETWEEN py.t - 3 AND py.t + 5"
    return f"""{ORDER_ROWS},
j AS (SELECT py.order_id, coalesce(py.tx_id, rc.tx_id) AS tx_id, py.t AS pt, rc.pay_channel, rc.t AS rt,
             ({ok}) AS ok
      FROM py FULL OUTER JOIN rc ON py.tx_id = rc.tx_id)
SELECT 'matched-pays' AS tag, order_id, tx_id, pt AS pay_time, pay_channel, rt AS receipt_time FROM j WHERE ok
UNION ALL
SELECT 'unmatched-pays', order_id, tx_id, pt, NULL, NULL FROM j WHERE NOT ok AND order_id IS NOT NULL
UNION ALL
SELECT 'unmatched-receipts', NULL, tx_id, NULL, pay_channel, rt FROM j WHERE NOT ok AND rt IS NOT NULL"""


TX_JOIN = f"""{ORDER_ROWS}
SELECT py.order_id, py.tx_id, py.t AS pay_time, rc.pay_channel, rc.t AS receipt_time
FROM py JOIN rc ON py.tx_id = rc.tx_id AND rc.t BETWEEN py.t - 3 AND py.t + 5"""


# Each tx id is walked through by the clock: the state is how many pays and receipts are done with; the next
# pay and the next receipt pair up, or the one that cannot wait for the other goes.
TX_MATCH_REPEATED = """WITH RECURSIVE o AS (SELECT o_orderkey AS k, epoch_us(o_orderdate) // 1000000 AS tc FROM orders),
py AS (SELECT k AS order_id, 'tx' || CAST(k AS VARCHAR) AS tx_id, tc + (k * 7919) % 1800 + d AS t
       FROM o, (VALUES (0), (4), (100)) v(d)
       WHERE k % 11 <> 0 AND (d = 0 OR (d = 4 AND k % 5 = 0) OR (d = 100 AND k % 10 = 0))),
r0 AS (SELECT CASE WHEN k % 19 = 0 THEN 'rx' ELSE 'tx' END || CAST(k AS VARCHAR) AS tx_id,
              CASE WHEN k % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
              tc + (k * 7919) % 1800 + k % 13 - 6 AS t0 FROM o WHERE k % 11 <> 0 AND k % 17 <> 0),
rc AS (SELECT tx_id, pay_channel, t0 + d AS t FROM r0, (VALUES (0), (2), (101)) v(d)
       WHERE d = 0 OR (d = 2 AND t0 % 3 = 0) OR (d = 101 AND t0 % 7 = 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY t, order_id) AS i FROM py),
r AS (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY t, pay_channel) AS j FROM rc),
walk AS (
  SELECT tx_id, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS j, '' AS did
  FROM (SELECT tx_id FROM py UNION SELECT tx_id FROM rc)
  UNION ALL
  SELECT tx_id, i + CASE WHEN did <> 'receipt' THEN 1 ELSE 0 END, j + CASE WHEN did <> 'pay' THEN 1 ELSE 0 END, did
  FROM (SELECT w.tx_id, w.i, w.j,
               CASE WHEN r.t IS NULL OR r.t > p.t + 5 THEN 'pay' WHEN p.t IS NULL OR p.t > r.t + 3 THEN 'receipt'
                    ELSE 'both' END AS did
        FROM walk w LEFT JOIN p ON p.tx_id = w.tx_id AND p.i = w.i LEFT JOIN r ON r.tx_id = w.tx_id AND r.j = w.j
        WHERE p.t IS NOT NULL OR r.t IS NOT NULL)),
done AS (SELECT tx_id, did, CASE WHEN did <> 'receipt' THEN i - 1 END AS i, CASE WHEN did <> 'pay' THEN j - 1 END AS j
         FROM walk WHERE did <> '')
SELECT CASE did WHEN 'both' THEN 'matched-pays' WHEN 'pay' THEN 'unmatched-pays' ELSE 'unmatched-receipts' END AS tag,
       p.order_id, d.tx_id, p.t AS pay_time, r.pay_channel, r.t AS receipt_time
FROM done d LEFT JOIN p ON p.tx_id = d.tx_id AND p.i = d.i LEFT JOIN r ON r.tx_id = d.tx_id AND r.j = d.j"""

ORDER_TIMEOUT_EARLY = ORDER_TIMEOUT.replace(
    "tc + (k * 7919) % 1800 AS t FROM o WHERE k % 11 <> 0)",
    "tc + (k * 7919) % 1800 - CASE WHEN k % 4 = 0 THEN 2000 ELSE 0 END AS t FROM o WHERE k % 11 <> 0)")

CHANNEL_COUNTS_NULL = f"""WITH m AS (
  SELECT CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD' WHEN 'purchase' THEN 'INSTALL' END AS behavior,
         CASE WHEN user_id % 7 <> 0 THEN ['app store', 'wechat', 'weibo'][{K} % 3 + 1] END AS channel, {T_MS} AS t
  FROM events WHERE event_type IS DISTINCT FROM 'error'),
w AS (SELECT channel, behavior, (t // 5000 + 1 + j) * 5000 AS e FROM m, range(720) r(j))
SELECT channel, behavior, {_ts_string('e')} AS window_end, count(*) AS cnt FROM w GROUP BY channel, behavior, e"""

CLICKS_DAILY = CLICKS.replace("PARTITION BY user_id, ad_id ORDER", "PARTITION BY user_id, ad_id, timestamp // 86400 ORDER")

AD_BLACKLIST_DAILY = f"""{CLICKS_DAILY}
SELECT user_id, ad_id, 'click over 2times.' AS warning_msg FROM r WHERE pos = 3"""

AD_PASSED_DAILY = f"""{CLICKS_DAILY}
SELECT user_id, ad_id, province, city, timestamp FROM r WHERE pos <= 2"""

UV_BITMAP_SMALL = f"""WITH pv AS ({PV})
SELECT 'uv' AS url, (t * 1000 // 3600000 + 1) * 3600000 AS window_end, count(DISTINCT {_offset()} % 32) AS cnt
FROM pv GROUP BY 2"""

UV_APPROX_CHECKED = f"""WITH u AS ({UNIQUE_VISITOR}) SELECT *, true AS within FROM u"""

RECORDS_BEHAVIOR = f"""SELECT user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
  CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav'
                  WHEN 'error' THEN 'other' END AS behavior, {T_S} AS timestamp FROM events"""

RECORDS_AD_CLICK = f"""{CLICKS} SELECT user_id, ad_id, province, city, timestamp FROM r"""

RECORDS_LOGIN = f"""SELECT user_id, {_ip()} AS ip,
  CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS login_state, {T_S} AS timestamp FROM events"""

RECORDS_ORDER = f"""{ORDER_ROWS}
SELECT order_id, 'create' AS event_type, '' AS tx_id, t AS timestamp FROM cr
UNION ALL SELECT order_id, 'pay', tx_id, t FROM py"""

RECORDS_RECEIPT = f"""{ORDER_ROWS} SELECT tx_id, pay_channel, t AS timestamp FROM rc"""

ACCESS_LOG_LENIENT = f"""{LOG.split('wm AS (')[0].rstrip().rstrip(',')}
SELECT method, url, count(*) AS kept, CAST(0 AS BIGINT) AS rejected FROM lg
WHERE seq % 9 <> 0 AND seq % 11 <> 0 GROUP BY method, url
UNION ALL SELECT NULL, NULL, 0, count(*) FROM lg WHERE seq % 9 = 0 OR seq % 11 = 0"""

PUBLISHED_RECEIPTS = f"""{ORDER_ROWS}
SELECT tx_id, CASE WHEN t % 5 <> 0 THEN pay_channel END AS pay_channel, CASE WHEN t % 7 <> 0 THEN t END AS timestamp FROM rc"""

# The rows of an id one after the other: what waits (c a create, p a pay, nothing) and since when.
ORDER_CYCLES = """WITH RECURSIVE o AS (
  SELECT o_orderkey AS k, epoch_us(o_orderdate) // 1000000 + 3000 * j AS b, j FROM orders, range(4) r(j)),
rows AS (
  SELECT k - k % 2 AS order_id, 'c' AS e, b AS t, k * 4 + j AS seq FROM o WHERE (k + j) % 7 <> 0
  UNION ALL SELECT k - k % 2, 'c', b + 500, k * 4 + j FROM o WHERE (k + j) % 9 = 0
  UNION ALL SELECT k - k % 2, 'p', b + (k * 7919 + j * 1009) % 5000, k * 4 + j FROM o WHERE (k + j) % 5 <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY t, e, seq) AS i FROM rows
      UNION ALL SELECT order_id, 'end', 1000000000000, NULL, count(*) + 1 FROM rows GROUP BY order_id),
walk AS (
  SELECT order_id, CAST(1 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS w, CAST(NULL AS BIGINT) AS since, CAST(NULL AS VARCHAR) AS result,
         CAST(NULL AS BIGINT) AS opened FROM (SELECT DISTINCT order_id FROM rows)
  UNION ALL
  SELECT order_id, i + 1, CASE WHEN e = 'end' OR meets THEN NULL ELSE e END, CASE WHEN meets THEN NULL ELSE t END,
         CASE WHEN w = 'c' AND meets THEN CASE WHEN t < since + 900 THEN 'payed successfully' ELSE 'payed but already timeout' END
              WHEN w = 'c' AND NOT (e = 'c' AND t < since + 900) THEN 'timeout'
              WHEN w = 'p' THEN CASE WHEN meets THEN 'payed successfully' ELSE 'payed but not found created log' END END, since
  FROM (SELECT walk.order_id, walk.i, walk.w, walk.since, n.e, n.t,
               coalesce((w = 'c' AND e = 'p' AND t < since + 900 + 3600) OR (w = 'p' AND e = 'c' AND t <= since + 1800), false) AS meets
        FROM walk JOIN n ON n.order_id = walk.order_id AND n.i = walk.i))
SELECT order_id, opened AS cycle_time, result AS result_state FROM walk WHERE result IS NOT NULL"""

# The clicks of a key one after the other: when the period began and how many it has.
AD_BLACKLIST_ROLLING = f"""WITH RECURSIVE clicks AS ({CLICKS.replace('r AS (', 'r0 AS (')}
SELECT user_id, ad_id, timestamp AS t, row_number() OVER (PARTITION BY user_id, ad_id ORDER BY timestamp, seq) AS i FROM r0),
walk AS (
  SELECT user_id, ad_id, i, t AS began, 1 AS n FROM clicks WHERE i = 1
  UNION ALL
  SELECT c.user_id, c.ad_id, c.i, CASE WHEN c.t >= began + 604800 THEN c.t ELSE began END,
         CASE WHEN c.t >= began + 604800 THEN 1 ELSE n + 1 END
  FROM walk w JOIN clicks c ON c.user_id = w.user_id AND c.ad_id = w.ad_id AND c.i = w.i + 1)
SELECT user_id, ad_id, 'click over 2times.' AS warning_msg FROM walk WHERE n = 3"""

UV_SKETCH_SLIDING = f"""WITH pv AS ({PV})
SELECT 'hour' AS period, (t // 300 + 1 + j) * 300000 AS window_end, count(DISTINCT user_id) AS cnt, true AS within
FROM pv, range(12) r(j) GROUP BY 2
UNION ALL
SELECT 'day', (t // 86400 + 1) * 86400000, count(DISTINCT user_id), true FROM pv GROUP BY 2"""


TOPIC_ORDER = f"""WITH m AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 0 ELSE CAST(1 + event_id % 5 AS INTEGER) END AS p, event_id AS o,
    {T_MS} - event_id * 7919 % 86400 * 1000 AS t FROM events),
r AS (SELECT p, o, max(t) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING) AS progress FROM m)
SELECT CAST(p AS INTEGER) AS "partition", o AS "offset", row_number() OVER (ORDER BY progress, p, o) - 1 AS seq FROM r"""

ORACLES: dict[str, str] = {
    "hot_items": HOT_ITEMS,
    "item_counts": ITEM_COUNTS,
    "hot_items_changelog": HOT_ITEMS_CHANGELOG,
    "page_firings": PAGE_FIRINGS,
    "hot_items_report": _report(HOT_ITEMS, "item_id", (" 商品ID = ", " 热门度 = ")),
    "hot_items_sql": HOT_ITEMS_SQL,
    "hot_items_pure_sql": HOT_ITEMS_SQL,
    "page_counts": f"{PAGE_COUNTS}\nSELECT url, window_end, cnt FROM c",
    "hot_pages": HOT_PAGES_RANKED,
    "hot_pages_report": _report(HOT_PAGES_RANKED, "url", (" 页面URL = ", " 浏览量 = ")),
    "late_pages": LATE_PAGES,
    "page_view": PAGE_VIEW,
    "page_view_salted": PAGE_VIEW,
    "unique_visitor": UNIQUE_VISITOR,
    "uv_bitmap": UV_BITMAP,
    "uv_running": UV_RUNNING,
    "channel_counts": CHANNEL_COUNTS,
    "channel_total": CHANNEL_TOTAL,
    "ad_passed": AD_PASSED,
    "ad_blacklist": AD_BLACKLIST,
    "ad_province": AD_PROVINCE,
    "login_fail": LOGIN_FAIL,
    "login_fail_streak": LOGIN_FAIL_STREAK,
    "login_fail_timed": LOGIN_FAIL_TIMED,
    "order_pay_timeout": ORDER_PAY_TIMEOUT,
    "order_timeout": ORDER_TIMEOUT,
    "order_cycles": ORDER_CYCLES,
    "published_receipts": PUBLISHED_RECEIPTS,
    "topic_order": TOPIC_ORDER,
    "tx_match": _tx_match(True),
    "tx_match_key": _tx_match(False),
    "tx_join": TX_JOIN,
    "tx_match_repeated": TX_MATCH_REPEATED,
    "order_timeout_early": ORDER_TIMEOUT_EARLY,
    "channel_counts_null": CHANNEL_COUNTS_NULL,
    "ad_blacklist_daily": AD_BLACKLIST_DAILY,
    "ad_passed_daily": AD_PASSED_DAILY,
    "ad_blacklist_rolling": AD_BLACKLIST_ROLLING,
    "uv_sketch_sliding": UV_SKETCH_SLIDING,
    "uv_bitmap_small": UV_BITMAP_SMALL,
    "uv_approx_checked": UV_APPROX_CHECKED,
    "records_behavior": RECORDS_BEHAVIOR,
    "records_ad_click": RECORDS_AD_CLICK,
    "records_login": RECORDS_LOGIN,
    "records_order": RECORDS_ORDER,
    "records_receipt": RECORDS_RECEIPT,
    "access_log_lenient": ACCESS_LOG_LENIENT,
}
