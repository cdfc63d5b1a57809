"""The analyses as plans over the driver tables: each takes (spark, sf_dir) and returns a DataFrame.

Parameters default to the analyses' own values; where the driver data is too sparse for them (a user acts
about every 11 hours), ``DRIVER`` holds the scaled values the registered queries use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import report
from tidemark.functions.time import end_string
from tidemark.operators import blocking, changelog, distinct, joins, lateness, patterns, topn, windows
from tidemark.operators.arrival import arrival_order
from tidemark.sources import adapters, lines, records
from tidemark.session import materialize
from tidemark.sources.access_log import parse_access_log, rejected_lines

# Values used on the driver tables (sparse event data).
DRIVER = {
    "login_pair_limit_s": 3600,      # pairwise fails within 1 h (2 s in the analysis)
    "login_streak_within_s": 86400,  # 3 consecutive fails within 1 day (5 s)
    "login_timed_limit_s": 7200,     # timer-closed fail groups of 2 h (2 s)
    "click_limit": 12,               # clicks per (user, ad) before blocking (100)
    "order_late_s": 3600,            # how long a pay may come after the order's time is up
    "order_early_s": 1800,           # how long a pay waits for its create
}

# Static-asset pattern of the page ranking (a url ending in one of these is skipped).
STATIC_ASSET = r"\.(css|js|png|ico)$"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapters.table(spark, sf_dir, name)


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.user_behavior(_t(spark, sf_dir, "events"))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.user_behavior(_t(spark, sf_dir, "events"), behaviors=["pv"])


# ---- hot items ------------------------------------------------------------------------------------------

def item_counts(spark: SparkSession, sf_dir: str, size: str = "1 hour", slide: str = "5 minutes",
                method: str = "auto") -> DataFrame:
    """(item_id, window_end, cnt): views per item and sliding window."""
    return windows.window_count(page_views(spark, sf_dir), ["item_id"], size, slide, method=method,
                                count_col="cnt")


def hot_items(spark: SparkSession, sf_dir: str, n: int = 5, method: str = "auto") -> DataFrame:
    """(window_end, rank, item_id, cnt): top-n viewed items per 1 h window sliding by 5 min."""
    ranked = topn.top_n(item_counts(spark, sf_dir, method=method), n, id_col="item_id")
    return ranked.select("window_end", "rank", "item_id", "cnt")


def hot_items_report(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """(window_end, report): the text ranking per window."""
    return report.topn_report(hot_items(spark, sf_dir, n), "item_id", report.ITEM_LABELS)


def hot_items_sql(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """(item_id, window_end, cnt, row_num): windowed count as DataFrame expressions, ranking as SQL."""
    agg = (page_views(spark, sf_dir)
           .groupBy("item_id", F.window("ts", "1 hour", "5 minutes").alias("w"))
           .agg(F.count("item_id").alias("cnt"))
           .select("item_id", F.unix_millis(F.col("w.end")).alias("window_end"), "cnt"))
    return spark.sql(
        "SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id)"
        " AS BIGINT) AS row_num FROM {agg}) WHERE row_num <= {n}", agg=agg, n=n)


def hot_items_pure_sql(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """(item_id, cnt, window_end, row_num): hop aggregate and top-n in one SQL statement."""
    data = behaviors(spark, sf_dir).select("item_id", "behavior", "ts")
    return spark.sql(
        "SELECT * FROM ("
        "  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT)"
        "    AS row_num"
        "  FROM ("
        "    SELECT item_id, count(item_id) AS cnt, unix_millis(window.end) AS window_end"
        "    FROM {data} WHERE behavior = 'pv'"
        "    GROUP BY item_id, window(ts, '1 hour', '5 minutes')))"
        " WHERE row_num <= {n}", data=data, n=n)


def hot_items_changelog(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """(op, epoch, window_end, rank, item_id, cnt): how the ranking of each 1 h window changes from one 5 min epoch to
    the next, as a retract stream; all of it folds to ``hot_items``."""
    ranks = changelog.running_ranks(page_views(spark, sf_dir), "item_id", n, "1 hour", "5 minutes")
    return changelog.ranking_changes(ranks, "item_id")


# ---- pages, page views, unique visitors -----------------------------------------------------------------

def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(adapters.access_log_lines(_t(spark, sf_dir, "events"), _t(spark, sf_dir, "pages")))


def page_request() -> Column:
    """What is counted of the log; the watermark follows every line."""
    return (F.col("method") == "GET") & ~F.col("url").rlike(STATIC_ASSET)


def _page_split(spark, sf_dir, size, slide, bound, allowed_lateness):
    return lateness.split_late(access_log(spark, sf_dir), "timestamp", size, slide, bound, allowed_lateness, wanted=page_request())


def page_counts(spark: SparkSession, sf_dir: str, size: str = "10 minutes", slide: str = "5 seconds",
                bound: str = "1 second", allowed_lateness: str = "1 minute") -> DataFrame:
    """(url, window_end, cnt): GET requests per page and window, minus what lateness drops."""
    on_time, _ = _page_split(spark, sf_dir, size, slide, bound, allowed_lateness)
    # the pane window reads its input several times; it is written once
    on_time = materialize(on_time.select("url", "first_end", F.timestamp_millis("timestamp").alias("ts")), "page-requests")
    return windows.window_count(on_time, ["url"], size, slide, count_col="cnt", first_end="first_end")


def hot_pages(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """(window_end, rank, url, cnt): top-n pages per 10 min window sliding by 5 s."""
    return topn.top_n(page_counts(spark, sf_dir), n, id_col="url").select("window_end", "rank", "url", "cnt")


def hot_pages_report(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    return report.topn_report(hot_pages(spark, sf_dir, n), "url", report.PAGE_LABELS)


def late_pages(spark: SparkSession, sf_dir: str, size: str = "10 minutes", slide: str = "5 seconds",
               bound: str = "1 second", allowed_lateness: str = "1 minute") -> DataFrame:
    """(ip, user_id, timestamp, method, url): requests too late for every window (the late side output)."""
    _, late = _page_split(spark, sf_dir, size, slide, bound, allowed_lateness)
    return late.select("ip", "user_id", "timestamp", "method", "url")


def page_firings(spark: SparkSession, sf_dir: str, size: str = "10 minutes", slide: str = "5 seconds",
                 bound: str = "1 second", allowed_lateness: str = "1 minute") -> DataFrame:
    """(url, window_end, firing, cnt): every firing of a page's window, the first when the watermark passes its end and
    one per late row after that; the last firing of a window has the count of ``page_counts``."""
    return changelog.window_firings(access_log(spark, sf_dir), ["url"], "timestamp", size, slide, bound, allowed_lateness,
                                    wanted=page_request())


def page_view(spark: SparkSession, sf_dir: str, size: str = "1 hour", salt: int = 0) -> DataFrame:
    """(url='pv', window_end, cnt): page views per tumbling window.

    ``salt > 0`` counts per (random salt, window) first and then sums per window, the explicit two-phase
    form; the default relies on Spark's partial aggregation, which combines map-side already.
    """
    pv = page_views(spark, sf_dir)
    if salt:
        pv = pv.withColumn("_salt", (F.rand(7) * salt).cast("int"))
        parts = windows.window_count(pv, ["_salt"], size, count_col="cnt")
        counted = parts.groupBy("window_end").agg(F.sum("cnt").alias("cnt"))
    else:
        counted = windows.window_count(pv, [], size, count_col="cnt")
    return counted.select(F.lit("pv").alias("url"), "window_end", "cnt")


def page_view_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views per hour counted per (random salt 0-9, window) first, then summed per window."""
    return page_view(spark, sf_dir, salt=10)


def unique_visitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.uv_exact(page_views(spark, sf_dir))


def uv_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.uv_bitmap(page_views(spark, sf_dir))


def uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.uv_running(page_views(spark, sf_dir))


def uv_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.uv_approx(page_views(spark, sf_dir))


# ---- marketing and ads ----------------------------------------------------------------------------------

def _marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # NULL-safe inequality: a NULL behaviour passes, as a null-tolerant "not equal" test does.
    return adapters.marketing_events(_t(spark, sf_dir, "events"), exclude=["UNINSTALL"])


def channel_counts(spark: SparkSession, sf_dir: str, size: str = "1 hour", slide: str = "5 seconds",
                   method: str = "auto") -> DataFrame:
    """(channel, behavior, window_end text, cnt) per 1 h window sliding by 5 s."""
    c = windows.window_count(_marketing(spark, sf_dir), ["channel", "behavior"], size, slide,
                             method=method, count_col="cnt")
    return c.select("channel", "behavior", end_string("window_end").alias("window_end"), "cnt")


def channel_total(spark: SparkSession, sf_dir: str, size: str = "1 hour", slide: str = "5 seconds",
                  method: str = "auto") -> DataFrame:
    """('total', 'total', window_end text, cnt) per 1 h window sliding by 5 s."""
    c = windows.window_count(_marketing(spark, sf_dir), [], size, slide, method=method, count_col="cnt")
    return c.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"),
                    end_string("window_end").alias("window_end"), "cnt")


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.ad_clicks(_t(spark, sf_dir, "events"), _t(spark, sf_dir, "nation"))


def ad_passed(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    """The ad clicks that pass the per-(user, ad) blocker."""
    return blocking.block_clicks(_clicks(spark, sf_dir), limit or DRIVER["click_limit"]).select(
        "user_id", "ad_id", "province", "city", "timestamp")


def ad_blacklist(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    """(user_id, ad_id, warning_msg): one warning per key over the limit."""
    return blocking.blacklist_warnings(_clicks(spark, sf_dir), limit or DRIVER["click_limit"])


def ad_province(spark: SparkSession, sf_dir: str, limit: int | None = None, size: str = "1 hour",
                slide: str = "5 minutes") -> DataFrame:
    """(province, window_end text, cnt): passing clicks per province and window."""
    passed = blocking.block_clicks(_clicks(spark, sf_dir), limit or DRIVER["click_limit"])
    c = windows.window_count(passed, ["province"], size, slide, count_col="cnt")
    return c.select("province", end_string("window_end").alias("window_end"), "cnt")


# ---- login failures -------------------------------------------------------------------------------------

def _logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.login_events(_t(spark, sf_dir, "events"))


def login_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.login_fail_pairs(_logins(spark, sf_dir), DRIVER["login_pair_limit_s"])


def login_fail_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.login_fail_streak(_logins(spark, sf_dir), 3, DRIVER["login_streak_within_s"])


def login_fail_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.login_fail_timed(_logins(spark, sf_dir), DRIVER["login_timed_limit_s"], 2)


# ---- orders and payments --------------------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.order_events(_t(spark, sf_dir, "orders"))


def _receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.receipt_events(_t(spark, sf_dir, "orders"))


def order_pay_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, result_state): create followed by pay within 5 min, else 'timeout <ms>'."""
    return patterns.order_pay_match(_orders(spark, sf_dir), 300)


def order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, result_state): the 15 min create/pay state machine."""
    return patterns.order_state(_orders(spark, sf_dir), 900)


def tx_match(spark: SparkSession, sf_dir: str, mode: str = "interval") -> DataFrame:
    """(tag, order_id, tx_id, pay_time, pay_channel, receipt_time): reconciliation with both residuals."""
    return joins.reconcile(joins.pays_of(_orders(spark, sf_dir)), _receipts(spark, sf_dir), mode)


def tx_match_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_match(spark, sf_dir, "key")


def tx_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, tx_id, pay_time, pay_channel, receipt_time): receipts within [-3 s, +5 s] of the pay."""
    return joins.interval_join(joins.pays_of(_orders(spark, sf_dir)), _receipts(spark, sf_dir), -3, 5)


def tx_match_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation where tx ids repeat, with orphans between the pairs."""
    orders = _t(spark, sf_dir, "orders")
    return joins.reconcile(adapters.retried_pays(orders), adapters.repeated_receipts(orders), "interval")


def order_timeout_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, result_state) of orders many of which are paid before they are created."""
    return patterns.order_state(adapters.early_paid_orders(_t(spark, sf_dir, "orders")), 900)


def order_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, cycle_time, result_state): one result per cycle of order ids that are used again."""
    return patterns.order_cycles(adapters.reused_orders(_t(spark, sf_dir, "orders")), 900, DRIVER["order_late_s"],
                                 DRIVER["order_early_s"])


def published_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts, some without a channel or a time, published as lines and parsed again."""
    receipts = _receipts(spark, sf_dir).select(
        "tx_id", F.when(F.col("timestamp") % 5 != 0, F.col("pay_channel")).alias("pay_channel"),
        F.when(F.col("timestamp") % 7 != 0, F.col("timestamp")).alias("timestamp"))
    return records.parse_records(lines.lines_of(receipts), "receipt")


# ---- further forms of the analyses ----------------------------------------------------------------------

def channel_counts_null(spark: SparkSession, sf_dir: str, method: str = "auto") -> DataFrame:
    """``channel_counts`` with 'signup' events as a NULL behaviour and user_id % 7 = 0 on a NULL channel."""
    m = _marketing(spark, sf_dir).join(
        _t(spark, sf_dir, "events").filter("event_type = 'signup'").select(F.col("event_id").alias("seq")), "seq", "left_anti")
    nulls = adapters.marketing_events(_t(spark, sf_dir, "events").filter("event_type = 'signup'")).withColumn(
        "behavior", F.lit(None).cast("string"))
    m = m.select(*nulls.columns).unionByName(nulls).withColumn(
        "channel", F.when(F.col("user_id") % 7 != 0, F.col("channel")))
    c = windows.window_count(m, ["channel", "behavior"], "1 hour", "5 seconds", method=method, count_col="cnt")
    return c.select("channel", "behavior", end_string("window_end").alias("window_end"), "cnt")


def ad_blacklist_daily(spark: SparkSession, sf_dir: str, limit: int = 2) -> DataFrame:
    """(user_id, ad_id, warning_msg): one warning per key and calendar day over the limit."""
    return blocking.blacklist_warnings(_clicks(spark, sf_dir), limit, reset="calendar_day")


def ad_blacklist_rolling(spark: SparkSession, sf_dir: str, limit: int = 2, period_s: int = 7 * 86400) -> DataFrame:
    """(user_id, ad_id, warning_msg): one warning per key and period over the limit; a period is a week from the first
    click that it counts."""
    return blocking.blacklist_warnings(_clicks(spark, sf_dir), limit, reset="rolling", period_s=period_s)


def ad_passed_daily(spark: SparkSession, sf_dir: str, limit: int = 2) -> DataFrame:
    """The ad clicks that pass the blocker when its counts begin anew each calendar day."""
    return blocking.block_clicks(_clicks(spark, sf_dir), limit, reset="calendar_day").select(
        "user_id", "ad_id", "province", "city", "timestamp")


def uv_bitmap_small(spark: SparkSession, sf_dir: str, bits: int = 5) -> DataFrame:
    """Distinct offsets in a bitmap so small that user ids collide."""
    return distinct.uv_bitmap(page_views(spark, sf_dir), bits=bits)


def uv_approx_checked(spark: SparkSession, sf_dir: str, rsd: float = 0.01) -> DataFrame:
    """(url, window_end, cnt, within): the exact count and whether the estimate is within 5 rsd (and 1) of it."""
    exact = distinct.uv_exact(page_views(spark, sf_dir))
    approx = distinct.uv_approx(page_views(spark, sf_dir), rsd=rsd).select("window_end", F.col("cnt").alias("_a"))
    return exact.join(approx, "window_end").select(
        "url", "window_end", "cnt", (F.abs(F.col("_a") - F.col("cnt")) <= 5 * rsd * F.col("cnt") + 1).alias("within"))


def uv_sketch_sliding(spark: SparkSession, sf_dir: str, lg_k: int = 12) -> DataFrame:
    """(period, window_end, cnt, within): the exact count of visitors per hour sliding by 5 min and per day, and whether
    the estimate from 5 min sketches is within 5 standard errors (and 1) of it. Both come from one set of sketches."""
    views = page_views(spark, sf_dir)
    sketches = materialize(distinct.uv_sketches(views, lg_k=lg_k), "uv-sketches")
    out = None
    for period, size, slide in (("hour", "1 hour", "5 minutes"), ("day", "1 day", None)):
        est = distinct.uv_from_sketches(sketches, "5 minutes", size, slide).select("window_end", F.col("cnt").alias("_est"))
        exact = views.groupBy(F.window("ts", size, slide or size).alias("w")).agg(F.countDistinct("user_id").alias("cnt"))
        both = exact.select(F.unix_millis(F.col("w.end")).alias("window_end"), "cnt").join(est, "window_end", "full_outer")
        close = F.abs(F.col("_est") - F.col("cnt")) <= 5 * 1.04 / 2 ** (lg_k / 2) * F.col("cnt") + 1
        own = both.select(F.lit(period).alias("period"), "window_end", "cnt", close.alias("within"))
        out = own if out is None else out.unionByName(own)
    return out


def _round_trip(df: DataFrame, kind: str) -> DataFrame:
    """Records written as lines and parsed again."""
    return records.parse_records(records.render_records(df, kind), kind)


def records_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(behaviors(spark, sf_dir), "behavior")


def records_ad_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(_clicks(spark, sf_dir), "ad_click")


def records_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(_logins(spark, sf_dir), "login")


def records_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(_orders(spark, sf_dir), "order")


def records_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(_receipts(spark, sf_dir), "receipt")


def topic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partition, offset, seq): the arrival order of a topic's messages over all its partitions."""
    return arrival_order(adapters.topic_messages(_t(spark, sf_dir, "events"))).select("partition", "offset", "seq")


def access_log_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(method, url, kept, rejected): lines per request that the lenient reading keeps, and the number of lines
    that it rejects (method and url NULL)."""
    log = adapters.cut_lines(adapters.access_log_lines(_t(spark, sf_dir, "events"), _t(spark, sf_dir, "pages")))
    zero = F.lit(0).cast("long")
    kept = parse_access_log(log, strict=False).groupBy("method", "url").agg(F.count(F.lit(1)).alias("kept"))
    lost = rejected_lines(log).agg(F.count(F.lit(1)).alias("rejected"))
    none = F.lit(None).cast("string")
    return kept.withColumn("rejected", zero).unionByName(
        lost.select(none.alias("method"), none.alias("url"), zero.alias("kept"), "rejected"))
