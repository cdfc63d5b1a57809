"""The analyses over record files, with the analyses' own parameters as defaults.

Each job takes paths of comma-separated record files (or access-log text) and returns a DataFrame; the
command line (``python -m tidemark``) runs them and writes or shows the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import report
from tidemark.functions.time import end_string
from tidemark.operators import blocking, distinct, joins, lateness, patterns, topn, windows
from tidemark.plans.jobs import page_request
from tidemark.session import materialize
from tidemark.sources import read_access_log, read_records


def _with_ts(df: DataFrame, unit: str = "s") -> DataFrame:
    conv = F.timestamp_seconds if unit == "s" else F.timestamp_millis
    return df.withColumn("ts", conv("timestamp"))


def _pv(spark: SparkSession, behavior: str) -> DataFrame:
    return _with_ts(read_records(spark, behavior, "behavior")).filter(F.col("behavior") == "pv")


def hot_items(spark: SparkSession, behavior: str, n: int = 5, report_text: bool = False) -> DataFrame:
    counts = windows.window_count(_pv(spark, behavior), ["item_id"], "1 hour", "5 minutes", count_col="cnt")
    ranked = topn.top_n(counts, n, id_col="item_id").select("window_end", "rank", "item_id", "cnt")
    return report.topn_report(ranked, "item_id", report.ITEM_LABELS) if report_text else ranked


def hot_pages(spark: SparkSession, log: str, n: int = 3, report_text: bool = False) -> DataFrame:
    on_time, _ = lateness.split_late(read_access_log(spark, log), "timestamp", "10 minutes", "5 seconds", "1 second",
                                     "1 minute", wanted=page_request())
    on_time = materialize(_with_ts(on_time, "ms"), "page-requests")
    counts = windows.window_count(on_time, ["url"], "10 minutes", "5 seconds", count_col="cnt",
                                  first_end="first_end")
    ranked = topn.top_n(counts, n, id_col="url").select("window_end", "rank", "url", "cnt")
    return report.topn_report(ranked, "url", report.PAGE_LABELS) if report_text else ranked


def page_view(spark: SparkSession, behavior: str) -> DataFrame:
    c = windows.window_count(_pv(spark, behavior), [], "1 hour", count_col="cnt")
    return c.select(F.lit("pv").alias("url"), "window_end", "cnt")


def unique_visitor(spark: SparkSession, behavior: str, method: str = "exact") -> DataFrame:
    fn = {"exact": distinct.uv_exact, "bitmap": distinct.uv_bitmap, "running": distinct.uv_running,
          "approx": distinct.uv_approx}[method]
    return fn(_pv(spark, behavior))


def marketing_by_channel(spark: SparkSession, marketing: str, total: bool = False) -> DataFrame:
    m = _with_ts(read_records(spark, marketing, "marketing"), "ms").filter(
        ~F.col("behavior").eqNullSafe("UNINSTALL"))
    keys = [] if total else ["channel", "behavior"]
    c = windows.window_count(m, keys, "1 hour", "5 seconds", count_col="cnt")
    if total:
        c = c.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "window_end", "cnt")
    return c.select("channel", "behavior", end_string("window_end").alias("window_end"), "cnt")


def ad_statistics(spark: SparkSession, ad_clicks: str, limit: int = 100, output: str = "province",
                  reset: str = "none") -> DataFrame:
    """``output``: 'province' (counts per province and window), 'blacklist' (warnings) or 'passed'. ``reset``:
    'none', or 'calendar_day' to count each day anew."""
    clicks = _with_ts(read_records(spark, ad_clicks, "ad_click"))
    if output == "blacklist":
        return blocking.blacklist_warnings(clicks, limit, reset=reset)
    passed = blocking.block_clicks(clicks, limit, reset=reset)
    if output == "passed":
        return passed.drop("seq", "ts")
    c = windows.window_count(passed, ["province"], "1 hour", "5 minutes", count_col="cnt")
    return c.select("province", end_string("window_end").alias("window_end"), "cnt")


def login_fail(spark: SparkSession, logins: str, method: str = "pairs", limit_s: int | None = None) -> DataFrame:
    """``method``: 'pairs' (2 fails within 2 s, arrival order), 'streak' (3 consecutive within 5 s,
    event time) or 'timed' (timer-closed 2 s groups)."""
    df = _with_ts(read_records(spark, logins, "login"))
    if method == "pairs":
        return patterns.login_fail_pairs(df, limit_s or 2)
    if method == "streak":
        return patterns.login_fail_streak(df, 3, limit_s or 5)
    return patterns.login_fail_timed(df, limit_s or 2, 2)


def order_timeout(spark: SparkSession, orders: str, method: str = "state") -> DataFrame:
    """``method``: 'state' (15 min state machine) or 'pattern' (create then pay within 5 min)."""
    df = _with_ts(read_records(spark, orders, "order"))
    return patterns.order_state(df, 900) if method == "state" else patterns.order_pay_match(df, 300)


def tx_match(spark: SparkSession, orders: str, receipts: str, mode: str = "interval") -> DataFrame:
    """``mode``: 'interval' or 'key' reconciliation with both residuals, or 'join' (all pairs within
    [-3 s, +5 s])."""
    pays = joins.pays_of(read_records(spark, orders, "order"))
    rec = read_records(spark, receipts, "receipt")
    if mode == "join":
        return joins.interval_join(pays, rec, -3, 5)
    return joins.reconcile(pays, rec, mode)


JOBS = {
    "hot-items": (hot_items, ["behavior"]),
    "hot-pages": (hot_pages, ["log"]),
    "page-view": (page_view, ["behavior"]),
    "unique-visitor": (unique_visitor, ["behavior"]),
    "marketing-by-channel": (marketing_by_channel, ["marketing"]),
    "ad-statistics": (ad_statistics, ["ad_clicks"]),
    "login-fail": (login_fail, ["logins"]),
    "order-timeout": (order_timeout, ["orders"]),
    "tx-match": (tx_match, ["orders", "receipts"]),
}
