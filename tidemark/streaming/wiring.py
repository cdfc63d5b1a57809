"""Streaming jobs wired end to end: line source -> records with ``ts`` and ``seq`` -> operator -> sink.

``python -m tidemark stream <job>`` runs them. A source is any line stream of
:func:`tidemark.sources.lines.line_stream`; with a message bus ``seq`` is the offset, other line sources tell no
position and rows of one batch are ordered by their event time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import report
from tidemark.operators.joins import pays_of
from tidemark.plans.jobs import STATIC_ASSET
from tidemark.sources.access_log import parse_access_log
from tidemark.sources.lines import line_stream
from tidemark.sources.records import parse_records, with_event_time
from tidemark.streaming import jobs


def record_stream(lines: DataFrame, kind: str, mode: str = "FAILFAST") -> DataFrame:
    """Records of a line stream with ``ts`` and ``seq``."""
    keep = [c for c in ("seq",) if c in lines.columns]
    df = with_event_time(parse_records(lines, kind, mode=mode, keep=keep), "ms" if kind == "marketing" else "s")
    return df if keep else df.withColumn("seq", F.col("timestamp"))


def request_stream(lines: DataFrame, strict: bool = False) -> DataFrame:
    """GET requests for pages from a stream of access-log lines, with ``ts``."""
    log = parse_access_log(lines, strict=strict)
    return (log.filter((F.col("method") == "GET") & ~F.col("url").rlike(STATIC_ASSET))
            .withColumn("ts", F.timestamp_millis("timestamp")))


#: Job: (inputs, function of their line streams).
STREAM_JOBS: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {
    "item-counts": (["behavior"], lambda b: jobs.item_counts_stream(record_stream(b, "behavior"))),
    "hot-items": (["behavior"], lambda b: jobs.item_counts_stream(record_stream(b, "behavior"))),
    "page-counts": (["log"], lambda log: jobs.page_counts_stream(request_stream(log), mode="append")),
    "hot-pages": (["log"], lambda log: jobs.page_counts_stream(request_stream(log))),
    "page-view": (["behavior"], lambda b: jobs.page_view_stream(record_stream(b, "behavior"))),
    "unique-visitor": (["behavior"], lambda b: jobs.uv_running_stream(
        record_stream(b, "behavior").filter(F.col("behavior") == "pv"))),
    "marketing-by-channel": (["marketing"], lambda m: jobs.channel_counts_stream(record_stream(m, "marketing"))),
    "marketing-total": (["marketing"], lambda m: jobs.channel_total_stream(record_stream(m, "marketing"))),
    "ad-blocker": (["ad_clicks"], lambda c: jobs.blocker_stream(
        record_stream(c, "ad_click"), reset="calendar_day", delay="200 milliseconds")),
    "ad-statistics": (["ad_clicks"], lambda c: jobs.ad_province_stream(record_stream(c, "ad_click"))),
    "login-fail": (["logins"], lambda s: jobs.login_fail_stream(record_stream(s, "login"))),
    "login-fail-streak": (["logins"], lambda s: jobs.login_fail_streak_stream(record_stream(s, "login"))),
    "login-fail-timed": (["logins"], lambda s: jobs.login_fail_timed_stream(record_stream(s, "login"))),
    "order-timeout": (["orders"], lambda o: jobs.order_state_stream(record_stream(o, "order"))),
    "order-pay-timeout": (["orders"], lambda o: jobs.order_pay_timeout_stream(record_stream(o, "order"))),
    "tx-match": (["orders", "receipts"], lambda o, r: jobs.tx_match_stream(
        pays_of(record_stream(o, "order")), record_stream(r, "receipt"))),
    "tx-join": (["orders", "receipts"], lambda o, r: jobs.tx_join_stream(
        pays_of(record_stream(o, "order")), record_stream(r, "receipt"))),
}


def start(spark: SparkSession, job: str, sources: dict[str, str], out: str, checkpoint: str, fmt: str = "text",
          options: dict[str, str] | None = None, once: bool = False):
    """Start a job: ``sources`` maps each input to a folder (text) or is given by ``options`` (kafka: the topic
    under ``subscribe``). Results are appended as JSON lines under ``out``; the ranking jobs write a report per
    window instead, and hot pages one for each change. Returns the streaming query."""
    jobs.use_rocksdb(spark)
    inputs, build = STREAM_JOBS[job]
    streams = []
    for name in inputs:
        extra = dict(options or {})
        if fmt == "kafka":
            extra["subscribe"] = sources[name]
        streams.append(line_stream(spark, fmt, extra, None if fmt in ("kafka", "socket") else sources[name]))
    df = build(*streams)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").json(f"{out}/epoch={epoch}")

    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if job == "hot-items":
        writer = writer.outputMode("append").foreachBatch(jobs.top_n_writer(5, "item_id", lambda top, e: write(
            report.topn_report(top, "item_id", report.ITEM_LABELS), e)))
    elif job == "hot-pages":
        writer = writer.outputMode("update").foreachBatch(jobs.report_writer(
            3, "url", f"{checkpoint}/ranking", write, report.PAGE_LABELS, keep="12 minutes"))
    else:
        writer = writer.outputMode("append").format("json").option("path", out)
    return (writer.trigger(availableNow=True) if once else writer).start()
