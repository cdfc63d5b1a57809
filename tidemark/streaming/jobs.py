"""Streaming forms of the analyses: functions from streaming DataFrames to streaming DataFrames, plus
``foreachBatch`` writers for what needs a whole window at once (rankings) or several outputs (side
outputs by tag).

Stateful processors need the RocksDB state store; :func:`use_rocksdb` sets it on the session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bitmap, report
from tidemark.functions.time import duration_ms
from tidemark.operators import patterns, topn
from tidemark.operators.lateness import last_end
from tidemark.session import delete_path, list_names, path_exists
from tidemark.streaming.aggregations import (
    counts_and_late_rows, event_time, sliding_count_stream, window_count_stream)
from tidemark.streaming.processors import (
    CYCLE_RESULT, LOGIN_WARNING, ORDER_RESULT, RUNNING_UV, TX_RESULT, ClickBlockerProcessor, LoginFailPairProcessor,
    LoginFailStreakProcessor, LoginFailTimerProcessor, OrderCycleProcessor, OrderStateProcessor,
    RunningNumberProcessor, TxMatchProcessor)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def order_state_stream(orders: DataFrame, timeout_s: int = 900, delay: str = "200 milliseconds") -> DataFrame:
    return (event_time(orders, "ts", delay).groupBy("order_id")
            .transformWithState(OrderStateProcessor(timeout_s), ORDER_RESULT, "Append", "EventTime"))


def order_cycles_stream(orders: DataFrame, timeout_s: int = 900, late_s: int = 900, early_s: int = 900,
                        delay: str = "200 milliseconds") -> DataFrame:
    """(order_id, cycle_time, result_state) per cycle of an order id (arrival order by ``seq``, if there is one)."""
    src = event_time(orders, "ts", delay).filter(F.col("event_type").isin("create", "pay"))
    if "seq" not in orders.columns:
        src = src.withColumn("seq", F.lit(None).cast("long"))
    return src.groupBy("order_id").transformWithState(
        OrderCycleProcessor(timeout_s, late_s, early_s), CYCLE_RESULT, "Append", "EventTime")


def order_pay_timeout_stream(orders: DataFrame, within_s: int = 300,
                             delay: str = "200 milliseconds") -> DataFrame:
    """(order_id, result_state) per create: 'payed' if a pay of the order follows within the limit (strict), else
    'timeout <create + within, epoch ms>'. An outer interval join of the creates with the pays, so state
    lives no longer than the interval; a create with several such pays comes out once."""
    src = event_time(orders, "ts", delay)
    own = [F.col("seq").alias("c_seq")] if "seq" in orders.columns else []
    creates = src.filter(F.col("event_type") == "create").select("order_id", F.col("timestamp").alias("c_time"),
                                                                 F.col("ts").alias("c_ts"), *own)
    pays = src.filter(F.col("event_type") == "pay").select(F.col("order_id").alias("p_id"), F.col("ts").alias("p_ts"))
    cond = F.col("order_id").eqNullSafe(F.col("p_id")) & F.expr(
        f"p_ts >= c_ts AND p_ts < c_ts + INTERVAL '{within_s}' SECOND")
    joined = creates.join(pays, cond, "left_outer")
    timeout = F.concat(F.lit(patterns.TIMEOUT_PREFIX), ((F.col("c_time") + within_s) * 1000).cast("string"))
    names = [c for c in joined.columns if c == "c_seq"]
    state = F.when(F.col("p_ts").isNotNull(), patterns.PAYED).otherwise(timeout).alias("result_state")
    once = joined.select("order_id", "c_ts", *names, state).dropDuplicates(["order_id", "c_ts", *names])
    return once.select("order_id", "result_state")


def blocker_stream(clicks: DataFrame, limit: int = 100, reset: str = "none", delay: str | None = None,
                   ttl_s: int | None = None, period_s: int = 86400) -> DataFrame:
    """Clicks plus ``tag`` ('data' | 'blacklist') and ``warning_msg``; arrival order by ``seq``.

    ``reset='calendar_day'`` counts each day of event time anew (needs ``delay``). With ``delay`` the input gets
    a watermark on ``ts`` and the output keeps ``ts`` as its event-time column, so windowed aggregations can
    follow (see :func:`ad_province_stream`). ``reset='rolling'`` counts anew ``period_s`` after a key's first row, by the
    clock. ``ttl_s`` bounds the life of the counts without a reset."""
    if reset == "calendar_day" and not delay:
        raise ValueError("a daily reset needs a watermark delay")
    if delay:
        clicks = event_time(clicks, "ts", delay)
    schema = T.StructType(clicks.schema.fields + [T.StructField("tag", T.StringType()),
                                                  T.StructField("warning_msg", T.StringType())])
    extra = {"eventTimeColumnName": "ts"} if delay else {}
    mode = "EventTime" if reset == "calendar_day" else "ProcessingTime" if ttl_s or reset == "rolling" else "None"
    return clicks.groupBy("user_id", "ad_id").transformWithState(
        ClickBlockerProcessor(limit, reset, ttl_s, period_s), schema, "Append", mode, **extra)


def ad_province_stream(clicks: DataFrame, limit: int = 100, size: str = "1 hour", slide: str = "5 minutes",
                       delay: str = "200 milliseconds", reset: str = "calendar_day") -> DataFrame:
    """(province, window_end, cnt) of the clicks that pass the blocker, per sliding window."""
    passed = blocker_stream(clicks, limit, reset, delay=delay).filter(F.col("tag") == "data")
    return window_count_stream(passed, ["province"], size, slide, delay=None)


def login_fail_stream(logins: DataFrame, limit_s: int = 2, fail_times: int = 2,
                      ttl_s: int | None = None) -> DataFrame:
    return logins.groupBy("user_id").transformWithState(
        LoginFailPairProcessor(limit_s, fail_times, ttl_s), LOGIN_WARNING, "Append",
        "ProcessingTime" if ttl_s else "None")


def login_fail_timed_stream(logins: DataFrame, limit_s: int = 2, min_fails: int = 2,
                            delay: str = "200 milliseconds") -> DataFrame:
    return event_time(logins, "ts", delay).groupBy("user_id").transformWithState(
        LoginFailTimerProcessor(limit_s, min_fails), LOGIN_WARNING, "Append", "EventTime")


def login_fail_streak_stream(logins: DataFrame, times: int = 3, within_s: int = 5,
                             delay: str = "200 milliseconds") -> DataFrame:
    return event_time(logins, "ts", delay).groupBy("user_id").transformWithState(
        LoginFailStreakProcessor(times, within_s), LOGIN_WARNING, "Append", "EventTime")


def tx_match_stream(pays: DataFrame, receipts: DataFrame, pay_wait_s: int = 5, receipt_wait_s: int = 3,
                    delay: str = "200 milliseconds") -> DataFrame:
    """Pays and receipts as one keyed stream (watermark: the minimum over both inputs)."""
    p = pays.select(F.lit("pay").alias("side"), "tx_id", "order_id", F.lit(None).cast("string").alias(
        "pay_channel"), "timestamp", "ts")
    r = receipts.select(F.lit("receipt").alias("side"), "tx_id", F.lit(None).cast("long").alias("order_id"),
                        "pay_channel", "timestamp", "ts")
    both = event_time(p, "ts", delay).unionByName(event_time(r, "ts", delay))
    return both.groupBy("tx_id").transformWithState(
        TxMatchProcessor(pay_wait_s, receipt_wait_s), TX_RESULT, "Append", "EventTime")


def tx_join_stream(pays: DataFrame, receipts: DataFrame, lower_s: int = -3, upper_s: int = 5,
                   delay: str = "200 milliseconds") -> DataFrame:
    """Stream-stream interval join; the time bounds let Spark drop state behind the watermarks."""
    p = event_time(pays.select("order_id", "tx_id", F.col("timestamp").alias("pay_time"),
                               F.col("ts").alias("pay_ts")), "pay_ts", delay)
    r = event_time(receipts.select(F.col("tx_id").alias("r_tx"), "pay_channel",
                                   F.col("timestamp").alias("receipt_time"), F.col("ts").alias("r_ts")),
                   "r_ts", delay)
    cond = (p.tx_id == r.r_tx) & F.expr(
        f"r_ts >= pay_ts + INTERVAL '{lower_s}' SECOND AND r_ts <= pay_ts + INTERVAL '{upper_s}' SECOND")
    return p.join(r, cond).select("order_id", "tx_id", "pay_time", "pay_channel", "receipt_time")


def item_counts_stream(behaviors: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                       delay: str = "200 milliseconds") -> DataFrame:
    pv = behaviors.filter(F.col("behavior") == "pv")
    return window_count_stream(pv, ["item_id"], size, slide, delay=delay)


def channel_counts_stream(marketing: DataFrame, size: str = "1 hour", slide: str = "5 seconds",
                          delay: str = "200 milliseconds") -> DataFrame:
    m = marketing.filter(~F.col("behavior").eqNullSafe("UNINSTALL"))
    return sliding_count_stream(m, ["channel", "behavior"], size, slide, delay=delay)


def channel_total_stream(marketing: DataFrame, size: str = "1 hour", slide: str = "5 seconds",
                         delay: str = "200 milliseconds") -> DataFrame:
    """(window_end, cnt) over all channels and behaviours but UNINSTALL."""
    m = marketing.filter(~F.col("behavior").eqNullSafe("UNINSTALL"))
    return sliding_count_stream(m, [], size, slide, delay=delay)


def page_view_stream(behaviors: DataFrame, size: str = "1 hour", salt: int = 10,
                     delay: str = "200 milliseconds") -> DataFrame:
    """(url='pv', window_end, cnt): page views per (random salt, window), then summed per window."""
    pv = behaviors.filter(F.col("behavior") == "pv").withColumn("_salt", (F.rand() * salt).cast("int"))
    parts = (event_time(pv, "ts", delay).groupBy(F.window("ts", size).alias("w"), "_salt")
             .agg(F.count(F.lit(1)).alias("_n")).select(F.window_time("w").alias("_t"), "_n"))
    return (parts.groupBy(F.window("_t", size).alias("w")).agg(F.sum("_n").alias("cnt"))
            .select(F.lit("pv").alias("url"), F.unix_millis(F.col("w.end")).alias("window_end"), "cnt"))


def uv_running_stream(views: DataFrame, size: str = "1 hour", delay: str = "200 milliseconds") -> DataFrame:
    """(url='uv', window_end, cnt, user_id): one row per new bitmap offset of a window with its running number.
    New offsets are found by (window, offset), spread over tasks; only they are numbered per window."""
    end_ms = F.unix_millis(F.col("w.end"))
    seen = (event_time(views, "ts", delay)
            .select(F.window("ts", size).alias("w"), bitmap.offset(F.col("user_id")).alias("_off"), "user_id", "seq")
            .dropDuplicates(["w", "_off"]).withColumn("window_end", end_ms))
    return seen.select("window_end", "user_id", "seq", "w").groupBy("window_end").transformWithState(
        RunningNumberProcessor(), RUNNING_UV, "Append", "EventTime")


# ---- foreachBatch writers -------------------------------------------------------------------------------

def top_n_writer(n: int, id_col: str, write: Callable[[DataFrame, int], None],
                 partition_by: Sequence[str] = ("window_end",)) -> Callable[[DataFrame, int], None]:
    """foreachBatch function ranking each micro-batch of closed windows (append output: every window is
    complete in exactly one batch) and handing the top-n rows to ``write(df, epoch_id)``."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        write(topn.top_n(batch, n, partition_by, id_col=id_col), epoch_id)
    return run


def split_writer(writers: dict[str, Callable[[DataFrame, int], None]],
                 tag_col: str = "tag") -> Callable[[DataFrame, int], None]:
    """foreachBatch function sending the rows of each tag (main output and side outputs) to its writer."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for tag, write in writers.items():
                write(batch.filter(F.col(tag_col) == tag), epoch_id)
        finally:
            batch.unpersist()
    return run


def page_counts_stream(requests: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
                       bound: str = "1 second", allowed_lateness: str = "1 minute",
                       mode: str = "update") -> DataFrame:
    """(url, window_end, cnt) with allowed lateness: the watermark delay is bound + lateness, so a window
    accepts rows until the watermark passes its end by that much. In ``update`` output mode a window is
    re-emitted whenever a (late) row changes it; with ``mode='append'`` it comes once, final, and rows are
    counted per pane first instead of being copied to all their windows."""
    delay = f"{duration_ms(bound) + duration_ms(allowed_lateness)} milliseconds"
    if mode == "append" and duration_ms(size) % duration_ms(slide) == 0:
        return sliding_count_stream(requests, ["url"], size, slide, delay=delay)
    return window_count_stream(requests, ["url"], size, slide, delay=delay)


def page_counts_with_late_rows(requests: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
                               bound: str = "1 second", allowed_lateness: str = "1 minute") -> DataFrame:
    """Page counts and the requests too late for every window, as two tags of one query (see
    :func:`tidemark.streaming.aggregations.counts_and_late_rows`); :func:`split_writer` hands each to its writer."""
    return counts_and_late_rows(requests, ["url"], size, slide, bound, allowed_lateness)


class EpochState:
    """Tables of a foreachBatch writer, one folder per epoch under ``state_dir`` (shared storage).

    An epoch reads the state of the one before it and writes its own, so a replayed epoch sees what its first
    run saw, whether or not that run got as far as writing. Older folders than these two are deleted."""

    def __init__(self, spark: SparkSession, state_dir: str):
        self.spark, self.dir = spark, state_dir

    def _epochs(self) -> list[int]:
        return [int(n.removeprefix("epoch=")) for n in list_names(self.spark, self.dir) if n.startswith("epoch=")]

    def path(self, epoch: int, name: str) -> str:
        return f"{self.dir}/epoch={epoch}/{name}"

    def read_before(self, epoch: int, name: str) -> DataFrame | None:
        """The table as the last epoch before this one left it."""
        before = [e for e in self._epochs() if e < epoch and path_exists(self.spark, f"{self.path(e, name)}/_SUCCESS")]
        return self.spark.read.parquet(self.path(max(before), name)) if before else None

    def write(self, epoch: int, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(epoch, name))
        return self.spark.read.schema(df.schema).parquet(self.path(epoch, name))

    def forget_before(self, epoch: int) -> None:
        """Keep this epoch and the one before it."""
        for e in sorted(e for e in self._epochs() if e < epoch)[:-1]:
            delete_path(self.spark, f"{self.dir}/epoch={e}")


def ranked_changelog_writer(n: int, id_col: str, state_dir: str, write: Callable[[DataFrame, int], None],
                            window_col: str = "window_end", count_col: str = "cnt", keep: str | None = None
                            ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for ``update``-mode window counts: re-rank every window touched by the batch
    and emit a retract stream, ``op = false`` for ranking rows that no longer hold and ``op = true`` for new
    ones (rows that stay the same emit nothing).

    The counts and rankings of open windows are an :class:`EpochState`; a replayed batch emits the same
    changes again, so ``write`` only has to be idempotent per ``epoch_id``. ``keep``: windows that end so long
    before the latest one are closed and leave the state (window size + bound + lateness is enough); the
    state holds all windows without it.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        state = EpochState(batch.sparkSession, state_dir)
        keys = [id_col, window_col]
        batch = batch.select(*keys, count_col)
        touched = batch.select(window_col).distinct()
        counts = batch
        prev_counts = state.read_before(epoch_id, "counts")
        if prev_counts is not None:
            counts = prev_counts.join(batch.select(*keys), keys, "left_anti").select(*counts.columns).unionByName(batch)
        if keep is not None:
            last = counts.agg(F.max(window_col)).first()[0]
            if last is not None:
                counts = counts.filter(F.col(window_col) >= last - duration_ms(keep))
        counts = state.write(epoch_id, "counts", counts)
        open_ = counts.select(window_col).distinct()
        columns = [id_col, window_col, count_col, "rank"]
        new_top = topn.top_n(counts.join(touched, window_col, "left_semi"), n, (window_col,), id_col=id_col).select(*columns)
        prev_top = state.read_before(epoch_id, "top")
        top = new_top if prev_top is None else prev_top.join(touched, window_col, "left_anti").join(
            open_, window_col, "left_semi").select(*columns).unionByName(new_top)
        top = state.write(epoch_id, "top", top)
        new_top = top.join(touched, window_col, "left_semi").select(*columns)
        old_top = (new_top.limit(0) if prev_top is None else
                   prev_top.join(touched, window_col, "left_semi").join(open_, window_col, "left_semi").select(*columns))
        both = old_top.withColumn("_d", F.lit(-1)).unionByName(new_top.withColumn("_d", F.lit(1)))
        changes = both.groupBy(*columns).agg(F.sum("_d").alias("_d")).filter(F.col("_d") != 0)
        write(changes.select(*columns, (F.col("_d") > 0).alias("op")), epoch_id)
        state.forget_before(epoch_id)
    return run


def report_writer(n: int, id_col: str, state_dir: str, write: Callable[[DataFrame, int], None], labels: tuple,
                  keep: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for ``update``-mode window counts: the text ranking of every window whose ranking
    the batch has changed, again whenever a late row changes it."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession

        def rendered(changes: DataFrame, epoch: int) -> None:
            top = spark.read.parquet(EpochState(spark, state_dir).path(epoch, "top"))
            changed = changes.select("window_end").distinct()
            write(report.topn_report(top.join(changed, "window_end", "left_semi"), id_col, labels), epoch)

        ranked_changelog_writer(n, id_col, state_dir, rendered, keep=keep)(batch, epoch_id)
    return run


def late_rows_writer(ts_ms_col: str, size: str, slide: str, delay: str, state_dir: str,
                     write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function on the raw stream emitting the rows a windowed aggregation with watermark
    ``delay`` drops from every window: the last window end of the row is at or below the watermark of the
    batch (largest event time of earlier batches minus the delay). The largest event time after each epoch
    is an :class:`EpochState`, so a replay emits the same rows. Batches must be cut as in the aggregation
    query (same source and trigger settings) for the two to agree."""
    delay_ms = duration_ms(delay)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        state = EpochState(spark, state_dir)
        saved = state.read_before(epoch_id, "max_event_time")
        seen = saved.first()[0] if saved is not None else None
        if seen is not None:
            write(batch.filter(last_end(ts_ms_col, size, slide) <= F.lit(seen - delay_ms)), epoch_id)
        times = [t for t in (seen, batch.agg(F.max(ts_ms_col)).first()[0]) if t is not None]
        if times:
            state.write(epoch_id, "max_event_time", spark.createDataFrame([(int(max(times)),)], "max_ts long"))
            state.forget_before(epoch_id)
    return run
