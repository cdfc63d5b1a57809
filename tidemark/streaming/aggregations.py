"""Streaming windowed aggregations: watermark + event-time windows, append output.

* :func:`window_count_stream`: counts per (keys, window), emitted once the watermark closes a window.
* :func:`sliding_count_stream`: dense sliding windows: rows -> panes one slide wide -> a ring of pane counts per key,
  which emits runs of equal counts. Equal to the direct form.
* :func:`counts_and_late_rows`: the same ring on rows, with the rows that come too late for every window.
* :func:`uv_stream`: distinct visitors per tumbling window via ``dropDuplicates`` on (window, visitor) followed by a
  count; in ``update`` mode the count is re-emitted whenever it grows, the micro-batch form of a per-row running count.
* :func:`uv_bitmap_stream`: distinct bitmap offsets per tumbling window, the bitmap in blocks of state.

The forms with a processor need the RocksDB state store (:func:`tidemark.streaming.jobs.use_rocksdb`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bitmap
from tidemark.functions.time import duration_ms
from tidemark.streaming.processors import BitmapProcessor, SlidingCountProcessor


def event_time(df: DataFrame, ts_col: str = "ts", delay: str = "200 milliseconds") -> DataFrame:
    """Watermark on an event-time column (a TIMESTAMP_NTZ column is cast first, as watermarks need
    TIMESTAMP)."""
    if dict(df.dtypes).get(ts_col) == "timestamp_ntz":
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, delay)


def window_count_stream(df: DataFrame, keys: Sequence[str], size: str, slide: str | None = None,
                        ts_col: str = "ts", delay: str | None = "200 milliseconds",
                        count_col: str = "cnt") -> DataFrame:
    """(keys, window_end ms, cnt) rows of closed windows. ``delay=None``: the input already carries a
    watermark (e.g. the event-time output of a stateful processor)."""
    w = F.window(ts_col, size, slide) if slide else F.window(ts_col, size)
    src = event_time(df, ts_col, delay) if delay else df
    return (src.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.unix_millis(F.col("w.end")).alias("window_end"), count_col))


def sliding_count_stream(df: DataFrame, keys: Sequence[str], size: str, slide: str, ts_col: str = "ts",
                         delay: str = "200 milliseconds", count_col: str = "cnt") -> DataFrame:
    """Dense sliding windows: rows are counted per (key, pane), which spreads a busy key over tasks, and the closed
    panes go to the key's ring of pane counts (:class:`SlidingCountProcessor`), which emits one row per change of its
    count. Listing the windows of such a run is the last step, without state. ``slide`` must divide ``size``."""
    keys, size_ms, slide_ms = list(keys), duration_ms(size), duration_ms(slide)
    assert size_ms % slide_ms == 0
    names = keys or ["_all"]
    src = event_time(df, ts_col, delay)
    panes = ((src if keys else src.withColumn("_all", F.lit(0))).groupBy(F.window(ts_col, slide).alias("p"), *names)
             .agg(F.count(F.lit(1)).alias("_n"))
             .select(*names, F.unix_millis(F.col("p.start")).alias("_ms"), "_n"))
    runs = panes.groupBy(*names).transformWithState(
        SlidingCountProcessor(size_ms, slide_ms, keys=tuple(names), whole_panes=True), _runs_schema(panes, names), "Append", "EventTime")
    return window_counts(runs, keys, slide, count_col)


def _runs_schema(df: DataFrame, keys: Sequence[str], payload: T.StructType | None = None) -> T.StructType:
    long = T.LongType()
    return T.StructType([df.schema[k] for k in keys] + [
        T.StructField("tag", T.StringType()), T.StructField("first_end", long), T.StructField("last_end", long),
        T.StructField("cnt", long)] + ([T.StructField("late", payload)] if payload else []))


def window_counts(runs: DataFrame, keys: Sequence[str], slide: str, count_col: str = "cnt") -> DataFrame:
    """(keys, window_end ms, cnt) of the 'count' rows of a :class:`SlidingCountProcessor`."""
    ends = F.explode(F.sequence("first_end", "last_end", F.lit(duration_ms(slide)).cast("long"))).alias("window_end")
    return runs.filter("tag = 'count'").select(*keys, ends, F.col("cnt").alias(count_col))


def counts_and_late_rows(df: DataFrame, keys: Sequence[str], size: str, slide: str, bound: str, lateness: str,
                         ts_col: str = "ts") -> DataFrame:
    """Window counts and late rows of one query: ``tag`` 'count' rows hold runs of equal counts (:func:`window_counts`
    lists their windows), 'late' rows the input row in ``late``. Every row is either counted or late, by the watermark
    that this query itself has when the row comes, wherever batches are cut: a row counts for the windows whose end - 1 +
    ``lateness`` the watermark has not reached, and is late if there are none. Rows of a key go to one task."""
    own = [c for c in df.columns if not c.startswith("_")]
    payload = T.StructType([df.schema[c] for c in own])
    src = (event_time(df.withColumn("_wm", F.col(ts_col).cast("timestamp")), "_wm", bound)
           .select(*keys, F.unix_millis(F.col(ts_col).cast("timestamp")).alias("_ms"), F.lit(1).cast("long").alias("_n"),
                   F.struct(*own).alias("_row")))
    processor = SlidingCountProcessor(duration_ms(size), duration_ms(slide), duration_ms(lateness), tuple(keys), True)
    return src.groupBy(*keys).transformWithState(processor, _runs_schema(src, keys, payload), "Append", "EventTime")


def uv_stream(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
              delay: str = "200 milliseconds", tag: str = "uv") -> DataFrame:
    """(url=tag, window_end, cnt): distinct visitors per tumbling window."""
    seen = (event_time(df, ts_col, delay).select(F.window(ts_col, size).alias("w"), F.col(user_col).alias("_u"))
            .dropDuplicates(["w", "_u"]))
    return (seen.groupBy("w").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit(tag).alias("url"), F.unix_millis(F.col("w.end")).alias("window_end"), "cnt"))


def uv_bitmap_stream(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
                     delay: str = "200 milliseconds", tag: str = "uv", bits: int = bitmap.BITS) -> DataFrame:
    """(url=tag, window_end, cnt): distinct bitmap offsets per tumbling window.

    The bitmap of a window is kept in blocks of 32,768 positions (:class:`BitmapProcessor`), 2^bits / 8 bytes a window at
    most; each batch adds the number of positions that it sets."""
    off, block = bitmap.offset(F.col(user_col), bits=bits), BitmapProcessor.BLOCK_BITS
    src = (event_time(df, ts_col, delay)
           .select(F.unix_millis(F.window(ts_col, size).getField("end")).alias("window_end"), off.alias("_off"), F.col(ts_col).alias("ts"))
           .select("window_end", F.floor(F.col("_off") / block).alias("_bucket"), (F.col("_off") % block).cast("int").alias("_pos"), "ts"))
    new = src.groupBy("window_end", "_bucket").transformWithState(
        BitmapProcessor(), "ts timestamp, n long", "Append", "EventTime", eventTimeColumnName="ts")
    return (new.groupBy(F.window("ts", size).alias("w")).agg(F.sum("n").alias("cnt"))
            .select(F.lit(tag).alias("url"), F.unix_millis(F.col("w.end")).alias("window_end"), "cnt"))
