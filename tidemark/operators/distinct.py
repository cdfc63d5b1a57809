"""Unique visitors per tumbling window: exact, bitmap, running (one row per newly seen id) and sketch; and mergeable
sketches per pane (:func:`uv_sketches`), from which sliding windows and longer periods are counted without the rows.

All forms aggregate by (window, visitor) or (window, bitmap bucket) before aggregating by window, so a
busy window is spread over many tasks before its final (small) merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bitmap
from tidemark.functions.time import duration_ms
from tidemark.operators import sequence as seq


def tumbling_end(size: str, ts_col: str = "ts") -> F.Column:
    size_ms = duration_ms(size)
    return ((F.floor(F.unix_millis(F.col(ts_col)) / size_ms) + 1) * size_ms).cast("long")


def uv_exact(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
             tag: str = "uv") -> DataFrame:
    """(url=tag, window_end, cnt): distinct visitors per window."""
    return (df.select(tumbling_end(size, ts_col).alias("window_end"), F.col(user_col).alias("_u"))
            .groupBy("window_end").agg(F.countDistinct("_u").alias("cnt"))
            .select(F.lit(tag).alias("url"), "window_end", "cnt"))


def uv_bitmap(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
              tag: str = "uv", bits: int = bitmap.BITS) -> DataFrame:
    """(url=tag, window_end, cnt): distinct bitmap offsets per window (may undercount on collisions).

    The 2^bits bitmap of a window is kept as Spark bitmaps of 32768 positions, one per bucket; each bucket
    is built by one task and only the bucket counts are summed per window.
    """
    off = bitmap.offset(F.col(user_col), bits=bits)
    return (df.select(tumbling_end(size, ts_col).alias("window_end"), off.alias("_off"))
            .groupBy("window_end", F.bitmap_bucket_number("_off").alias("_bucket"))
            .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_off"))).alias("_n"))
            .groupBy("window_end").agg(F.sum("_n").alias("cnt"))
            .select(F.lit(tag).alias("url"), "window_end", "cnt"))


def uv_running(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
               seq_col: str = "seq", tag: str = "uv", bits: int = bitmap.BITS,
               rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(url=tag, window_end, cnt, user_id): one row each time a row sets a new bitmap offset in its window,
    with the running number of set offsets, in arrival order (``seq``)."""
    off = bitmap.offset(F.col(user_col), bits=bits)
    firsts = (df.select(tumbling_end(size, ts_col).alias("window_end"), off.alias("_off"),
                        F.col(seq_col).alias("_seq"), F.col(user_col).alias("_user"))
              .groupBy("window_end", "_off")
              .agg(F.min_by(F.struct("_seq", "_user"), F.col("_seq")).alias("_first"))
              .select("window_end", "_first._seq", "_first._user")
              .withColumn("_chunk", seq.arrival_chunk("_seq", rows_per_chunk)))
    ranked = seq.rank(firsts, ["window_end"], ["_seq"], "_chunk", out="cnt")
    return ranked.select(F.lit(tag).alias("url"), "window_end", "cnt", F.col("_user").alias("user_id"))


def uv_approx(df: DataFrame, size: str = "1 hour", user_col: str = "user_id", ts_col: str = "ts",
              tag: str = "uv", rsd: float = 0.01) -> DataFrame:
    """(url=tag, window_end, cnt): HyperLogLog++ estimate, bounded memory per window."""
    return (df.select(tumbling_end(size, ts_col).alias("window_end"), F.col(user_col).alias("_u"))
            .groupBy("window_end").agg(F.approx_count_distinct("_u", rsd).alias("cnt"))
            .select(F.lit(tag).alias("url"), "window_end", "cnt"))


def uv_sketches(df: DataFrame, pane: str = "5 minutes", user_col: str = "user_id", ts_col: str = "ts",
                lg_k: int = 12) -> DataFrame:
    """(pane_end, sketch): a HyperLogLog sketch of 2^lg_k registers per pane, as binary. A pane's sketch is a few kB
    whatever its visitors, merges with any others, and can be stored and used again."""
    return (df.select(tumbling_end(pane, ts_col).alias("pane_end"), F.col(user_col).alias("_u"))
            .groupBy("pane_end").agg(F.hll_sketch_agg("_u", lg_k).alias("sketch")))


def uv_from_sketches(sketches: DataFrame, pane: str, size: str, slide: str | None = None, tag: str = "uv") -> DataFrame:
    """(url=tag, window_end, cnt): estimates for windows that are made of whole panes, from the union of their sketches.
    ``slide=None`` means tumbling. A union counts a visitor of several panes once; its relative error is that of one
    sketch, about 1.04 / sqrt(2^lg_k)."""
    pane_ms, size_ms, slide_ms = duration_ms(pane), duration_ms(size), duration_ms(slide or size)
    if size_ms % pane_ms or slide_ms % pane_ms:
        raise ValueError("a window must be made of whole panes")
    # the first window that holds the pane ends at the next multiple of the slide at or after the pane's end
    first = (F.ceil(F.col("pane_end") / slide_ms) * slide_ms).cast("long")
    last = F.col("pane_end") - pane_ms + size_ms
    ends = sketches.filter(first <= last).select(F.explode(F.sequence(first, last, F.lit(slide_ms).cast("long"))).alias("window_end"), "sketch")
    return (ends.groupBy("window_end").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cnt"))
            .select(F.lit(tag).alias("url"), "window_end", "cnt"))
