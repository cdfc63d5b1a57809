"""Threshold blocking: the first ``limit`` rows of a (user, ad) key pass, later ones are dropped, and the
first dropped row raises one warning per key and reset period.

Row positions come from the chunked rank of :mod:`tidemark.operators.sequence` (arrival order), and chunks
that start at or beyond ``limit + 1`` are skipped before the ranking, so a key with millions of rows costs
no more than its first chunk or two.

``reset`` begins the counts anew: never (``none``), with each calendar day of event time (``calendar_day``), or
``period_s`` after the first row counted (``rolling``: the next row then begins a period of its own).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import sequence as seq
from tidemark.session import materialize, shuffled

# Fixed value: warning text, "click over <limit>times." (no space before "times").
WARNING_MSG = "click over {limit}times."


def _period(df: DataFrame, reset: str) -> DataFrame:
    if reset == "none":
        return df.withColumn("_period", F.lit(0).cast("long"))
    if reset == "calendar_day":
        return df.withColumn("_period", F.floor(F.col("timestamp") / 86400).cast("long"))
    raise ValueError("reset must be 'none' or 'calendar_day'")


def _ranked(clicks: DataFrame, keys: Sequence[str], limit: int, reset: str, period_s: int,
            rows_per_chunk: int) -> DataFrame:
    if reset == "rolling":
        return _rolling(clicks, keys, limit, period_s, rows_per_chunk)
    df = _period(clicks, reset).withColumn("_chunk", seq.arrival_chunk("seq", rows_per_chunk))
    return seq.rank(df, [*keys, "_period"], ["seq"], "_chunk", out="_pos", carry_below=limit + 1)


def _rolling(clicks: DataFrame, keys: Sequence[str], limit: int, period_s: int, rows_per_chunk: int) -> DataFrame:
    """Positions in periods of ``period_s`` that begin at a key's first row, and at the first row after each. Rows are in
    the order of time, then ``seq``. Only keys with more than ``limit`` rows are cut into periods; all rows of the others
    pass (position 1). Busy keys and starts grow with the clicks: both are joined by a shuffle."""
    df = clicks.withColumn("_key", F.struct(*keys))
    busy = shuffled(df.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("_key"))
    rest = df.join(busy, "_key", "left_anti").withColumn("_pos", F.lit(1).cast("long"))
    rows, chunk = seq.chunk_by(df.join(busy, "_key", "left_semi"), ["_key"], "timestamp", "balanced", target_rows=rows_per_chunk)
    rows = materialize(seq.rank(rows, ["_key"], ["timestamp", "seq"], chunk, out="_i").withColumn("_i", F.col("_i") - 1), "busy-clicks")
    starts = seq.greedy_starts(rows, "_key", "_i", "timestamp", period_s, rows_per_chunk)
    rows = rows.join(shuffled(starts.select("_key", "_i", F.lit(True).alias("_opens"))), ["_key", "_i"], "left")
    rows = seq.running_agg(rows, ["_key"], ["_i"], chunk, F.when(F.col("_opens"), F.col("_i")), "_begin", "max")
    rows = rows.withColumn("_pos", F.col("_i") - F.col("_begin") + 1)
    return rows.select(*rest.columns).unionByName(rest).drop("_key")


def block_clicks(clicks: DataFrame, limit: int = 100, keys: Sequence[str] = ("user_id", "ad_id"),
                 reset: str = "none", rows_per_chunk: int = 1 << 20, period_s: int = 86400) -> DataFrame:
    """The rows that pass the blocker (same columns as the input)."""
    ranked = _ranked(clicks, keys, limit, reset, period_s, rows_per_chunk)
    return ranked.filter(F.col("_pos") <= limit).select(*clicks.columns)


def blacklist_warnings(clicks: DataFrame, limit: int = 100, keys: Sequence[str] = ("user_id", "ad_id"),
                       reset: str = "none", rows_per_chunk: int = 1 << 20, period_s: int = 86400) -> DataFrame:
    """(user_id, ad_id, warning_msg): one row per key and period that went over ``limit``."""
    ranked = _ranked(clicks, keys, limit, reset, period_s, rows_per_chunk)
    return ranked.filter(F.col("_pos") == limit + 1).select(
        *keys, F.lit(WARNING_MSG.format(limit=limit)).alias("warning_msg"))


def block_with_warnings(clicks: DataFrame, limit: int = 100, keys: Sequence[str] = ("user_id", "ad_id"),
                        reset: str = "none", rows_per_chunk: int = 1 << 20, period_s: int = 86400) -> DataFrame:
    """Both outputs in one pass: input columns plus ``tag`` ('data' for passing rows, 'blacklist' for the
    warning row, whose ``warning_msg`` is set). Split with a filter or in ``foreachBatch``."""
    ranked = _ranked(clicks, keys, limit, reset, period_s, rows_per_chunk).filter(F.col("_pos") <= limit + 1)
    return ranked.select(
        *clicks.columns,
        F.when(F.col("_pos") <= limit, F.lit("data")).otherwise(F.lit("blacklist")).alias("tag"),
        F.when(F.col("_pos") > limit, F.lit(WARNING_MSG.format(limit=limit))).alias("warning_msg"))
