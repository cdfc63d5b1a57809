"""Event-time window counts: tumbling and sliding, epoch-aligned ``[start, end)`` windows.

Rows are always counted per (key, pane) first, a pane being one slide wide, so map-side aggregation leaves one
row per non-empty (key, pane) for the shuffle, however many windows a row is in. What follows depends only on
how many windows a pane is in, ``n = size / slide``; the results are the same:

* ``expand`` (up to ``EXPAND_MAX``): each pane count is copied to its n window ends and summed there.
* ``delta`` (above): a pane count c is +c at its pane and -c n panes later. The running sum of deltas along
  the panes of a key is the count of the window ending right after that pane; it only changes at delta
  positions, so each constant run is expanded to its window ends at the very end with no later shuffle. The
  running sum is chunked along time (see :mod:`tidemark.operators.sequence`) so a hot key spans many tasks.

``direct`` is Spark's own ``F.window`` grouping, which copies every row; it serves sizes that the slide does
not divide, and as a check of the others. In every form a NULL key is a group of its own, and a window with
rows whose counted column is all NULL has count 0, as in SQL.

Window ends are returned as epoch milliseconds (``window_end``), matching the long window ends of the
analyses; :func:`tidemark.functions.time.end_string` gives the text form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms
from tidemark.operators import sequence as seq


# Windows per pane up to which pane counts are copied to their windows.
EXPAND_MAX = 16


def event_ms(ts_col: str = "ts") -> Column:
    return F.unix_millis(F.col(ts_col))


def window_count(df: DataFrame, keys: Sequence[str], size: str, slide: str | None = None,
                 ts_col: str = "ts", method: str = "auto", count_col: str = "count",
                 count_expr: Column | None = None, chunk_panes: int | None = None,
                 first_end: str | None = None) -> DataFrame:
    """Rows per (keys, window): columns ``*keys, window_end, count_col``.

    ``slide=None`` means tumbling. ``count_expr`` counts a column instead of rows (``count(col)`` skips
    NULLs). ``first_end`` names a column with the earliest window end (epoch ms) a row may still count in
    (late rows, see :mod:`tidemark.operators.lateness`). ``method`` is ``auto``, ``expand``, ``delta`` or
    ``direct``; the pane forms need ``slide`` to divide ``size``.
    """
    keys = list(keys)
    size_ms = duration_ms(size)
    slide_ms = duration_ms(slide) if slide else size_ms
    counted = count_expr if count_expr is not None else F.lit(1)
    if method == "direct" or size_ms % slide_ms != 0:
        w = F.window(F.col(ts_col), size, slide) if slide else F.window(F.col(ts_col), size)
        if first_end:
            df = df.select("*", w.alias("w")).filter(F.unix_millis(F.col("w.end")) >= F.col(first_end))
            w = F.col("w")
        return (df.groupBy(w.alias("w"), *keys)
                .agg(F.count(counted).alias(count_col))
                .select(*keys, F.unix_millis(F.col("w.end")).alias("window_end"), count_col))
    n = size_ms // slide_ms
    pane = F.floor(event_ms(ts_col) / slide_ms).cast("long")
    # A row counts for the window ends start + 1 .. pane + n, in slides.
    start = (F.floor(F.col(first_end) / slide_ms) - 1).cast("long") if first_end else pane
    # Without count_expr every row counts, so one number serves as both.
    sums = {"_rows": F.count(F.lit(1))} if count_expr is None else {
        "_rows": F.count(F.lit(1)), "_vals": F.count(counted)}
    panes = (df.select("*", pane.alias("_pane"), start.alias("_start"))
             .filter(F.col("_start") < F.col("_pane") + n)
             .groupBy(*keys, "_pane", "_start").agg(*[v.alias(k) for k, v in sums.items()]))
    result = "_vals" if count_expr is not None else "_rows"
    if n == 1 and not first_end:
        return panes.select(*keys, ((F.col("_pane") + 1) * slide_ms).alias("window_end"),
                            F.col(result).alias(count_col))
    if method == "expand" or (method == "auto" and n <= EXPAND_MAX):
        ends = panes.select(*keys, result, F.explode(F.sequence(F.col("_start") + 1, F.col("_pane") + n)).alias("_end"))
        return (ends.groupBy(*keys, "_end").agg(F.sum(result).alias(count_col))
                .select(*keys, (F.col("_end") * slide_ms).alias("window_end"), count_col))
    deltas = (panes.select(*keys, F.inline(F.array(
        F.struct(F.col("_start").alias("_pos"), *[F.col(c) for c in sums]),
        F.struct((F.col("_pane") + n).alias("_pos"), *[(-F.col(c)).alias(c) for c in sums]))))
        .groupBy(*keys, "_pos").agg(*[F.sum(c).alias(c) for c in sums])
        .filter(" or ".join(f"{c} <> 0" for c in sums)))
    chunk_panes = chunk_panes or max(n * 8, 1024)
    run = deltas.withColumn("_chunk", F.floor(F.col("_pos") / chunk_panes).cast("long"))
    run = seq.running_sum(run, keys, ["_pos"], "_chunk", "_rows", out="_level", next_of="_pos")
    if count_expr is not None:
        run = seq.running_sum(run, keys, ["_pos"], "_chunk", "_vals", out="_value")
    # A level holds for the window ends (pos + 1 .. next pos) in slides; the last position always has level 0.
    return (run.filter(F.col("_level") > 0)
            .select(*keys, F.col("_value" if count_expr is not None else "_level").alias(count_col),
                    F.explode(F.sequence(F.col("_pos") + 1, F.col("next__pos"))).alias("_end"))
            .select(*keys, (F.col("_end") * slide_ms).alias("window_end"), count_col))
