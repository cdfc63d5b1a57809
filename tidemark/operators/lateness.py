"""Event-time lateness: the watermark each row meets on arrival, and which windows still accept it.

Watermark before row i = (max event time over rows that arrived before i) - bound. A window ending at e
drops the row when ``e - 1 + lateness <= watermark``; a row that every one of its windows drops is a
late row (a side output).

:func:`watermark_before` gives the watermark itself, ordering every row within its arrival chunk.
:func:`open_ends` gives only what windows need of it, and nearly always from maxima of blocks of arrivals: the
watermark of a row lies between the maximum before its block and the maximum with its block, and where
both leave the same windows open the row is decided without looking at its neighbours. Blocks that are short beside
the slide nearly all are; a sparse log, whose blocks span many slides, is ordered block by block.

Defined cases: a row with a NULL ``seq`` has no place in the arrivals; it meets no watermark in :func:`open_ends` (all
its windows are open), and does not come out of :func:`watermark_before`. A NULL time raises no watermark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms
from tidemark.operators.sequence import BROADCAST_ROWS, arrival_chunk, running_agg
from tidemark.session import materialize, shuffled

#: Arrivals per block; an open block is ordered as a whole.
BLOCK = 256
#: Blocks per block of the next level, where the prefix of the maxima is taken.
FANOUT = 1024


def watermark_before(df: DataFrame, ts_ms: str, bound: str | int, seq_col: str = "seq",
                     out: str = "watermark", rows_per_chunk: int = 1 << 16) -> DataFrame:
    """Add ``out``: watermark (epoch ms) at the arrival of each row; NULL for the first row."""
    bound_ms = duration_ms(bound)
    df = df.withColumn("_wchunk", arrival_chunk(seq_col, rows_per_chunk))
    marked = running_agg(df, [], [seq_col], "_wchunk", ts_ms, "_maxbefore", agg="max", inclusive=False)
    return marked.withColumn(out, F.col("_maxbefore") - bound_ms).drop("_wchunk", "_maxbefore")


def first_open_end(ts_ms: str, watermark: str, size: str, slide: str, lateness: str | int) -> Column:
    """Earliest window end (epoch ms) that still takes the row; beyond the row's last window if none."""
    slide_ms, lateness_ms = duration_ms(slide), duration_ms(lateness)
    first = (F.floor(F.col(ts_ms) / slide_ms) + 1) * slide_ms
    open_from = F.ceil((F.col(watermark) - lateness_ms + 2) / slide_ms) * slide_ms
    return F.greatest(first, F.coalesce(open_from, first)).cast("long")


def last_end(ts_ms: str, size: str, slide: str) -> Column:
    slide_ms, size_ms = duration_ms(slide), duration_ms(size)
    return (F.floor(F.col(ts_ms) / slide_ms) * slide_ms + size_ms).cast("long")


def _prefix(maxima: DataFrame, last: int) -> DataFrame:
    """(_at, _low, _high): the maximum of all blocks before each block (_at, _max), and that with its own. Blocks are put
    together in blocks of ``FANOUT``, level by level, so that no window holds more than that many of them."""
    def around(by, over):
        before = Window.partitionBy(by).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        return over.withColumn("_in", F.max("_max").over(before))

    if last < FANOUT:
        return around(F.lit(0), maxima).select("_at", F.col("_in").alias("_low"), F.greatest("_in", "_max").alias("_high"))
    grouped = maxima.withColumn("_up", F.floor(F.col("_at") / FANOUT).cast("long"))
    up = _prefix(grouped.groupBy(F.col("_up").alias("_at")).agg(F.max("_max").alias("_max")), last // FANOUT)
    return (around("_up", grouped).join(up.select(F.col("_at").alias("_up"), F.col("_low").alias("_before")), "_up")
            .select("_at", F.greatest("_before", "_in").alias("_low"), F.greatest("_before", "_in", "_max").alias("_high")))


def open_ends(df: DataFrame, ts_ms: str, size: str, slide: str, bound: str | int, ends: Mapping[str, str | int],
              seq_col: str = "seq", wanted: Column | None = None, block: int = BLOCK,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The ``wanted`` rows (all by default) with a column per entry of ``ends`` (name: lateness): the earliest window end
    that still takes the row (:func:`first_open_end`). The watermark follows every row of ``df``, wanted or not.

    The maximum of every ``block`` arrivals is aggregated and written once, with the least time of its wanted rows: where the
    bounds before and after the block leave that row the same windows, all its rows are decided by either. The other blocks
    are *open*: only their rows are ordered. Up to ``broadcast_rows`` blocks the table is broadcast and the log is read twice
    more at most, without a shuffle but for open blocks. Beyond, rows first meet the bounds of blocks so wide that
    the table can be broadcast; only what those leave undecided, late rows near the limit, meets the small blocks.
    """
    bound_ms, cols = duration_ms(bound), df.columns
    wanted = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    at = lambda width: F.floor(F.col(seq_col) / F.lit(width)).cast("long")

    def by(watermark: str, ts: str = ts_ms) -> dict[str, Column]:
        return {name: first_open_end(ts, watermark, size, slide, late) for name, late in ends.items()}

    def apart(ts: str = ts_ms) -> Column:
        out = F.lit(False)
        for low, high in zip(by("_low", ts).values(), by("_high", ts).values()):
            out = out | ~low.eqNullSafe(high)
        return out

    def decided(rows: DataFrame, *more: Column) -> DataFrame:
        return rows.select(*cols, *[c.alias(name) for name, c in by("_high").items()], *more)

    # a wanted row without a time counts as the earliest
    least = F.min(F.when(wanted, F.coalesce(F.col(ts_ms), F.lit(-(1 << 62)))))
    blocks = materialize(df.groupBy(at(block).alias("_at")).agg(F.max(ts_ms).alias("_max"), least.alias("_min")), "block-maxima")
    last, unplaced = blocks.agg(F.coalesce(F.max("_at"), F.lit(0)), F.count_if(F.col("_at").isNull())).first()
    blocks = blocks.filter("_at is not null")
    bounds = _prefix(blocks.select("_at", "_max"), last).select("_at", *[(F.col(c) - bound_ms).alias(c) for c in ("_low", "_high")])
    small = materialize(blocks.select("_at", "_min").join(shuffled(bounds), "_at").select(
        "_at", "_low", "_high", (apart("_min") & F.col("_min").isNotNull()).alias("_open")), "block-bounds")
    states = {r["_open"]: r["n"] for r in small.groupBy("_open").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = max(1, -(-(last + 1) // broadcast_rows))  # small blocks in a wide one
    rows = df.filter(wanted)
    parts = []
    if per == 1:
        if states.get(False) or unplaced or not states:
            met = rows.withColumn("_at", at(block)).join(F.broadcast(small), "_at", "left")
            parts = [decided(met.filter("_open is null or not _open"))]
    else:
        wide = small.groupBy(F.floor(F.col("_at") / per).cast("long").alias("_at")).agg(
            F.min_by("_low", "_at").alias("_low"), F.max("_high").alias("_high"))
        marked = materialize(decided(rows.withColumn("_at", at(block * per)).join(F.broadcast(wide), "_at", "left"),
                                     apart().alias("_undecided")), "wide-ends")
        left = marked.filter("_undecided").select(*cols)
        parts = [marked.filter("not _undecided").drop("_undecided"),
                 decided(left.withColumn("_at", at(block)).join(shuffled(small.filter("not _open")), "_at"))]
    if states.get(True):
        mine = small.filter("_open").drop("_open")
        mine = F.broadcast(mine) if states[True] <= broadcast_rows else shuffled(mine)
        before = Window.partitionBy("_at").orderBy(seq_col).rowsBetween(Window.unboundedPreceding, -1)
        exact = (df.withColumn("_at", at(block)).join(mine, "_at")
                 .withColumn("_wm", F.greatest(F.col("_low"), F.max(ts_ms).over(before) - bound_ms)).filter(wanted))
        if per > 1:  # what the wide blocks decided is there already
            exact = exact.withColumn("_at", at(block * per)).drop("_low", "_high").join(F.broadcast(wide), "_at").filter(apart())
        parts.append(exact.select(*cols, *[c.alias(name) for name, c in by("_wm").items()]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_late(df: DataFrame, ts_ms: str, size: str, slide: str, bound: str | int = 0,
               lateness: str | int = 0, seq_col: str = "seq", watermark: str | None = None,
               wanted: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(on_time, late): the ``wanted`` rows (all by default) with ``first_end`` (earliest window end still open) that some
    window accepts, and those that every window drops (with the input columns only).

    ``watermark`` names an existing watermark column; otherwise :func:`open_ends` decides, by ``bound``."""
    if watermark:
        marked = (df if wanted is None else df.filter(wanted)).withColumn(
            "first_end", first_open_end(ts_ms, watermark, size, slide, lateness)).drop(watermark)
    else:
        marked = open_ends(df, ts_ms, size, slide, bound, {"first_end": lateness}, seq_col, wanted)
    end = last_end(ts_ms, size, slide)
    return marked.filter(F.col("first_end") <= end), marked.filter(F.col("first_end") > end).drop("first_end")
