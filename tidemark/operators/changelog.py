"""How window results come about: the changes of a ranking from epoch to epoch, and the firings of a window.

* :func:`running_ranks`: the top n of every open window after each epoch. Epochs are as long as the slide; an epoch is
  named by its end, and a window takes part from its first epoch to its own end.
* :func:`ranking_changes`: the retract stream of such rankings. A row that no longer holds its rank is retracted and the
  one that takes its place is inserted; what stays as it is emits nothing, so folding the changes up to an epoch gives
  the rankings after it, and folding all of them the final ones.
* :func:`window_firings`: a window fires when the watermark passes its end, and again for every late row that it
  still takes; each firing with the count so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import duration_ms
from tidemark.operators import sequence as seq
from tidemark.operators.lateness import last_end, open_ends
from tidemark.operators.topn import top_n
from tidemark.operators.windows import event_ms, window_count
from tidemark.session import materialize, shuffled


def running_ranks(df: DataFrame, id_col: str, n: int, size: str, slide: str, ts_col: str = "ts") -> DataFrame:
    """(window_end, epoch, rank, id, cnt): the n ids with most rows so far (ties by id), per window and epoch.

    Rows are counted per (id, pane) first. A window's count of an id only changes at the id's panes, so it is kept as an
    interval: valid from the epoch of one pane to that of the next. An interval is listed once per epoch that it is
    valid in, size / slide at most, and of those rows each task keeps the n best of a window and epoch before the
    shuffle, so what is shuffled follows the rankings and not the ids. The sum along a window's panes has size / slide
    rows at most. ``slide`` must divide ``size``."""
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    assert size_ms % slide_ms == 0
    k = size_ms // slide_ms
    panes = (df.select(F.col(id_col), F.floor(event_ms(ts_col) / slide_ms).cast("long").alias("_pane"))
             .filter("_pane is not null").groupBy(id_col, "_pane").agg(F.count(F.lit(1)).alias("_n")))
    # epochs and windows are numbered by their ends, in slides
    own = panes.select(id_col, (F.col("_pane") + 1).alias("_from"), "_n",
                       F.explode(F.sequence(F.col("_pane") + 1, F.col("_pane") + k)).alias("_window"))
    along = Window.partitionBy(F.struct(id_col), "_window").orderBy("_from")
    until = F.coalesce(F.lead("_from").over(along) - 1, F.col("_window"))
    counts = own.select(id_col, "_window", "_from", until.alias("_until"), F.sum("_n").over(along).alias("cnt"))
    listed = counts.select(id_col, (F.col("_window") * slide_ms).alias("window_end"), "cnt",
                           F.explode(F.sequence("_from", "_until")).alias("_epoch")).withColumn(
        "epoch", F.col("_epoch") * slide_ms).drop("_epoch")
    return top_n(listed, n, ("window_end", "epoch"), id_col=id_col).select("window_end", "epoch", "rank", id_col, "cnt")


def ranking_changes(ranks: DataFrame, id_col: str) -> DataFrame:
    """(op, epoch, window_end, rank, id, cnt): ``op`` true inserts and false retracts. ``ranks`` as of
    :func:`running_ranks`, where a rank once held is held by someone at every later epoch of the window."""
    along = Window.partitionBy("window_end", "rank").orderBy("epoch")
    was = F.lag(F.struct(F.col(id_col), F.col("cnt"))).over(along)
    now = F.struct(F.col(id_col), F.col("cnt"))
    step = ranks.withColumn("_was", was).filter(F.col("_was").isNull() | ~F.col("_was").eqNullSafe(now))
    change = F.array_compact(F.array(
        F.when(F.col("_was").isNotNull(), F.struct(F.lit(False).alias("op"), F.col(f"_was.{id_col}").alias(id_col), F.col("_was.cnt").alias("cnt"))),
        F.struct(F.lit(True).alias("op"), F.col(id_col).alias(id_col), F.col("cnt").alias("cnt"))))
    return step.select("epoch", "window_end", "rank", F.inline(change)).select("op", "epoch", "window_end", "rank", id_col, "cnt")


def rankings_at(changes: DataFrame, id_col: str, epoch: int | None = None) -> DataFrame:
    """(window_end, rank, id, cnt): the changes up to ``epoch`` (None: all) folded to the rankings that hold then."""
    past = changes if epoch is None else changes.filter(F.col("epoch") <= epoch)
    return (past.groupBy("window_end", "rank", id_col, "cnt").agg(F.sum(F.when(F.col("op"), 1).otherwise(-1)).alias("_held"))
            .filter("_held > 0").drop("_held"))


def window_firings(df: DataFrame, keys: Sequence[str], ts_ms: str, size: str, slide: str, bound: str | int,
                   lateness: str | int, seq_col: str = "seq", wanted: Column | None = None,
                   rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(*keys, window_end, firing, cnt): firing 1, 2, 3 .. of each window of a key.

    A row counts for a window before its first firing if the watermark that it meets on arrival is below the window's
    end; a later row, as long as the window is kept (end + ``lateness``), is a firing of its own, in the order of
    ``seq_col``. A window with late rows only has its first firing at the first of them. Only ``wanted`` rows are counted, but
    the watermark follows every row of ``df``.

    The first firings are window counts over panes. Only the late rows are listed per window, lateness / slide at most
    for each; they are numbered per key and window, in chunks of arrival. The first firings, size / slide for a row, are met by
    a shuffle: they are by far the largest table here, and the planner takes them for as small as the rows' files."""
    keys = list(keys)
    slide_ms = duration_ms(slide)
    marked = open_ends(df, ts_ms, size, slide, bound, {"_on_time": 0, "_kept": lateness}, seq_col, wanted)
    marked = materialize(marked.select(*dict.fromkeys([*keys, ts_ms, seq_col]), "_on_time", "_kept",
                                       last_end(ts_ms, size, slide).alias("_end")), "firing-rows")
    first = window_count(marked.filter("_on_time <= _end").withColumn("_ts", F.timestamp_millis(ts_ms)), keys, size, slide,
                         ts_col="_ts", count_col="_first", first_end="_on_time")
    late = (marked.filter((F.col("_kept") < F.col("_on_time")) & (F.col("_kept") <= F.col("_end")))
            .select(*keys, seq_col, F.explode(F.sequence("_kept", F.least(F.col("_on_time") - slide_ms, F.col("_end")),
                                                         F.lit(slide_ms).cast("long"))).alias("window_end"))
            .withColumn("_chunk", seq.arrival_chunk(seq_col, rows_per_chunk)))
    late = seq.rank(late, [*keys, "window_end"], [seq_col], "_chunk", out="_late").drop("_chunk", seq_col)
    key = F.struct(*keys, "window_end").alias("_k")
    again = late.select(key, "_late").join(shuffled(first.select(key, "_first")), "_k", "left").select(
        *[F.col(f"_k.{c}").alias(c) for c in [*keys, "window_end"]],
        (F.col("_late") + F.when(F.col("_first").isNotNull(), 1).otherwise(0)).alias("firing"),
        (F.col("_late") + F.coalesce("_first", F.lit(0))).alias("cnt"))
    return first.select(*keys, "window_end", F.lit(1).cast("long").alias("firing"), F.col("_first").alias("cnt")).unionByName(again)
