"""Per-key sequence operators that stay parallel when one key holds a large share of the rows.

A window function partitioned by the key alone puts every row of that key in one task. Here each key's rows
are cut into ordered *chunks* (an arrival range, or an event-time bucket), the real work runs per
(key, chunk), and only a small per-chunk summary crosses chunk boundaries:

* :func:`running_sum` / :func:`rank`: chunk totals -> prefix over chunks -> carry added to the in-chunk sum.
* :func:`shift`: lag/lead by up to ``k`` rows; each chunk receives the ``k`` rows just before (or after) it
  as context rows, taken from the last (first) ``k`` rows of every chunk.
* :func:`next_value`: first non-null value strictly after each row (in-chunk, then from later chunks).

The chunk summaries hold at most a few rows per (key, chunk), so their windows partitioned by key are small. With many
sparse keys they are still about as many rows as the input, so they meet the rows in the shuffle that the windows
need anyway and are never broadcast.
``order`` columns must give a total order within a key (add a unique tie-breaker).

NULL is a key value like any other. The operators work on one struct column of the key columns: a struct is
never NULL itself, structs with NULLs in the same places are equal, and the grouping, the windows and the
joins of an operator all hash the same column, so NULL-safety adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, shuffled

Cols = Sequence[str]
KEY = "_seq_key"


def _keyed(df: DataFrame, keys: Cols) -> tuple[DataFrame, list[str]]:
    """``df`` with its key columns packed into one NULL-safe column, and the names to group and join by."""
    return (df.withColumn(KEY, F.struct(*[F.col(k) for k in keys])), [KEY]) if keys else (df, [])


def arrival_chunk(seq_col: str = "seq", rows_per_chunk: int = 1 << 20) -> Column:
    """Chunk by arrival sequence: at most ``rows_per_chunk`` rows of any key per chunk."""
    return F.floor(F.col(seq_col) / F.lit(rows_per_chunk)).cast("long")


def value_chunk(col: str, width: int) -> Column:
    """Chunk by buckets of ``width`` of an ordered numeric column (e.g. epoch seconds: time buckets)."""
    return F.floor(F.col(col) / F.lit(width)).cast("long")


#: Rows up to which the chunk table of heavy keys is broadcast (a few dozen bytes each).
BROADCAST_ROWS = 1 << 18


def balanced_chunk(df: DataFrame, keys: Cols, col: str, bucket: int = 60, target_rows: int = 1 << 20,
                   out: str = "_chunk") -> DataFrame:
    """Add ``out``: chunk ids along an ordered numeric column (e.g. epoch seconds) that hold about
    ``target_rows`` rows of a key each, however busy the key is at any time.

    Keys are counted first (one aggregation, run at once; only its maximum comes back). Where no key has more than
    ``target_rows`` rows, every row is in chunk 0 and nothing is shuffled for it. Rows of heavier keys are
    counted per (key, bucket of ``bucket`` width); consecutive buckets are packed into chunks by the running count of
    the key (its window is bounded by the time span, not by the data). Only a single bucket above the
    target stays one chunk. That table holds heavy keys alone and is broadcast up to ``BROADCAST_ROWS`` rows; a larger
    one is joined to the rows of heavy keys, and the others stay where they are. A NULL in ``col`` is in chunk 0,
    before all others.
    """
    chunked, name = _balanced(df, keys, col, bucket, target_rows, out)
    return chunked if name else chunked.withColumn(out, F.lit(0).cast("long"))


def _balanced(df: DataFrame, keys: Cols, col: str, bucket: int, target_rows: int, out: str) -> tuple[DataFrame, str | None]:
    own = df
    df, keys = _keyed(df, keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    most = per_key.agg(F.max("_cnt")).first()[0] or 0
    if most <= target_rows:
        return own, None
    df = df.withColumn("_bk", F.floor(F.col(col) / bucket).cast("long"))
    heavy = materialize(per_key.filter(F.col("_cnt") > target_rows).select(*keys), "heavy-keys")
    heavy = F.broadcast(heavy) if heavy.count() <= BROADCAST_ROWS else shuffled(heavy)
    busy = df.join(heavy, keys, "left_semi")
    hist = busy.filter(F.col("_bk").isNotNull()).groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    hist = materialize(hist.select(*keys, "_bk", (F.floor(F.coalesce(F.sum("_cnt").over(before), F.lit(0)) / target_rows)
                                                  .cast("long") + 1).alias("_at")), "chunks")
    if hist.count() <= BROADCAST_ROWS:
        df = df.join(F.broadcast(hist), [*keys, "_bk"], "left")
    else:
        rest = df.join(heavy, keys, "left_anti").withColumn("_at", F.lit(0).cast("long"))
        df = busy.join(shuffled(hist), [*keys, "_bk"], "left").unionByName(rest)
    return df.withColumn(out, F.coalesce("_at", F.lit(0))).drop("_bk", "_at", KEY), out


def chunk_by(df: DataFrame, keys: Cols, col: str, chunking: str = "time", width: int = 3600,
             target_rows: int = 1 << 20, out: str = "_chunk") -> tuple[DataFrame, str | None]:
    """``df`` and the name of its chunk column by event time: ``time`` = fixed buckets of ``width`` (no extra pass;
    rows per chunk bounded by the key's rate times the width), ``balanced`` = :func:`balanced_chunk` (bounded
    rows however bursty a key is, for one more aggregation). The name is None where no key needs cutting: the operators
    below then work per key, in a single shuffle."""
    if chunking == "balanced":
        return _balanced(df, keys, col, 60, target_rows, out)
    return df.withColumn(out, value_chunk(col, width)), out


def _order(order: Cols, descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


_AGGS = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}


def _either(a: Column, b: Column, both: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


# NULL-ignoring combination of two partial results
_PICK = {"max": F.greatest, "min": F.least, "sum": lambda a, b: _either(a, b, a + b),
         "xor": lambda a, b: _either(a, b, a.bitwiseXOR(b))}


def _carry(totals: DataFrame, keys: Cols, chunk: str, agg: str, fanout: int = 1024) -> DataFrame:
    """(keys, chunk, _carry): ``agg`` of the chunk totals of all earlier chunks of the key.

    Per key the chunk summary is small (one row per chunk of that key). Without keys (a global running
    value) it grows with the input, so it is itself split in two levels: blocks of ``fanout`` chunks get
    a prefix over block totals (one small ordered partition), and chunks get a prefix inside their block.
    """
    fn = _AGGS[agg]
    if keys:
        before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*keys, chunk, fn("_tot").over(before).alias("_carry"))
    t = totals.withColumn("_blk", F.floor(F.col(chunk) / fanout))
    blocks = t.groupBy("_blk").agg(fn("_tot").alias("_btot"))
    block_carry = blocks.select("_blk", fn("_btot").over(
        Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)).alias("_bcarry"))
    inner = Window.partitionBy("_blk").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    within = t.select("_blk", chunk, fn("_tot").over(inner).alias("_icarry"))
    both = within.join(block_carry, "_blk")
    return both.select(chunk, _PICK[agg](F.col("_bcarry"), F.col("_icarry")).alias("_carry"))


def running_agg(df: DataFrame, keys: Cols, order: Cols, chunk: str | None, value: Column | str, out: str,
                agg: str = "sum", inclusive: bool = True, carry_below: int | None = None,
                next_of: str | None = None) -> DataFrame:
    """Running ``agg`` (sum, max, min or xor) of ``value`` per key along ``order``; ``inclusive=False`` covers
    only the rows strictly before each row (NULL for the first row).

    ``carry_below`` (sums of non-negative values): keep only chunks whose carried-in sum is below this
    bound, since rows of later chunks can only have larger sums; used to stop ranking a key past a
    threshold. ``next_of``: also add ``next_<col>``, the value of that column in the next row of the key (a
    lead across chunk boundaries), computed in the same pass. ``chunk=None``: no key needs cutting.
    """
    fn = _AGGS[agg]
    val = F.col(value) if isinstance(value, str) else value
    df, keys = _keyed(df.withColumn("_v", val), keys)
    if chunk is None:
        by = Window.partitionBy(*keys).orderBy(*_order(order))
        df = df.withColumn(out, fn("_v").over(by.rowsBetween(Window.unboundedPreceding,
                                                            Window.currentRow if inclusive else -1)))
        if next_of:
            df = df.withColumn(f"next_{next_of}", F.lead(next_of).over(by))
        return df.drop("_v", KEY)
    aggs = [fn("_v").alias("_tot")]
    if next_of:
        aggs.append(F.min_by(F.col(next_of), F.struct(*[F.col(c) for c in order])).alias("_head"))
    totals = df.groupBy(*keys, chunk).agg(*aggs)
    carry = _carry(totals, keys, chunk, agg)          # NULL for the first chunk of a key
    if next_of:
        heads = totals.select(*keys, chunk, F.lead("_head").over(
            Window.partitionBy(*keys).orderBy(chunk)).alias("_next_head"))
        carry = carry.join(shuffled(heads), [*keys, chunk])
    if carry_below is not None:
        carry = carry.filter(F.coalesce(F.col("_carry"), F.lit(0)) < carry_below)
    inside = Window.partitionBy(*keys, chunk).orderBy(*_order(order))
    frame = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = fn("_v").over(frame)
    out_df = df.join(shuffled(carry), [*keys, chunk]).withColumn(out, _PICK[agg](F.col("_carry"), local))
    if next_of:
        out_df = out_df.withColumn(f"next_{next_of}",
                                   F.coalesce(F.lead(next_of).over(inside), F.col("_next_head")))
    return out_df.drop("_carry", "_v", "_next_head", KEY)


def running_sum(df: DataFrame, keys: Cols, order: Cols, chunk: str | None, value: Column | str,
                out: str = "running", carry_below: int | None = None,
                next_of: str | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per key along ``order`` (see :func:`running_agg`)."""
    return running_agg(df, keys, order, chunk, value, out, "sum", True, carry_below, next_of)


def rank(df: DataFrame, keys: Cols, order: Cols, chunk: str | None, out: str = "rank",
         carry_below: int | None = None) -> DataFrame:
    """1-based position of each row within its key along ``order`` (a ``row_number``)."""
    return running_sum(df, keys, order, chunk, F.lit(1).cast("long"), out, carry_below)


def shift(df: DataFrame, keys: Cols, order: Cols, chunk: str | None, cols: Cols, k: int,
          direction: str = "prev", prefix: str | None = None) -> DataFrame:
    """Add ``{prefix}{i}_{c}`` for i = 1..k and c in ``cols``: the value of ``c`` in the i-th previous
    (``direction='prev'``, a lag) or next (``'next'``, a lead) row of the same key along ``order``."""
    assert direction in ("prev", "next") and k >= 1
    prefix = prefix or direction
    back = direction == "prev"
    df, keys = _keyed(df, keys)
    if chunk is None:
        by, fn = Window.partitionBy(*keys).orderBy(*_order(order)), F.lag if back else F.lead
        return df.select("*", *[fn(c, i).over(by).alias(f"{prefix}{i}_{c}") for i in range(1, k + 1) for c in cols]).drop(KEY)
    carried = list(dict.fromkeys([*order, *cols]))
    # Edge rows: the last k (prev) or first k (next) rows of every chunk.
    edge_rank = Window.partitionBy(*keys, chunk).orderBy(*_order(order, descending=back))
    edges = df.select(*keys, chunk, *carried).withColumn("_e", F.row_number().over(edge_rank)).filter(
        F.col("_e") <= k)
    # Rows adjacent to a chunk boundary are all edge rows, so a window over edges sees them contiguously.
    along = Window.partitionBy(*keys).orderBy(*_order(order))
    frame = along.rowsBetween(-(k - 1), 0) if back else along.rowsBetween(0, k - 1)
    packed = F.collect_list(F.struct(*[F.col(c) for c in carried])).over(frame)
    by_chunk = Window.partitionBy(*keys).orderBy(chunk)
    target = F.lead(chunk).over(by_chunk) if back else F.lag(chunk).over(by_chunk)
    context = (edges.withColumn("_ctx", packed)
               .filter(F.col("_e") == 1)            # last (first) row of each chunk
               .withColumn("_to", target)           # the next (previous) non-empty chunk
               .filter(F.col("_to").isNotNull())
               .select(*keys, F.col("_to").alias(chunk), F.inline("_ctx"))
               .withColumn("_is_ctx", F.lit(True)))
    body = df.withColumn("_is_ctx", F.lit(False))
    both = body.unionByName(context, allowMissingColumns=True)
    w = Window.partitionBy(*keys, chunk).orderBy(*_order(order))
    fn = F.lag if back else F.lead
    for i in range(1, k + 1):
        for c in cols:
            both = both.withColumn(f"{prefix}{i}_{c}", fn(F.col(c), i).over(w))
    return both.filter(~F.col("_is_ctx")).drop("_is_ctx", KEY)


def next_value(df: DataFrame, keys: Cols, order: Cols, chunk: str | None, value: Column | str,
               out: str = "next_value") -> DataFrame:
    """First non-null ``value`` in a row strictly after each row of the same key along ``order``.

    Frames are written over the reversed order as ``UNBOUNDED PRECEDING .. 1 PRECEDING`` with
    ``last(ignorenulls)``: a growing frame is evaluated incrementally, whereas a frame ending at
    ``UNBOUNDED FOLLOWING`` is re-aggregated for every row (quadratic in the partition size).
    """
    val = F.col(value) if isinstance(value, str) else value
    df, keys = _keyed(df.withColumn("_v", val), keys)
    after = Window.partitionBy(*keys, *([chunk] if chunk else [])).orderBy(*_order(order, descending=True)).rowsBetween(
        Window.unboundedPreceding, -1)
    if chunk is None:
        return df.withColumn(out, F.last("_v", ignorenulls=True).over(after)).drop("_v", KEY)
    order_key = F.struct(*[F.col(c) for c in order])
    firsts = (df.filter(F.col("_v").isNotNull()).groupBy(*keys, chunk)
              .agg(F.min_by("_v", order_key).alias("_first")))
    chunks = df.select(*keys, chunk).distinct().join(shuffled(firsts), [*keys, chunk], "left")
    later = Window.partitionBy(*keys).orderBy(F.col(chunk).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(*keys, chunk, F.last("_first", ignorenulls=True).over(later).alias("_later"))
    return (df.join(shuffled(carry), [*keys, chunk])
            .withColumn(out, F.coalesce(F.last("_v", ignorenulls=True).over(after), F.col("_later")))
            .drop("_v", "_later", KEY))


def running_clamp(df: DataFrame, keys: Cols, order: str, low: str, high: str, out: str, start: int = 0,
                  block: int = 256, longest: int | None = None) -> DataFrame:
    """Add ``out``: the value y *before* each row of a key, where y begins at ``start`` and each row, in the order of
    ``order`` (1, 2, 3 .. per key), makes it min(high, max(low, y)).

    Such steps compose to steps of the same form, so they are folded in a tree: rows are folded per block of ``block``
    of a key, blocks per block of blocks, as often as the longest key needs it (one level where no key is longer than
    a block; the length of the ``longest`` is looked up first where it is not given), and the values at the beginning of each block come back down. An array
    holds one block at most, whatever the key.
    """
    df, keys = _keyed(df, keys)
    longest = (df.agg(F.max(order)).first()[0] or 0) if longest is None else longest
    own = df.select(*keys, F.col(order).alias("_i"), F.col(low).alias("_lo"), F.col(high).alias("_hi"))

    def blocks(steps: DataFrame) -> DataFrame:
        return steps.groupBy(*keys, F.floor((F.col("_i") - 1) / block).alias("_b")).agg(
            F.array_sort(F.collect_list(F.struct("_i", "_lo", "_hi"))).alias("_steps"))

    def apply(step: Column, y: Column) -> Column:
        return F.least(step["_hi"], F.greatest(step["_lo"], y))

    levels = [blocks(own)]
    while longest > block:
        # the fold of a block as one step; a step whose bounds cross gives its upper one
        lowest, highest = F.lit(-(1 << 62)).cast("long"), F.lit(1 << 62).cast("long")
        folded = F.aggregate("_steps", F.struct(lowest.alias("_lo"), highest.alias("_hi")), lambda a, s: F.struct(
            apply(s, a["_lo"]).alias("_lo"), apply(s, a["_hi"]).alias("_hi")))
        up = levels[-1].withColumn("_f", folded).select(*keys, (F.col("_b") + 1).alias("_i"), "_f._lo", "_f._hi")
        levels[-1] = materialize(levels[-1], "clamp-blocks")
        levels.append(blocks(up))
        longest = -(-longest // block)
    y = None
    for level in reversed(levels):
        if y is None:
            begun = level.withColumn("_y", F.lit(start).cast("long"))
        else:
            begun = level.join(y.select(*keys, (F.col("_i") - 1).alias("_b"), "_y"), [*keys, "_b"])
        # the value before each step of the block
        run = F.aggregate("_steps", F.struct(F.array().cast("array<bigint>").alias("ys"), F.col("_y").alias("y")),
                          lambda a, s: F.struct(F.concat(a["ys"], F.array(a["y"])).alias("ys"), apply(s, a["y"]).alias("y")))
        y = begun.select(*keys, "_steps", run["ys"].alias("_ys")).select(
            *keys, F.inline(F.arrays_zip(F.col("_steps._i").alias("_i"), F.col("_ys").alias("_y"))))
    found = y.select(*keys, F.col("_i").alias(order), F.col("_y").alias(out))
    return df.join(found, [*keys, order]).drop(KEY)


def greedy_starts(points: DataFrame, key: str, index: str, time: str, length: int, rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(key, index, next): the points of a key that begin a period: its first, then the first point at or after a
    start's time + ``length``, and so on; ``next`` is the index of the next start, NULL after the last.

    ``index`` is 0, 1, 2 .. along ``time``. The starts are the orbit of point 0 under next(i) = the first point at or after
    t_i + length, which a chunked next-value lookup finds for every point. The orbit is built by pointer doubling:
    O(log n) rounds of joins on (key, index), each written to the shared checkpoint folder to cut the lineage. A round
    writes the starts that it adds and the jumps that stay inside their key, so the loop ends when none are left. Starts and
    jumps grow with the points: their joins are by a shuffle, never a broadcast."""
    none = F.lit(None).cast("long")
    probes = points.select(key, (F.col(time) + length).alias(time), F.lit(0).alias("_kind"), F.col(index).alias("_src"),
                           none.alias("_val"))
    data = points.select(key, time, F.lit(1).alias("_kind"), F.col(index).alias("_src"), F.col(index).alias("_val"))
    both, chunk = chunk_by(probes.unionByName(data), [key], time, "balanced", target_rows=rows_per_chunk)
    nxt = materialize(next_value(both, [key], [time, "_kind", "_src"], chunk, "_val", out="next")
                      .filter(F.col("_kind") == 0).select(key, F.col("_src").alias(index), "next"), "greedy-next")
    # starts holds the jumps 0 .. 2^k - 1 from index 0, jumps the 2^k-th successors
    starts = nxt.filter(F.col(index) == 0).select(key, index)
    jumps = nxt.filter(F.col("next").isNotNull())
    while not jumps.isEmpty():
        starts = starts.unionByName(materialize(
            starts.join(shuffled(jumps), [key, index]).select(key, F.col("next").alias(index)), "greedy-starts"))
        hop = jumps.select(key, F.col(index).alias("next"), F.col("next").alias("_q"))
        jumps = materialize(jumps.join(shuffled(hop), [key, "next"]).select(key, index, F.col("_q").alias("next")), "greedy-jumps")
    return starts.join(shuffled(nxt), [key, index])
