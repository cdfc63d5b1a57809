"""Joins: dimension lookups, the pay/receipt interval join and two-stream reconciliation with residuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import sequence as seq
from tidemark.session import materialize

# Bytes up to which a dimension is broadcast (by the optimizer's own estimate of its size).
DIMENSION_MAX_BYTES = 32 << 20


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_bytes: int = DIMENSION_MAX_BYTES) -> DataFrame:
    """Join a fact table to a dimension, broadcasting the dimension if its estimated size is within the bound.

    The size comes from the plan's statistics (file sizes), so no job runs while the plan is built. Above the
    bound the join is left to the planner (sort-merge, or a broadcast that AQE picks from runtime sizes).
    """
    size = int(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return fact.join(F.broadcast(dim) if size <= max_bytes else dim, on, how)


def pays_of(orders: DataFrame) -> DataFrame:
    """Order events that carry a transaction id (the pay events)."""
    return orders.filter(F.col("tx_id") != "")


def interval_join(pays: DataFrame, receipts: DataFrame, lower_s: int = -3, upper_s: int = 5,
                  bucket_s: int | None = None) -> DataFrame:
    """Every (pay, receipt) pair with equal tx id and ``pay.ts + lower <= receipt.ts <= pay.ts + upper``.

    Equi-key is (tx_id, time bucket as wide as the interval): a receipt sits in one bucket, a pay probes the
    (at most two) buckets its interval touches, so a busy tx id only meets receipts near each pay in time.
    Output: order_id, tx_id, pay_time, pay_channel, receipt_time (epoch s).
    """
    bucket_s = bucket_s or max(upper_s - lower_s, 1)
    assert bucket_s >= upper_s - lower_s
    r = receipts.select("tx_id", "pay_channel", F.col("timestamp").alias("receipt_time"),
                        F.floor(F.col("timestamp") / bucket_s).alias("_b"))
    probes = F.array_distinct(F.array(F.floor((F.col("timestamp") + lower_s) / bucket_s),
                                      F.floor((F.col("timestamp") + upper_s) / bucket_s)))
    p = pays.select("order_id", "tx_id", F.col("timestamp").alias("pay_time"), F.explode(probes).alias("_b"))
    cond = [p.tx_id == r.tx_id, p._b == r._b,
            r.receipt_time >= p.pay_time + lower_s, r.receipt_time <= p.pay_time + upper_s]
    return p.join(r, cond).select(p.order_id, p.tx_id, p.pay_time, r.pay_channel, r.receipt_time)


# Output tags of the reconciliation.
MATCHED = "matched-pays"
UNMATCHED_PAYS = "unmatched-pays"
UNMATCHED_RECEIPTS = "unmatched-receipts"


def pair_waiting(pays: list[tuple], receipts: list[tuple], pay_wait: int, receipt_wait: int) -> list[tuple]:
    """Pairs of (pay, receipt), either None, from two lists of (time, ...) sorted by time.

    A pay waits until time + pay_wait for a receipt and a receipt until time + receipt_wait for a pay; a row
    that comes takes the one that has waited longest. As neither side waits while the other does, both lists
    can be walked side by side: of the two heads, one that is too old for the other will never be taken."""
    out, i, j = [], 0, 0
    while i < len(pays) and j < len(receipts):
        p, r = pays[i][0], receipts[j][0]
        if r > p + pay_wait:
            out.append((pays[i], None))
            i += 1
        elif p > r + receipt_wait:
            out.append((None, receipts[j]))
            j += 1
        else:
            out.append((pays[i], receipts[j]))
            i, j = i + 1, j + 1
    return out + [(p, None) for p in pays[i:]] + [(None, r) for r in receipts[j:]]


def _paired_by_waiting(pays: DataFrame, receipts: DataFrame, pay_wait_s: int, receipt_wait_s: int, chunking: str,
                       rows_per_chunk: int) -> DataFrame:
    """One row per pair or single: tx_id, order_id, pay_time, pay_channel, receipt_time."""
    none = F.lit(None)
    events = (pays.select("tx_id", F.col("timestamp").alias("t"), F.lit(0).alias("side"), "order_id",
                          none.cast("string").alias("pay_channel"))
              .unionByName(receipts.select("tx_id", F.col("timestamp").alias("t"), F.lit(1).alias("side"),
                                           none.cast("long").alias("order_id"), "pay_channel")))
    pay, receipt = F.col("side") == 0, F.col("side") == 1
    per = events.groupBy("tx_id").agg(
        F.count(F.when(pay, 1)).alias("_np"), F.count(F.when(receipt, 1)).alias("_nr"),
        F.max(F.when(pay, F.struct("t", "order_id"))).alias("p"),
        F.max(F.when(receipt, F.struct("t", "pay_channel"))).alias("r"))
    # almost every tx id has at most one row of either side
    simple = (F.col("_np") <= 1) & (F.col("_nr") <= 1)
    near = (F.col("r.t") <= F.col("p.t") + pay_wait_s) & (F.col("p.t") <= F.col("r.t") + receipt_wait_s)
    apart = F.col("p").isNotNull() & F.col("r").isNotNull() & ~near
    sides = F.when(apart, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(-1)))
    split = per.filter(simple).select("tx_id", F.explode(sides).alias("_side"), "p", "r")
    split = (split.withColumn("p", F.when(F.col("_side") != 1, F.col("p")))
             .withColumn("r", F.when(F.col("_side") != 0, F.col("r")))
             .select("tx_id", F.col("p.order_id").alias("order_id"), F.col("p.t").alias("pay_time"),
                     F.col("r.pay_channel").alias("pay_channel"), F.col("r.t").alias("receipt_time")))

    most = per.agg(F.max("_np"), F.max("_nr")).first()
    n_pays, n_receipts = most[0] or 0, most[1] or 0
    if n_pays <= 1 and n_receipts <= 1:
        return split
    busy = per.filter(~simple).select(F.col("tx_id").alias("_busy"))
    rows = materialize(events.join(busy, F.col("tx_id").eqNullSafe(F.col("_busy")), "left_semi"), "busy-tx")

    def chunked(df: DataFrame) -> tuple[DataFrame, str | None]:
        if chunking == "balanced" and 2 * n_pays + n_receipts <= rows_per_chunk:
            return df, None
        return seq.chunk_by(df, ["tx_id"], "t", chunking, target_rows=rows_per_chunk)

    return split.unionByName(_matched(rows.filter(pay), rows.filter(receipt), pay_wait_s, receipt_wait_s, chunked, n_pays))


def _matched(pays: DataFrame, receipts: DataFrame, pay_wait_s: int, receipt_wait_s: int, chunked, n_pays: int) -> DataFrame:
    """The rule of :func:`pair_waiting` for tx ids with any number of rows, without walking through them.

    Both sides are numbered 1, 2, 3 .. per tx id. Of the i-th pay, let L be the number of receipts too old for it and U
    the number that come before its wait ends (a running count of receipts, asked at both times). With x receipts done
    with before it, it takes receipt max(x, L) + 1 if that is at most U, and x becomes that number; else it stays
    alone and x becomes max(x, L), which then is U. So x - i becomes min(U - i, max(L + 1 - i, its value before)): a
    running clamp (:func:`tidemark.operators.sequence.running_clamp`), which is cut into blocks and folded in parallel
    however many rows a tx id has and however closely they follow each other. ``chunked`` cuts busy tx ids along time."""
    p, chunk = chunked(pays.select("tx_id", "t", "order_id"))
    p = seq.rank(p, ["tx_id"], ["t", "order_id"], chunk, out="_i").drop("_chunk")
    r, chunk = chunked(receipts.select("tx_id", "t", "pay_channel"))
    r = seq.rank(r, ["tx_id"], ["t", "pay_channel"], chunk, out="_j").drop("_chunk")
    none = F.lit(None).cast("long")
    # at the same time, a question for the receipts before it comes first, and one for those up to it last
    asked = p.select("tx_id", F.explode(F.array(
        F.struct((F.col("t") - receipt_wait_s).alias("t"), F.lit(0).alias("_what"), F.col("_i").alias("_n")),
        F.struct((F.col("t") + pay_wait_s).alias("t"), F.lit(2).alias("_what"), F.col("_i").alias("_n")))).alias("_q")).select("tx_id", "_q.*")
    line = asked.unionByName(r.select("tx_id", "t", F.lit(1).alias("_what"), F.col("_j").alias("_n")))
    line, chunk = chunked(line)
    line = seq.running_sum(line, ["tx_id"], ["t", "_what", "_n"], chunk, (F.col("_what") == 1).cast("long"), out="_seen")
    key = F.struct("tx_id", F.col("_n").alias("_i")).alias("_k")
    bounds = line.filter("_what <> 1").groupBy(key).agg(
        F.max(F.when(F.col("_what") == 0, F.col("_seen"))).alias("_l"), F.max(F.when(F.col("_what") == 2, F.col("_seen"))).alias("_u"))
    p = p.withColumn("_k", F.struct("tx_id", "_i")).join(bounds, "_k").drop("_k")
    p = p.withColumn("_lo", F.col("_l") + 1 - F.col("_i")).withColumn("_hi", F.col("_u") - F.col("_i"))
    p = seq.running_clamp(p, ["tx_id"], "_i", "_lo", "_hi", "_y", longest=n_pays)
    first = F.greatest(F.col("_y") + F.col("_i") - 1, F.col("_l"))
    p = p.select(F.struct("tx_id", F.when(first < F.col("_u"), first + 1).alias("_j"),
                          # a pay alone is a key of its own
                          F.when(first >= F.col("_u"), F.col("_i")).alias("_i")).alias("_k"),
                 "order_id", F.col("t").alias("pay_time"))
    r = r.select(F.struct("tx_id", "_j", none.alias("_i")).alias("_k"), "pay_channel", F.col("t").alias("receipt_time"))
    return p.join(r, "_k", "full_outer").select(F.col("_k.tx_id").alias("tx_id"), "order_id", "pay_time", "pay_channel", "receipt_time")


def _paired_by_rank(pays: DataFrame, receipts: DataFrame, chunking: str, rows_per_chunk: int) -> DataFrame:
    """The n-th pay of a tx id with its n-th receipt: tx_id, order_id, pay_time, pay_channel, receipt_time."""
    p = pays.select("order_id", "tx_id", F.col("timestamp").alias("pay_time"))
    p, chunk = seq.chunk_by(p, ["tx_id"], "pay_time", chunking, target_rows=rows_per_chunk)
    p = seq.rank(p, ["tx_id"], ["pay_time", "order_id"], chunk, out="_n").drop("_chunk")
    r = receipts.select("tx_id", "pay_channel", F.col("timestamp").alias("receipt_time"))
    r, chunk = seq.chunk_by(r, ["tx_id"], "receipt_time", chunking, target_rows=rows_per_chunk)
    r = seq.rank(r, ["tx_id"], ["receipt_time", "pay_channel"], chunk, out="_n").drop("_chunk")
    key = F.struct("tx_id", "_n")
    j = p.withColumn("_k", key).drop("tx_id", "_n").join(r.withColumn("_k", key).drop("tx_id", "_n"), "_k", "full_outer")
    return j.withColumn("tx_id", F.col("_k.tx_id"))


def reconcile(pays: DataFrame, receipts: DataFrame, mode: str = "interval", pay_wait_s: int = 5,
              receipt_wait_s: int = 3, chunking: str = "balanced", rows_per_chunk: int = 1 << 20) -> DataFrame:
    """Pair pays and receipts one to one per tx id, keeping the unmatched rows of both sides.

    ``mode='interval'``: in event time a pay waits ``pay_wait`` seconds for a receipt and a receipt
    ``receipt_wait`` seconds for a pay (both inclusive); whichever comes takes the one that has waited
    longest, and a row whose wait ends is unmatched. A tx id with one row of either side is decided in an
    aggregation, those of others by counting and a running clamp (see ``_matched``).

    ``mode='key'`` pairs the n-th pay of a tx id with its n-th receipt, however far apart (a bounded replay
    where each side waits for the other). A NULL tx id is a key like any other.

    Output columns: tag, order_id, tx_id, pay_time, pay_channel, receipt_time.
    """
    assert mode in ("key", "interval")
    j = (_paired_by_rank(pays, receipts, chunking, rows_per_chunk) if mode == "key" else
         _paired_by_waiting(pays, receipts, pay_wait_s, receipt_wait_s, chunking, rows_per_chunk))
    tag = (F.when(F.col("pay_time").isNotNull() & F.col("receipt_time").isNotNull(), MATCHED)
           .when(F.col("pay_time").isNotNull(), UNMATCHED_PAYS).otherwise(UNMATCHED_RECEIPTS))
    return j.select(tag.alias("tag"), "order_id", "tx_id", "pay_time", "pay_channel", "receipt_time")
