"""Sequence patterns and keyed state machines, in batch form.

* :func:`login_fail_pairs`: a ``fail`` whose previous k-1 rows of the user (arrival order) are fails too,
  first to last within a limit (inclusive). k = 2 is the pairwise detector.
* :func:`login_fail_streak`: k strictly consecutive fails in event-time order, last - first < within
  (every start position reports, matches may overlap).
* :func:`login_fail_timed`: fails collected from a first fail until first + limit (a success cancels);
  a warning when at least k were collected.
* :func:`order_pay_match`: each ``create`` is followed by the first later ``pay`` of the order within a
  limit (strict), else it times out at create + limit.
* :func:`order_state`: one result per order from its create and pay times.
* :func:`order_cycles`: one result per cycle of an order id that is used again and again.

Ordering is per key; rows are chunked (arrival or event-time buckets) so that one busy key spreads over
many tasks, see :mod:`tidemark.operators.sequence`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import sequence as seq
from tidemark.session import materialize

# Result texts of the detectors.
PAIR_MSG = "login fail {k} times in {limit}s"
STREAK_MSG = "login fail {k} times"
TIMED_MSG = "login fail in {limit}s for {n} times"
PAYED = "payed"
TIMEOUT_PREFIX = "timeout "
PAYED_OK = "payed successfully"
PAYED_LATE = "payed but already timeout"
TIMED_OUT = "timeout"
NO_CREATE = "payed but not found created log"


def login_fail_pairs(logins: DataFrame, limit_s: int = 2, fail_times: int = 2,
                     rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(user_id, first_fail_time, last_fail_time, warning_msg) by arrival order (``seq``)."""
    k = fail_times
    df = logins.select("user_id", "login_state", "timestamp", "seq").withColumn(
        "_chunk", seq.arrival_chunk("seq", rows_per_chunk))
    if k > 1:
        df = seq.shift(df, ["user_id"], ["seq"], "_chunk", ["login_state", "timestamp"], k - 1, "prev")
    all_fail = F.col("login_state") == "fail"
    for i in range(1, k):
        all_fail = all_fail & (F.col(f"prev{i}_login_state") == "fail")
    first = F.col(f"prev{k - 1}_timestamp") if k > 1 else F.col("timestamp")
    return df.filter(all_fail & (F.col("timestamp") - first <= limit_s)).select(
        "user_id", first.alias("first_fail_time"), F.col("timestamp").alias("last_fail_time"),
        F.lit(PAIR_MSG.format(k=k, limit=limit_s)).alias("warning_msg"))


def login_fail_streak(logins: DataFrame, times: int = 3, within_s: int = 5,
                      rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(user_id, first_fail_time, last_fail_time, warning_msg): k consecutive fails in event time."""
    k = times
    df, chunk = seq.chunk_by(logins.select("user_id", "login_state", "timestamp", "seq"), ["user_id"],
                             "timestamp", "balanced", target_rows=rows_per_chunk)
    order = ["timestamp", "seq"]
    if k > 1:
        df = seq.shift(df, ["user_id"], order, chunk, ["login_state", "timestamp"], k - 1, "next")
    all_fail = F.col("login_state") == "fail"
    for i in range(1, k):
        all_fail = all_fail & (F.col(f"next{i}_login_state") == "fail")
    last = F.col(f"next{k - 1}_timestamp") if k > 1 else F.col("timestamp")
    return df.filter(all_fail & (last - F.col("timestamp") < within_s)).select(
        "user_id", F.col("timestamp").alias("first_fail_time"), last.alias("last_fail_time"),
        F.lit(STREAK_MSG.format(k=k)).alias("warning_msg"))


def login_fail_timed(logins: DataFrame, limit_s: int = 2, min_fails: int = 2,
                     rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(user_id, first_fail_time, last_fail_time, warning_msg) of timer-closed fail groups.

    Event-time semantics: a fail with no open group opens one until first + limit (exclusive); fails
    before that time join it; a success before that time cancels it; at the deadline a group of at least
    ``min_fails`` warns.

    Runs of fails split at successes and at gaps of at least ``limit`` are independent. Inside a run the
    group starts are found by pointer doubling (:func:`tidemark.operators.sequence.greedy_starts`). What joins on the run alone is one row per run; a
    run with very many fails is split there by adaptive execution only.
    """
    order = ["timestamp", "seq"]
    keys = ["run"]
    df, chunk = seq.chunk_by(logins.select("user_id", "login_state", "timestamp", "seq"), ["user_id"],
                             "timestamp", "balanced", target_rows=rows_per_chunk)
    df = seq.shift(df, ["user_id"], order, chunk, ["login_state", "timestamp"], 1, "prev")
    is_fail = F.col("login_state") == "fail"
    opens = is_fail & (F.col("prev1_login_state").isNull() | (F.col("prev1_login_state") != "fail")
                       | (F.col("timestamp") - F.col("prev1_timestamp") >= limit_s))
    df = seq.running_sum(df, ["user_id"], order, chunk, opens.cast("long"), out="_run")
    # a struct, so that a NULL user is a user
    df = df.filter(F.col("_run") > 0).select(F.struct("user_id", "_run").alias("run"), "timestamp", "seq",
                                             *([chunk] if chunk else []), is_fail.alias("_fail"))
    df = materialize(df, "fail-runs")
    # The success that ends a run (its first success) can cancel the run's last group.
    ends = df.filter(~F.col("_fail")).groupBy("run").agg(F.min("timestamp").alias("_succ"))
    fails = materialize(seq.rank(df.filter("_fail").drop("_fail"), keys, order, chunk, out="_i")
                        .withColumn("_i", F.col("_i") - 1), "fail-index")
    runs = fails.groupBy("run").agg(F.count(F.lit(1)).alias("_n")).join(ends, "run", "left")
    starts = seq.greedy_starts(fails, "run", "_i", "timestamp", limit_s, rows_per_chunk)
    # Each start s covers fails s .. next(s) - 1; the run's last group may be cancelled by its success.
    groups = (starts.join(runs, "run")
              .select("run", F.col("_i").alias("_s"), F.coalesce("next", "_n").alias("_e"), F.col("next").isNull().alias("_last"),
                      "_succ"))
    first = fails.select("run", F.col("_i").alias("_s"), F.col("timestamp").alias("first_fail_time"))
    last = fails.select("run", (F.col("_i") + 1).alias("_e"), F.col("timestamp").alias("last_fail_time"))
    out = groups.join(first, ["run", "_s"]).join(last, ["run", "_e"]).withColumn("n", F.col("_e") - F.col("_s"))
    cancelled = F.col("_last") & F.col("_succ").isNotNull() & (F.col("_succ") < F.col("first_fail_time") + limit_s)
    msg = TIMED_MSG.format(limit=limit_s, n="%d")
    return out.filter((F.col("n") >= min_fails) & ~cancelled).select(
        F.col("run.user_id").alias("user_id"), "first_fail_time", "last_fail_time",
        F.format_string(msg, F.col("n")).alias("warning_msg"))


def _order_cols(orders: DataFrame) -> list[str]:
    return ["timestamp", "_type_rank"] + (["seq"] if "seq" in orders.columns else [])


def order_pay_match(orders: DataFrame, within_s: int = 300, chunking: str = "balanced",
                    rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(order_id, result_state): 'payed', or 'timeout <create + within, epoch ms>' per create.

    The rows per task are bounded for any order id; ``chunking='time'`` saves a pass where every order has a
    handful of events. A NULL order id is a key like any other."""
    df = orders.filter(F.col("event_type").isin("create", "pay")).withColumn(
        "_type_rank", F.when(F.col("event_type") == "create", 0).otherwise(1))
    df, chunk = seq.chunk_by(df, ["order_id"], "timestamp", chunking, target_rows=rows_per_chunk)
    cols = ["order_id", "event_type", "timestamp", "_type_rank"] + ([chunk] if chunk else []) + (
        ["seq"] if "seq" in orders.columns else [])
    df = seq.next_value(df.select(*cols), ["order_id"], _order_cols(orders), chunk,
                        F.when(F.col("event_type") == "pay", F.col("timestamp")), out="_next_pay")
    creates = df.filter(F.col("event_type") == "create")
    ok = F.col("_next_pay").isNotNull() & (F.col("_next_pay") - F.col("timestamp") < within_s)
    timeout = F.concat(F.lit(TIMEOUT_PREFIX), ((F.col("timestamp") + within_s) * 1000).cast("string"))
    return creates.select("order_id", F.when(ok, F.lit(PAYED)).otherwise(timeout).alias("result_state"))


def order_state(orders: DataFrame, timeout_s: int = 900) -> DataFrame:
    """(order_id, result_state): one of the four outcomes of the create/pay state machine.

    pay < create + timeout (or pay first): payed successfully; a later pay: payed but already timeout;
    no pay: timeout; no create: payed but not found created log. An aggregation per order, so partial
    aggregation absorbs any busy order id.
    """
    agg = orders.groupBy("order_id").agg(
        F.min(F.when(F.col("event_type") == "create", F.col("timestamp"))).alias("c"),
        F.min(F.when(F.col("event_type") == "pay", F.col("timestamp"))).alias("p"))
    c, p = F.col("c"), F.col("p")
    state = (F.when(c.isNotNull() & p.isNotNull() & (p < c + timeout_s), PAYED_OK)
             .when(c.isNotNull() & p.isNotNull(), PAYED_LATE)
             .when(c.isNotNull(), TIMED_OUT)
             .otherwise(NO_CREATE))
    return agg.filter(c.isNotNull() | p.isNotNull()).select("order_id", state.alias("result_state"))


def order_cycles(orders: DataFrame, timeout_s: int = 900, late_s: int | None = None, early_s: int | None = None,
                 chunking: str = "balanced", rows_per_chunk: int = 1 << 20) -> DataFrame:
    """(order_id, cycle_time, result_state): one result per cycle of an order id, which every outcome closes.

    Rows of an id are taken in event-time order (create before pay, then ``seq``):

    * a pay that finds a create waiting is 'payed successfully' before create + ``timeout_s``, else 'payed but already
      timeout'; a create that finds a pay waiting is 'payed successfully';
    * a waiting create is a 'timeout' when another create comes at or after create + ``timeout_s`` (one that comes
      before begins the wait anew), when no pay has come by create + ``timeout_s`` + ``late_s``, and at the end;
    * a waiting pay is 'payed but not found created log' when another pay comes, when no create has come by pay +
      ``early_s`` (inclusive), and at the end.

    ``late_s`` and ``early_s`` None wait for ever (the rule of :func:`order_state`, which gives the same results for
    ids used once); a stream needs them. ``cycle_time`` is the time of the row that waited.

    What waits after a row is that row or nothing. It is nothing only if the row closed a cycle, and whether it did follows
    from the row before, and so on: a row's effect is a function of the state before it. Those functions compose to
    very little. A row that has the kind of the row before it, or comes too late for it, waits whatever the state was;
    after it the kinds alternate, and the rows of its kind wait while those of the other kind close. So the state
    after any row is known from the kind of the last such row, which is one value per chunk to carry over: a running
    last value along the key, chunked as elsewhere (:mod:`tidemark.operators.sequence`). Rows of other types and rows
    without a time are left out. A NULL order id is a key like any other.
    """
    order = ["timestamp", "_kind"] + (["seq"] if "seq" in orders.columns else [])
    df = orders.filter(F.col("event_type").isin("create", "pay") & F.col("timestamp").isNotNull()).select(
        "order_id", (F.col("event_type") == "pay").cast("int").alias("_kind"), *[c for c in order if c != "_kind"])
    df, chunk = seq.chunk_by(df, ["order_id"], "timestamp", chunking, target_rows=rows_per_chunk)
    df = seq.shift(df, ["order_id"], order, chunk, ["_kind", "timestamp"], 1, "prev")
    t, before, kind, kind_before = F.col("timestamp"), F.col("prev1_timestamp"), F.col("_kind"), F.col("prev1__kind")
    pay = kind == 1
    in_time = (F.lit(True) if late_s is None else t < before + timeout_s + late_s, F.lit(True) if early_s is None else t <= before + early_s)
    meets = kind_before.isNotNull() & (kind != kind_before) & F.when(pay, in_time[0]).otherwise(in_time[1])
    df = df.withColumn("_meets", meets)
    # the kind of the last row that waits whatever came before it; the largest of the ordered structs is the last
    last = F.struct(*[F.col(c) for c in order])
    df = seq.running_agg(df, ["order_id"], order, chunk, F.when(~F.col("_meets"), last), "_anchor", "max")
    df = df.withColumn("_waits", kind == F.col("_anchor._kind"))
    # seen from the row that waits: what the next row of the id makes of it
    df = seq.shift(df.drop("prev1__kind", "prev1_timestamp"), ["order_id"], order, chunk,
                   ["_kind", "timestamp", "_meets"], 1, "next")
    t_next, paired = F.col("next1_timestamp"), F.coalesce(F.col("next1__meets"), F.lit(False))
    created = (F.when(paired & (t_next < t + timeout_s), PAYED_OK).when(paired, PAYED_LATE)
               .when((F.col("next1__kind") == 0) & (t_next < t + timeout_s), F.lit(None)).otherwise(TIMED_OUT))
    payed = F.when(paired, PAYED_OK).otherwise(NO_CREATE)
    return (df.filter("_waits").select("order_id", t.alias("cycle_time"), F.when(pay, payed).otherwise(created).alias("result_state"))
            .filter(F.col("result_state").isNotNull()))
