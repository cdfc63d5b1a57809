"""Adapters: the driver tables mapped to the records the analyses consume.

Rules are deterministic column expressions, so the same rows can be written as SQL for an oracle
(:mod:`tidemark.plans.oracles` mirrors each rule). Every adapter keeps an epoch ``timestamp`` in the unit of
the record (seconds, or milliseconds for marketing and access-log records), an event-time ``ts``
(TIMESTAMP), and an arrival sequence ``seq`` where the analysis depends on arrival order.

Driver ``events`` come in time order by ``event_id``; that id is the arrival sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import join_dimension

# Record vocabularies of the analyses.
BEHAVIOR_BY_EVENT = {"view": "pv", "purchase": "buy", "click": "cart", "signup": "fav", "error": "other"}
MARKETING_BY_EVENT = {"click": "CLICK", "view": "DOWNLOAD", "purchase": "INSTALL", "signup": "INSTALL",
                      "error": "UNINSTALL"}
CHANNELS = ["app store", "wechat", "weibo"]
PAY_CHANNELS = ["wechat", "alipay"]
STATIC_SUFFIXES = [".css", ".js", ".png", ".ico", ".css?x=1"]  # the last one is not a static asset


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def _mapped(col: str, mapping: dict[str, str]) -> Column:
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(F.col(col) == src, dst) if expr is None else expr.when(F.col(col) == src, dst))
    return expr


def _epoch_s(ts: str = "ts") -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _epoch_ms(ts: str = "ts") -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _ip(user: str = "user_id") -> Column:
    u = F.col(user)
    return F.concat_ws(".", F.lit("10"), (F.floor(u / 65536) % 256).cast("string"),
                       (F.floor(u / 256) % 256).cast("string"), (u % 256).cast("string"))


def source_events(mapping: dict[str, str], wanted) -> list[str]:
    """Source event types that map to one of ``wanted`` record values: filtering on them instead of on
    the mapped column lets the predicate reach the parquet scan."""
    return [src for src, dst in mapping.items() if dst in set(wanted)]


def user_behavior(events: DataFrame, behaviors=None) -> DataFrame:
    """events -> (user_id, item_id, category_id, behavior, timestamp s, ts, seq); ``behaviors`` keeps
    only those behaviours (filtered on the source column, pushed to the scan)."""
    if behaviors is not None:
        events = events.filter(F.col("event_type").isin(source_events(BEHAVIOR_BY_EVENT, behaviors)))
    return events.select(
        F.col("user_id"),
        _k().alias("item_id"),
        (_k() % 10).cast("int").alias("category_id"),
        _mapped("event_type", BEHAVIOR_BY_EVENT).alias("behavior"),
        _epoch_s().alias("timestamp"),
        F.col("event_id").alias("seq"),
    ).withColumn("ts", F.timestamp_seconds("timestamp"))


def login_events(events: DataFrame) -> DataFrame:
    """events -> (user_id, ip, login_state fail|success, timestamp s, ts, seq)."""
    return events.select(
        F.col("user_id"),
        _ip().alias("ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("login_state"),
        _epoch_s().alias("timestamp"),
        F.col("event_id").alias("seq"),
    ).withColumn("ts", F.timestamp_seconds("timestamp"))


def marketing_events(events: DataFrame, exclude=None) -> DataFrame:
    """events -> (user_id, behavior, channel, timestamp ms, ts); ``exclude`` drops those behaviours (a
    NULL behaviour is kept), filtered on the source column."""
    if exclude is not None:
        drop = source_events(MARKETING_BY_EVENT, exclude)
        events = events.filter(~F.col("event_type").isin(drop) | F.col("event_type").isNull())
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (_k() % len(CHANNELS) + 1).cast("int"))
    return events.select(
        F.col("user_id"),
        _mapped("event_type", MARKETING_BY_EVENT).alias("behavior"),
        channel.alias("channel"),
        _epoch_ms().alias("timestamp"),
        F.col("event_id").alias("seq"),
    ).withColumn("ts", F.timestamp_millis("timestamp"))


def ad_clicks(events: DataFrame, nation: DataFrame) -> DataFrame:
    """events joined to nation -> (user_id, ad_id, province, city, timestamp s, ts, seq).

    Province is the nation at ``user_id % 25``; the 25-row dimension is broadcast after a size check.
    """
    clicks = events.select(
        F.col("user_id"),
        (_k() % 5).alias("ad_id"),
        (F.col("user_id") % 25).cast("int").alias("_nk"),
        _epoch_s().alias("timestamp"),
        F.col("event_id").alias("seq"),
    )
    dim = nation.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("province"))
    out = join_dimension(clicks, dim, "_nk")
    return out.select(
        "user_id", "ad_id", "province",
        F.concat(F.col("province"), F.lit("-"), (F.col("user_id") % 3).cast("string")).alias("city"),
        "timestamp", "seq",
    ).withColumn("ts", F.timestamp_seconds("timestamp"))


def log_time_shift() -> Column:
    """Seconds by which an access-log line is stamped earlier than its event: a deterministic disorder so
    that some lines arrive late (90 s, partly late for 10 min windows) or very late (900 s, every window)."""
    return (F.when(F.col("event_id") % 50 == 7, 900)
            .when(F.col("event_id") % 10 == 3, 90).otherwise(0))


def access_log_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """events joined to pages -> access-log text lines (``value``) with arrival ``seq``.

    Page = ``props.k``; a missing page falls back to ``/page/<k>``. Some keys get a static-asset suffix.
    view and click are GET, the other events POST. Line layout: ip, user, -, time, +0000, method, url.
    """
    ev = events.select("event_id", "user_id", "event_type", "ts", _k().alias("page_id"))
    pg = pages.select("page_id", "url")
    # some hundred distinct page ids: broadcast while the pages' ids and urls are small, else left to the planner
    joined = join_dimension(ev, pg, "page_id", "left")
    suffix = F.try_element_at(F.array(*[F.lit(s) for s in STATIC_SUFFIXES]), (F.col("page_id") % 10 + 1).cast("int"))
    url = F.concat(F.coalesce(F.col("url"), F.concat(F.lit("/page/"), F.col("page_id").cast("string"))),
                   F.coalesce(suffix, F.lit("")))
    stamp = F.timestamp_seconds(_epoch_s() - log_time_shift())
    method = F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST")
    line = F.concat_ws(" ", _ip(), F.lit("-"), F.lit("-"), F.date_format(stamp, "dd/MM/yyyy:HH:mm:ss"),
                       F.lit("+0000"), method, url)
    return joined.select(line.alias("value"), F.col("event_id").alias("seq"))


def order_events(orders: DataFrame) -> DataFrame:
    """orders -> OrderEvent rows (order_id, event_type, tx_id, timestamp s, ts).

    create at o_orderdate unless key % 13 = 0; pay at create + (key * 7919 % 1800) s unless key % 11 = 0,
    with tx id ``tx<key>``.
    """
    key = F.col("o_orderkey")
    created = _epoch_s("o_orderdate")
    paid = created + (key * 7919) % 1800
    rows = F.array(
        F.when(key % 13 != 0, F.struct(F.lit("create").alias("event_type"), F.lit("").alias("tx_id"),
                                       created.alias("timestamp"))),
        F.when(key % 11 != 0, F.struct(F.lit("pay").alias("event_type"),
                                       F.concat(F.lit("tx"), key.cast("string")).alias("tx_id"),
                                       paid.alias("timestamp"))),
    )
    return (orders.select(key.alias("order_id"), F.explode(rows).alias("e"))
            .filter(F.col("e").isNotNull())
            .select("order_id", "e.event_type", "e.tx_id", "e.timestamp")
            .withColumn("ts", F.timestamp_seconds("timestamp")))


def receipt_events(orders: DataFrame) -> DataFrame:
    """orders -> ReceiptEvent rows (tx_id, pay_channel, timestamp s, ts).

    One receipt per paid order unless key % 17 = 0, at pay time + (key % 13 - 6) s; for key % 19 = 0 the
    receipt carries another tx id (``rx<key>``) and so matches no pay.
    """
    key = F.col("o_orderkey")
    paid = _epoch_s("o_orderdate") + (key * 7919) % 1800
    tx = F.concat(F.when(key % 19 == 0, F.lit("rx")).otherwise(F.lit("tx")), key.cast("string"))
    channel = F.element_at(F.array(*[F.lit(c) for c in PAY_CHANNELS]), (key % 2 + 1).cast("int"))
    return (orders.filter((key % 11 != 0) & (key % 17 != 0))
            .select(tx.alias("tx_id"), channel.alias("pay_channel"), (paid + key % 13 - 6).alias("timestamp"))
            .withColumn("ts", F.timestamp_seconds("timestamp")))


def retried_pays(orders: DataFrame) -> DataFrame:
    """Pays of ``order_events`` with retries under the same tx id: for key % 5 = 0 a second pay 4 s later, for
    key % 10 = 0 a third 100 s later (order_id, tx_id, timestamp s, ts)."""
    pays = order_events(orders).filter(F.col("event_type") == "pay")
    key = F.col("order_id")
    none = F.lit(None).cast("int")
    shift = F.array_compact(F.array(F.lit(0), F.when(key % 5 == 0, F.lit(4)).otherwise(none),
                                    F.when(key % 10 == 0, F.lit(100)).otherwise(none)))
    return (pays.select("order_id", "tx_id", "timestamp", F.explode(shift).alias("_d"))
            .select("order_id", "tx_id", (F.col("timestamp") + F.col("_d")).alias("timestamp"))
            .withColumn("ts", F.timestamp_seconds("timestamp")))


def repeated_receipts(orders: DataFrame) -> DataFrame:
    """Receipts of ``receipt_events`` and more under the same tx ids: one 2 s later for every third receipt
    time, one 101 s later for every seventh (tx_id, pay_channel, timestamp s, ts)."""
    t = F.col("timestamp")
    none = F.lit(None).cast("int")
    shift = F.array_compact(F.array(F.lit(0), F.when(t % 3 == 0, F.lit(2)).otherwise(none),
                                    F.when(t % 7 == 0, F.lit(101)).otherwise(none)))
    return (receipt_events(orders).select("tx_id", "pay_channel", t, F.explode(shift).alias("_d"))
            .select("tx_id", "pay_channel", (t + F.col("_d")).alias("timestamp"))
            .withColumn("ts", F.timestamp_seconds("timestamp")))


def early_paid_orders(orders: DataFrame) -> DataFrame:
    """``order_events`` with the pays of key % 4 = 0 moved 2000 s back, before their creates."""
    early = (F.col("event_type") == "pay") & (F.col("order_id") % 4 == 0)
    return (order_events(orders).withColumn("timestamp", F.when(early, F.col("timestamp") - 2000)
                                            .otherwise(F.col("timestamp")))
            .withColumn("ts", F.timestamp_seconds("timestamp")))


def reused_orders(orders: DataFrame) -> DataFrame:
    """Order events whose ids come back: keys 2m and 2m + 1 share id 2m, and each has four cycles 3000 s apart. In cycle
    j a create at o_orderdate + 3000 j unless (key + j) % 7 = 0, a second one 500 s later for (key + j) % 9 = 0, and a pay
    (key * 7919 + j * 1009) % 5000 s after the create's time unless (key + j) % 5 = 0 (order_id, event_type, tx_id,
    timestamp s, ts, seq)."""
    key, j = F.col("o_orderkey"), F.col("j")
    base = _epoch_s("o_orderdate") + 3000 * j
    event = lambda kind, t: F.struct(F.lit(kind).alias("event_type"), t.alias("timestamp"))
    rows = F.array_compact(F.array(
        F.when((key + j) % 7 != 0, event("create", base)),
        F.when((key + j) % 9 == 0, event("create", base + 500)),
        F.when((key + j) % 5 != 0, event("pay", base + (key * 7919 + j * 1009) % 5000))))
    return (orders.select("o_orderkey", "o_orderdate", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"))
            .select((key - key % 2).alias("order_id"), (key * 4 + j).alias("seq"), F.explode(rows).alias("e"))
            .select("order_id", "e.event_type", F.lit("").alias("tx_id"), "e.timestamp",
                    F.timestamp_seconds("e.timestamp").alias("ts"), "seq"))


def topic_messages(events: DataFrame) -> DataFrame:
    """Messages of a topic with six partitions, half of them in partition 0, their offsets with gaps, and timestamps that
    run up to a day behind the event's time (partition, offset, timestamp_ms)."""
    e = F.col("event_id")
    return events.select(F.when(e % 2 == 0, F.lit(0)).otherwise(1 + e % 5).cast("int").alias("partition"),
                         e.alias("offset"), (_epoch_ms() - e * 7919 % 86400 * 1000).alias("timestamp_ms"))


def cut_lines(lines: DataFrame) -> DataFrame:
    """Access-log lines with every ninth (by ``seq``) cut before the method and every eleventh without a time."""
    short = F.regexp_extract("value", r"^(\S+ \S+ \S+ \S+)", 1)
    blank = F.regexp_replace("value", r"^(\S+ \S+ \S+) \S+", "$1 -")
    return lines.withColumn("value", F.when(F.col("seq") % 9 == 0, short).when(F.col("seq") % 11 == 0, blank)
                            .otherwise(F.col("value")))
