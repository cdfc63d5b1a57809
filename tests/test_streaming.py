"""Streaming forms equal the batch operators: inputs replayed as a file stream in several files,
``availableNow``, plus a far-future flush row so that every window and timer closes."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidemark.operators import joins, patterns, windows
from tidemark.plans import jobs
from tidemark.sources import adapters
from tidemark.streaming import aggregations as sagg
from tidemark.streaming import jobs as sjobs

FAR = 4102444800  # 2100-01-01, epoch s


def replay(spark, df, tmp_path, name, part_col, flush=None):
    """Write ``df`` as one parquet file per value of ``part_col`` (in time order), then a flush file;
    return a streaming DataFrame reading the folder one file per micro-batch."""
    path = str(tmp_path / name)
    df = df.withColumn("_part", part_col)
    parts = sorted(r[0] for r in df.select("_part").distinct().collect())
    for i, p in enumerate(parts):
        df.filter(F.col("_part") == p).drop("_part").coalesce(1).write.parquet(f"{path}/p{i:04d}")
    if flush is not None:
        flush.coalesce(1).write.parquet(f"{path}/p{len(parts):04d}")
    schema = df.drop("_part").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def collect_stream(spark, sdf, tmp_path, name, mode="append"):
    out = []
    q = (sdf.writeStream.outputMode(mode).trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / f"ckpt-{name}"))
         .foreachBatch(lambda b, _: out.extend(b.collect())).start())
    q.awaitTermination(600)
    return out


@pytest.fixture(scope="module")
def rocks(spark):
    sjobs.use_rocksdb(spark)
    return spark


def _orders(spark):
    return adapters.order_events(adapters.table(spark, SF["0.001"], "orders"))


def _flush_orders(spark, like):
    return spark.createDataFrame([(-1, "create", "", FAR)], "order_id long, event_type string, tx_id string, "
                                 "timestamp long").withColumn("ts", F.timestamp_seconds("timestamp")).select(
        *like.columns)


def test_order_state_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    orders = _orders(spark)
    src = replay(spark, orders, tmp_path, "orders", F.year("ts"), _flush_orders(spark, orders))
    got = collect_stream(spark, sjobs.order_state_stream(src, 900), tmp_path, "os")
    exp = rows(patterns.order_state(orders, 900))
    assert sorted(tuple(r) for r in got) == exp


def test_order_pay_timeout_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    orders = _orders(spark)
    src = replay(spark, orders, tmp_path, "orders", F.year("ts"), _flush_orders(spark, orders))
    got = collect_stream(spark, sjobs.order_pay_timeout_stream(src, 300), tmp_path, "opt")
    exp = rows(patterns.order_pay_match(orders, 300))
    assert sorted(tuple(r) for r in got if r[0] != -1) == exp


def test_tx_match_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    orders = _orders(spark)
    pays = joins.pays_of(orders)
    receipts = adapters.receipt_events(adapters.table(spark, SF["0.001"], "orders"))
    fp = spark.createDataFrame([(-1, "pay", "flush", FAR)], "order_id long, event_type string, tx_id string, "
                               "timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))
    fr = spark.createDataFrame([("flush", "x", FAR)], "tx_id string, pay_channel string, timestamp long"
                               ).withColumn("ts", F.timestamp_seconds("timestamp"))
    sp = replay(spark, pays, tmp_path, "pays", F.year("ts"), fp.select(*pays.columns))
    sr = replay(spark, receipts, tmp_path, "receipts", F.year("ts"), fr.select(*receipts.columns))
    got = collect_stream(spark, sjobs.tx_match_stream(sp, sr), tmp_path, "tx")
    exp = rows(joins.reconcile(pays, receipts, "interval"))
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted((tuple(r) for r in got if r["tx_id"] != "flush"), key=key) == sorted(exp, key=key)


def test_login_streams_equal_batch(rocks, tmp_path):
    spark = rocks
    logins = adapters.login_events(adapters.table(spark, SF["0.001"], "events"))
    src = replay(spark, logins, tmp_path, "logins", F.weekofyear("ts"))
    got = collect_stream(spark, sjobs.login_fail_stream(src, 36000), tmp_path, "lf")
    exp = rows(patterns.login_fail_pairs(logins, 36000))
    assert len(exp) > 0 and sorted(tuple(r) for r in got) == exp


def test_login_timed_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    logins = adapters.login_events(adapters.table(spark, SF["0.001"], "events"))
    flush = spark.createDataFrame([(-1, "x", "success", FAR, 10**9)],
                                  "user_id long, ip string, login_state string, timestamp long, seq long"
                                  ).withColumn("ts", F.timestamp_seconds("timestamp")).select(*logins.columns)
    src = replay(spark, logins, tmp_path, "logins", F.weekofyear("ts"), flush)
    got = collect_stream(spark, sjobs.login_fail_timed_stream(src, 86400, 2), tmp_path, "lt")
    exp = rows(patterns.login_fail_timed(logins, 86400, 2))
    assert len(exp) > 0 and sorted(tuple(r) for r in got) == exp
    streak = collect_stream(spark, sjobs.login_fail_streak_stream(src, 3, 86400 * 3), tmp_path, "ls")
    exp2 = rows(patterns.login_fail_streak(logins, 3, 86400 * 3))
    assert len(exp2) > 0 and sorted(tuple(r) for r in streak) == exp2


def test_blocker_stream_equals_batch(rocks, tmp_path):
    spark = rocks
    clicks = adapters.ad_clicks(adapters.table(spark, SF["0.001"], "events"),
                                adapters.table(spark, SF["0.001"], "nation"))
    src = replay(spark, clicks, tmp_path, "clicks", F.weekofyear("ts"))
    got = collect_stream(spark, sjobs.blocker_stream(src, 3), tmp_path, "blk")
    passed = sorted(r["seq"] for r in got if r["tag"] == "data")
    from tidemark.operators import blocking
    assert passed == sorted(r.seq for r in blocking.block_clicks(clicks, 3).collect())
    warned = sorted((r["user_id"], r["ad_id"]) for r in got if r["tag"] == "blacklist")
    assert warned == sorted((r.user_id, r.ad_id) for r in blocking.blacklist_warnings(clicks, 3).collect())


def test_window_streams_equal_batch(rocks, tmp_path):
    spark = rocks
    beh = adapters.user_behavior(adapters.table(spark, SF["0.001"], "events"))
    flush = spark.createDataFrame([(-1, -1, 0, "pv", FAR, 10**9)],
                                  "user_id long, item_id long, category_id int, behavior string, "
                                  "timestamp long, seq long").withColumn(
        "ts", F.timestamp_seconds("timestamp")).select(*beh.columns)
    src = replay(spark, beh, tmp_path, "beh", F.weekofyear("ts"), flush)
    got = collect_stream(spark, sjobs.item_counts_stream(src), tmp_path, "ic")
    exp = rows(windows.window_count(beh.filter("behavior = 'pv'"), ["item_id"], "1 hour", "5 minutes",
                                    count_col="cnt"))
    assert sorted(tuple(r) for r in got) == exp
    ranked = []
    q = (sjobs.item_counts_stream(src).writeStream.outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck-top"))
         .foreachBatch(sjobs.top_n_writer(5, "item_id", lambda df, e: ranked.extend(
             (r.window_end, r.rank, r.item_id, r.cnt) for r in df.collect()))).start())
    q.awaitTermination(600)
    top = rows(windows.window_count(beh.filter("behavior = 'pv'"), ["item_id"], "1 hour", "5 minutes",
                                    count_col="cnt").transform(lambda d: __import__(
        "tidemark.operators.topn", fromlist=["top_n"]).top_n(d, 5, id_col="item_id")),
        "window_end", "rank", "item_id", "cnt")
    assert sorted(ranked) == top
    pane = collect_stream(spark, sagg.sliding_count_stream(src.filter("behavior = 'pv'"), ["category_id"],
                                                               "1 hour", "5 minutes"), tmp_path, "pane")
    exp2 = rows(windows.window_count(beh.filter("behavior = 'pv'"), ["category_id"], "1 hour", "5 minutes",
                                     count_col="cnt"))
    assert sorted(tuple(r) for r in pane) == exp2
    uv = collect_stream(spark, sagg.uv_stream(src.filter("behavior = 'pv'")), tmp_path, "uv")
    exp3 = rows(jobs.unique_visitor(spark, SF["0.001"]))
    assert sorted(tuple(r) for r in uv) == exp3
    bm = collect_stream(spark, sagg.uv_bitmap_stream(src.filter("behavior = 'pv'")), tmp_path, "uvb")
    assert sorted(tuple(r) for r in bm) == rows(jobs.uv_bitmap(spark, SF["0.001"]))


def test_ranked_changelog_and_late_rows(rocks, tmp_path):
    spark = rocks
    from tidemark.streaming.jobs import late_rows_writer, page_counts_stream, ranked_changelog_writer
    base = 1_700_000_000_000
    batches = [
        [("a", base + 1000), ("b", base + 2000), ("b", base + 2500)],
        [("a", base + 3000), ("a", base + 3500), ("c", base + 400_000)],   # a overtakes b in window 0-10min
        [("c", base + 1500), ("d", base - 250_000)],                      # late within lateness / too late
        [("z", base + 2_000_000)],
    ]
    src_dir = tmp_path / "req"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "url string, timestamp long").withColumn(
            "ts", F.timestamp_millis("timestamp")).coalesce(1).write.parquet(str(src_dir / f"b{i}"))
    schema = "url string, timestamp long, ts timestamp"
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(str(src_dir)))
    changes = []
    counts = page_counts_stream(src, "10 minutes", "10 minutes", "1 second", "1 minute")
    q = (counts.writeStream.outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck1"))
         .foreachBatch(ranked_changelog_writer(1, "url", str(tmp_path / "state"),
                                               lambda df, e: changes.extend((e, *r) for r in df.collect())))
         .start())
    q.awaitTermination(300)
    w0 = (base // 600000 + 1) * 600000
    first = [c for c in changes if c[2] == w0]     # (epoch, url, window_end, cnt, rank, op)
    # b leads after batch 0; a replaces it after batch 1 (retract b, insert a)
    assert [(c[1], c[5]) for c in first if c[0] == 0] == [("b", True)]
    assert sorted((c[1], c[5]) for c in first if c[0] == 1) == [("a", True), ("b", False)]
    late = []
    q2 = (src.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck2"))
          .foreachBatch(late_rows_writer("timestamp", "10 minutes", "10 minutes", "61 seconds",
                                         str(tmp_path / "late"), lambda df, e: late.extend(df.collect())))
          .start())
    q2.awaitTermination(300)
    assert sorted(r.url for r in late) == ["d"]
    assert not [c for c in changes if c[0] == 2 and c[2] == w0]      # the late c does not change the leader


@pytest.mark.parametrize("reset", ["none", "calendar_day"])
def test_ad_province_stream_equals_batch(rocks, tmp_path, reset):
    spark = rocks
    from tidemark.operators import blocking
    clicks = adapters.ad_clicks(adapters.table(spark, SF["0.001"], "events"),
                                adapters.table(spark, SF["0.001"], "nation"))
    flush = spark.createDataFrame([(-1, -1, "zz", "zz", FAR, 10**9)],
                                  "user_id long, ad_id long, province string, city string, timestamp long, "
                                  "seq long").withColumn("ts", F.timestamp_seconds("timestamp")).select(
        *clicks.columns)
    src = replay(spark, clicks, tmp_path, "clicks", F.weekofyear("ts"), flush)
    got = collect_stream(spark, sjobs.ad_province_stream(src, 3, reset=reset), tmp_path, "prov")
    exp = rows(windows.window_count(blocking.block_clicks(clicks, 3, reset=reset), ["province"], "1 hour", "5 minutes",
                                    count_col="cnt"))
    assert sorted(tuple(r) for r in got) == exp
