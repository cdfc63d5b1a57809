"""Writers that survive a replay, processors on repeated and disordered rows, jobs wired from lines to files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_reconcile import simulate
from tests.test_streaming import FAR, collect_stream, replay, rocks  # noqa: F401
from tidemark.operators import blocking, distinct, joins, patterns
from tidemark.streaming import jobs as sjobs
from tidemark.streaming import wiring

HOUR = 3_600_000


def counts(spark, data):
    return spark.createDataFrame(data, "url string, window_end long, cnt long")


def test_ranked_changelog_replays_the_same_rows(spark, tmp_path):
    out = []
    run = sjobs.ranked_changelog_writer(1, "url", str(tmp_path / "s"), lambda df, e: out.append(
        (e, sorted((r["url"], r["window_end"], r["op"]) for r in df.collect()))))
    b0 = counts(spark, [("a", HOUR, 5), ("b", HOUR, 3), ("x", 2 * HOUR, 1)])
    b1 = counts(spark, [("b", HOUR, 9)])
    b2 = counts(spark, [("b", 2 * HOUR, 4)])
    for epoch, b in ((0, b0), (0, b0), (1, b1), (1, b1), (1, b1), (2, b2), (2, b2)):
        run(b, epoch)
    first = [("a", HOUR, True), ("x", 2 * HOUR, True)]
    second = [("a", HOUR, False), ("b", HOUR, True)]
    third = [("b", 2 * HOUR, True), ("x", 2 * HOUR, False)]
    assert [r for _, r in out] == [first, first, second, second, second, third, third]


def test_closed_windows_and_old_epochs_leave_the_state(spark, tmp_path):
    run = sjobs.ranked_changelog_writer(2, "url", str(tmp_path / "s"), lambda df, e: df.collect(), keep="1 hour")
    for epoch in range(5):
        run(counts(spark, [("a", (epoch + 1) * HOUR, 1), ("b", (epoch + 1) * HOUR, 2)]), epoch)
    state = sjobs.EpochState(spark, str(tmp_path / "s"))
    assert sorted(state._epochs()) == [3, 4]
    ends = {r["window_end"] for r in spark.read.parquet(state.path(4, "counts")).collect()}
    assert ends == {4 * HOUR, 5 * HOUR}
    assert {r["window_end"] for r in spark.read.parquet(state.path(4, "top")).collect()} == ends


def test_late_rows_replay(spark, tmp_path):
    out = []
    run = sjobs.late_rows_writer("t", "10 minutes", "10 minutes", "1 minute", str(tmp_path / "l"),
                                 lambda df, e: out.append((e, sorted(r["t"] for r in df.collect()))))
    batch = lambda *t: spark.createDataFrame([(x,) for x in t], "t long")
    for epoch, b in ((0, batch(5_000_000)), (1, batch(1000, 9_000_000)), (1, batch(1000, 9_000_000)), (2, batch(5_000_001))):
        run(b, epoch)
    assert out == [(1, [1000]), (1, [1000]), (2, [5_000_001])]


def test_report_is_written_again_when_a_late_row_changes_it(spark, tmp_path):
    from tidemark.functions import report
    out = []
    run = sjobs.report_writer(1, "url", str(tmp_path / "r"), lambda df, e: out.append(
        [r["report"] for r in df.collect()]), report.PAGE_LABELS)
    run(counts(spark, [("a", HOUR, 5)]), 0)
    run(counts(spark, [("b", HOUR, 3)]), 1)
    run(counts(spark, [("b", HOUR, 7)]), 2)
    assert len(out[0]) == 1 and "a" in out[0][0] and out[1] == [] and "b" in out[2][0]


def test_tx_match_on_repeated_ids_and_any_batches(rocks, tmp_path):  # noqa: F811
    spark, rng = rocks, random.Random(4)
    at = 86400  # event time 0 is behind the first watermark
    pays = [(n, f"t{n % 6}", at + rng.randrange(0, 120)) for n in range(60)] + [(100, "late", at), (101, "late", at + 4)]
    receipts = [(f"t{n % 6}", f"c{n}", at + rng.randrange(0, 120)) for n in range(60)] + [("late", "z", at + 1), ("late", "y", at + 8)]
    p = spark.createDataFrame(pays, "order_id long, tx_id string, timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))
    r = spark.createDataFrame(receipts, "tx_id string, pay_channel string, timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))
    flush_p = spark.createDataFrame([(-1, "flush", FAR)], "order_id long, tx_id string, timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))
    flush_r = spark.createDataFrame([("flush", "x", FAR)], "tx_id string, pay_channel string, timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))
    want = []
    for tx in {x for _, x, _ in pays} | {x for x, _, _ in receipts}:
        pairs = simulate([(t, o) for o, x, t in pays if x == tx], [(t, c) for x, c, t in receipts if x == tx])
        want += [(tx, a and a[0], b and b[0]) for a, b in pairs]
    sp = replay(spark, p, tmp_path, "p", F.floor(F.col("timestamp") / 15), flush_p)
    sr = replay(spark, r, tmp_path, "r", F.floor(F.col("timestamp") / 15), flush_r)
    got = [x for x in collect_stream(spark, sjobs.tx_match_stream(sp, sr), tmp_path, "tx") if x["tx_id"] != "flush"]
    assert sorted(((x["tx_id"], x["pay_time"], x["receipt_time"]) for x in got), key=repr) == sorted(want, key=repr)


def test_order_state_with_pay_before_create(rocks, tmp_path):  # noqa: F811
    spark = rocks
    rows_ = [(1, "pay", "t", 100), (1, "create", "", 200), (2, "create", "", 100), (3, "pay", "t", 150),
             (4, "create", "", 100), (4, "pay", "t", 1100), (5, "create", "", 100), (5, "pay", "t", 999)]
    df = spark.createDataFrame(rows_, "order_id long, event_type string, tx_id string, timestamp long").withColumn(
        "ts", F.timestamp_seconds("timestamp"))
    flush = spark.createDataFrame([(-1, "create", "", FAR)], "order_id long, event_type string, tx_id string, timestamp long"
                                  ).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, df, tmp_path, "o", F.lit(0), flush)
    got = collect_stream(spark, sjobs.order_state_stream(src), tmp_path, "o")
    assert sorted(map(tuple, got)) == rows(patterns.order_state(df))


def test_daily_blocker_and_running_uv(rocks, tmp_path):  # noqa: F811
    spark, rng = rocks, random.Random(2)
    data = [(rng.randrange(3), 1, "p", "c", 86400 + i * 9000, i) for i in range(60)]
    schema = "user_id long, ad_id long, province string, city string, timestamp long, seq long"
    clicks = spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, clicks, tmp_path, "c", F.floor(F.col("timestamp") / 100000))
    got = collect_stream(spark, sjobs.blocker_stream(src, 2, "calendar_day", delay="1 hour"), tmp_path, "c")
    assert sorted(r["seq"] for r in got if r["tag"] == "data") == sorted(
        r["seq"] for r in blocking.block_clicks(clicks, 2, reset="calendar_day").collect())
    assert sum(r["tag"] == "blacklist" for r in got) == blocking.blacklist_warnings(clicks, 2, reset="calendar_day").count()
    views = clicks.select("user_id", "timestamp", "seq", "ts")
    src = replay(spark, views, tmp_path, "v", F.floor(F.col("timestamp") / 100000))
    uv = collect_stream(spark, sjobs.uv_running_stream(src, "1 day"), tmp_path, "v")
    assert sorted(map(tuple, uv)) == rows(distinct.uv_running(views, "1 day"))


def test_salted_page_views_and_channel_counts(rocks, tmp_path):  # noqa: F811
    spark = rocks
    from tidemark.operators import windows
    data = [(i % 4, 1, 1, "pv" if i % 3 else "buy", i * 400, i) for i in range(50)] + [(0, 1, 1, "pv", FAR, 99)]
    beh = spark.createDataFrame(data, "user_id long, item_id long, category_id int, behavior string, timestamp long, seq long"
                                ).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, beh, tmp_path, "b", F.when(F.col("timestamp") == FAR, 9).otherwise(F.floor(F.col("seq") / 20)))
    got = collect_stream(spark, sjobs.page_view_stream(src, salt=3), tmp_path, "b")
    want = windows.window_count(beh.filter(f"behavior = 'pv' and timestamp < {FAR}"), [], "1 hour", count_col="cnt")
    assert sorted((r["window_end"], r["cnt"]) for r in got) == rows(want, "window_end", "cnt")
    m = [(i, ["CLICK", "UNINSTALL", None][i % 3], "weibo", i * 1000) for i in range(30)] + [(0, "CLICK", "weibo", FAR * 1000)]
    mk = spark.createDataFrame(m, "user_id long, behavior string, channel string, timestamp long").withColumn(
        "ts", F.timestamp_millis("timestamp"))
    src = replay(spark, mk, tmp_path, "m", F.when(F.col("timestamp") == FAR * 1000, 9).otherwise(F.floor(F.col("user_id") / 10)))
    keep = mk.filter(f"timestamp < {FAR * 1000}").filter(~F.col("behavior").eqNullSafe("UNINSTALL"))
    got = collect_stream(spark, sjobs.channel_counts_stream(src, "1 minute", "5 seconds"), tmp_path, "m")
    want = windows.window_count(keep, ["channel", "behavior"], "1 minute", "5 seconds", count_col="cnt")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want.collect())))
    got = collect_stream(spark, sjobs.channel_total_stream(src, "1 minute", "5 seconds"), tmp_path, "mt")
    assert sorted(map(tuple, got)) == rows(windows.window_count(keep, [], "1 minute", "5 seconds", count_col="cnt"))


@pytest.mark.parametrize("job", ["order-timeout", "hot-items"])
def test_jobs_from_lines_to_files(rocks, tmp_path, job):  # noqa: F811
    src = tmp_path / "in"
    src.mkdir()
    if job == "order-timeout":
        (src / "a.csv").write_text("1,create,,100\n1,pay,t1,200\n2,create,,100\n")
        (src / "b.csv").write_text(f"9,create,,{FAR}\n")
        name = "orders"
    else:
        (src / "a.csv").write_text("1,7,1,pv,100\n2,7,1,pv,101\n1,8,1,pv,102\n1,8,1,buy,103\n")
        (src / "b.csv").write_text(f"1,1,1,pv,{FAR}\n")
        name = "behavior"
    wiring.start(rocks, job, {name: str(src)}, str(tmp_path / "out"), str(tmp_path / "ck"), once=True).awaitTermination(300)
    # the second run's batch closes what the first left open
    (src / "c.csv").write_text((src / "b.csv").read_text().replace(str(FAR), str(FAR + 10**6)))
    wiring.start(rocks, job, {name: str(src)}, str(tmp_path / "out"), str(tmp_path / "ck"), once=True).awaitTermination(300)
    lines = [json.loads(x) for f in (tmp_path / "out").rglob("*.json") for x in f.read_text().splitlines()]
    if job == "order-timeout":
        assert {(x["order_id"], x["result_state"]) for x in lines} >= {(1, "payed successfully"), (2, "timeout")}
    else:
        first = [x["report"] for x in lines if x["window_end"] == 300_000]
        assert len(first) == 1 and first[0].index("= 7") < first[0].index("= 8")
