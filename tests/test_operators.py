"""Operators on small hand-made record files: limits exactly at the edge, ties, disorder, residuals."""

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import blocking, joins, patterns, topn, windows
from tidemark.sources import read_records


def write_csv(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines))       # last line without newline, like the shipped logs
    return str(p)


def test_blocking_exact_limits(spark, tmp_path):
    lines = []
    for user, n in [(1, 100), (2, 101), (3, 102)]:
        lines += [f"{user},7,beijing,beijing,{1511658000 + i}" for i in range(n)]
    lines.append("4,8,henan,zhengzhou,1511658000")
    df = read_records(spark, write_csv(tmp_path, "ad.csv", lines), "ad_click")
    passed = blocking.block_clicks(df, 100)
    assert rows(passed.groupBy("user_id").count()) == [(1, 100), (2, 100), (3, 100), (4, 1)]
    warn = blocking.blacklist_warnings(df, 100)
    assert rows(warn) == [(2, 7, "click over 100times."), (3, 7, "click over 100times.")]
    both = blocking.block_with_warnings(df, 100)
    assert both.filter("tag = 'blacklist'").count() == 2 and both.filter("tag = 'data'").count() == 301


def test_blocking_calendar_day_reset(spark, tmp_path):
    day = 86400 * 17500
    lines = [f"1,7,p,c,{day + i}" for i in range(3)] + [f"1,7,p,c,{day + 86400 + i}" for i in range(3)]
    df = read_records(spark, write_csv(tmp_path, "ad.csv", lines), "ad_click")
    assert blocking.block_clicks(df, 2, reset="none").count() == 2
    assert blocking.block_clicks(df, 2, reset="calendar_day").count() == 4
    assert blocking.blacklist_warnings(df, 2, reset="calendar_day").count() == 2


def test_province_count_after_blocking(spark, tmp_path):
    lines = [f"{u},1,{p},x,{1511658000 + 300 * i}" for i, (u, p) in enumerate(
        [(1, "beijing"), (1, "beijing"), (1, "beijing"), (2, "henan")])]
    df = read_records(spark, write_csv(tmp_path, "ad.csv", lines), "ad_click").withColumn(
        "ts", F.timestamp_seconds("timestamp"))
    c = windows.window_count(blocking.block_clicks(df, 2), ["province"], "1 hour", "5 minutes", count_col="cnt")
    got = {(r.province, r.window_end): r.cnt for r in c.collect()}
    assert max(got.values()) == 2 and len([k for k in got if k[0] == "henan"]) == 12
    # every beijing window that holds both passing rows counts 2
    assert sorted(set(v for (p, _), v in got.items() if p == "beijing")) == [1, 2]


LOGIN = [
    "1035,83.149.9.216,fail,1558430842",
    "1035,83.149.9.216,fail,1558430843",
    "1035,83.149.9.216,fail,1558430844",
    "1035,83.149.9.216,success,1558430845",
    "2,1.1.1.1,fail,100",
    "2,1.1.1.1,fail,98",       # arrives later, earlier in time: difference is negative, still a warning
    "3,1.1.1.1,fail,100",
    "3,1.1.1.1,fail,102",      # exactly 2 s: warning
    "3,1.1.1.1,fail,105",      # 3 s: none
    "4,1.1.1.1,fail,100",
    "4,1.1.1.1,success,100",
    "4,1.1.1.1,fail,101",      # success in between resets
]


def test_login_fail_pairs(spark, tmp_path):
    df = read_records(spark, write_csv(tmp_path, "login.csv", LOGIN), "login")
    got = rows(patterns.login_fail_pairs(df, 2))
    assert got == [(2, 100, 98, "login fail 2 times in 2s"), (3, 100, 102, "login fail 2 times in 2s"),
                   (1035, 1558430842, 1558430843, "login fail 2 times in 2s"),
                   (1035, 1558430843, 1558430844, "login fail 2 times in 2s")]


def test_login_fail_pairs_three(spark, tmp_path):
    df = read_records(spark, write_csv(tmp_path, "login.csv", LOGIN), "login")
    got = rows(patterns.login_fail_pairs(df, 2, fail_times=3))
    assert got == [(1035, 1558430842, 1558430844, "login fail 3 times in 2s")]


def test_login_fail_streak(spark, tmp_path):
    lines = LOGIN + ["5,x,fail,10", "5,x,fail,11", "5,x,fail,12", "5,x,fail,13",   # two overlapping matches
                     "6,x,fail,10", "6,x,fail,12", "6,x,fail,15"]                   # 5 s: not within
    df = read_records(spark, write_csv(tmp_path, "login.csv", lines), "login")
    got = rows(patterns.login_fail_streak(df, 3, 5))
    assert got == [(5, 10, 12, "login fail 3 times"), (5, 11, 13, "login fail 3 times"),
                   (1035, 1558430842, 1558430844, "login fail 3 times")]


def brute_timed(events, limit, min_fails):
    """Event-time simulation of the timer detector, one user at a time."""
    out = []
    by_user = {}
    for u, st, t, s in events:
        by_user.setdefault(u, []).append((t, s, st))
    for u, evs in by_user.items():
        start, n, last = None, 0, None
        for t, _, st in sorted(evs):
            if start is not None and t >= start + limit:
                if n >= min_fails:
                    out.append((u, start, last, n))
                start, n = None, 0
            if st == "fail":
                if start is None:
                    start, n = t, 0
                n, last = n + 1, t
            elif start is not None:
                start, n = None, 0
        if start is not None and n >= min_fails:
            out.append((u, start, last, n))
    return sorted(out)


def test_login_fail_timed_vs_brute_force(spark):
    import random
    rnd = random.Random(11)
    events = []
    for s in range(4000):
        u = 0 if rnd.random() < 0.3 else rnd.randrange(1, 40)
        events.append((u, "fail" if rnd.random() < 0.7 else "success", rnd.randrange(0, 20000), s))
    df = spark.createDataFrame(events, "user_id long, login_state string, timestamp long, seq long")
    got = rows(patterns.login_fail_timed(df, 30, 2, rows_per_chunk=50))
    exp = [(u, a, b, f"login fail in 30s for {n} times") for u, a, b, n in brute_timed(events, 30, 2)]
    assert got == exp


ORDERS = [
    "1,create,,100", "1,pay,tx1,399",          # 299 s: payed (both detectors)
    "2,create,,200", "2,pay,tx2,500",          # exactly 300 s: timeout at 5 min; 15 min: successful
    "3,create,,300",                           # never paid
    "4,pay,tx4,400",                           # no create
    "5,pay,tx5,90", "5,create,,100",           # pay before create
    "6,create,,1000", "6,pay,tx6,1900",        # exactly 900 s: already timed out
]


def test_order_pay_match(spark, tmp_path):
    df = read_records(spark, write_csv(tmp_path, "orders.csv", ORDERS), "order")
    got = rows(patterns.order_pay_match(df, 300))
    assert got == [(1, "payed"), (2, "timeout 500000"), (3, "timeout 600000"), (5, "timeout 400000"),
                   (6, "timeout 1300000")]


def test_order_state(spark, tmp_path):
    df = read_records(spark, write_csv(tmp_path, "orders.csv", ORDERS), "order")
    assert df.filter("order_id = 1 AND event_type = 'create'").first().tx_id == ""
    got = rows(patterns.order_state(df, 900))
    assert got == [(1, "payed successfully"), (2, "payed successfully"), (3, "timeout"),
                   (4, "payed but not found created log"), (5, "payed successfully"),
                   (6, "payed but already timeout")]


PAYS = ["1,create,,10", "1,pay,a,100", "2,pay,b,100", "3,pay,c,100", "4,pay,d,100", "5,pay,e,100",
        "6,pay,f,100", "7,pay,f,200"]
RECEIPTS = ["a,wechat,97", "b,alipay,105", "c,wechat,96", "d,alipay,106", "f,wechat,101", "f,alipay,202",
            "z,wechat,1"]


def test_interval_join(spark, tmp_path):
    p = joins.pays_of(read_records(spark, write_csv(tmp_path, "o.csv", PAYS), "order"))
    r = read_records(spark, write_csv(tmp_path, "r.csv", RECEIPTS), "receipt")
    got = rows(joins.interval_join(p, r, -3, 5))
    # -3 and +5 are inside, -4 and +6 outside; tx f pairs every pay with every receipt in range
    assert got == [(1, "a", 100, "wechat", 97), (2, "b", 100, "alipay", 105), (6, "f", 100, "wechat", 101),
                   (7, "f", 200, "alipay", 202)]


def test_reconcile_modes(spark, tmp_path):
    p = joins.pays_of(read_records(spark, write_csv(tmp_path, "o.csv", PAYS), "order"))
    r = read_records(spark, write_csv(tmp_path, "r.csv", RECEIPTS), "receipt")
    key = joins.reconcile(p, r, "key")
    assert rows(key.groupBy("tag").count()) == [("matched-pays", 6), ("unmatched-pays", 1),
                                                ("unmatched-receipts", 1)]
    iv = joins.reconcile(p, r, "interval")
    got = rows(iv, "tag", "tx_id")
    assert [t for t in got if t[0] == "matched-pays"] == [("matched-pays", "a"), ("matched-pays", "b"),
                                                          ("matched-pays", "f"), ("matched-pays", "f")]
    assert sorted(t[1] for t in got if t[0] == "unmatched-pays") == ["c", "d", "e"]
    assert sorted(t[1] for t in got if t[0] == "unmatched-receipts") == ["c", "d", "z"]


def test_top_n_ties_by_id(spark):
    df = spark.createDataFrame([(1, 5, 10), (1, 3, 10), (1, 4, 7), (1, 9, 11), (2, 1, 1)],
                               "window_end long, item_id long, cnt long")
    got = rows(topn.top_n(df, 2, id_col="item_id"), "window_end", "rank", "item_id")
    assert got == [(1, 1, 9), (1, 2, 3), (2, 1, 1)]


def test_login_fail_timed_one_long_run(spark):
    # a bot failing every second: one run of 2000 fails, greedy groups of 7 (limit 7 s), ended by a success
    events = [(9, "fail", 1000 + i, i) for i in range(2000)] + [(9, "success", 1000 + 2000 + 3, 2000)]
    df = spark.createDataFrame(events, "user_id long, login_state string, timestamp long, seq long")
    got = rows(patterns.login_fail_timed(df, 7, 2, rows_per_chunk=64))
    exp = [(u, a, b, f"login fail in 7s for {n} times") for u, a, b, n in brute_timed(events, 7, 2)]
    assert got == exp and len(got) == 286


def test_order_and_tx_balanced_chunking(spark, tmp_path):
    df = read_records(spark, write_csv(tmp_path, "orders.csv", ORDERS), "order")
    assert rows(patterns.order_pay_match(df, 300, "balanced", 2)) == rows(patterns.order_pay_match(df, 300))
    p = joins.pays_of(read_records(spark, write_csv(tmp_path, "o.csv", PAYS), "order"))
    r = read_records(spark, write_csv(tmp_path, "r.csv", RECEIPTS), "receipt")
    for mode in ("key", "interval"):
        a = rows(joins.reconcile(p, r, mode, chunking="balanced", rows_per_chunk=1), "tag", "tx_id", "pay_time")
        b = rows(joins.reconcile(p, r, mode), "tag", "tx_id", "pay_time")
        assert a == b
