"""NULL keys are keys: every chunked operator gives them the rows that a plain window gives them."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import blocking, joins, patterns, sequence as seq, windows


@pytest.fixture(scope="module")
def df(spark):
    data = [([None, "a", "b"][i % 3], [None, 1][i % 2], i, i * 7 % 5) for i in range(60)]
    return spark.createDataFrame(data, "k string, j int, seq long, v long").withColumn("_chunk", seq.arrival_chunk("seq", 9))


KEYS = ["k", "j"]


def test_running_sum_and_rank(df):
    w = Window.partitionBy(*KEYS).orderBy("seq")
    want = df.select(*KEYS, "seq", F.sum("v").over(w).alias("s"), F.row_number().over(w).alias("r"),
                     F.lead("seq").over(w).alias("n"))
    got = seq.running_sum(df, KEYS, ["seq"], "_chunk", "v", "s", next_of="seq")
    got = seq.rank(got, KEYS, ["seq"], "_chunk", "r").select(*KEYS, "seq", "s", "r", F.col("next_seq").alias("n"))
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_shift_next_value_and_balanced_chunks(df):
    w = Window.partitionBy(*KEYS).orderBy("seq")
    plain = df.drop("_chunk")
    chunked = seq.balanced_chunk(plain, KEYS, "seq", bucket=5, target_rows=4)
    assert chunked.count() == 60
    got = seq.shift(chunked, KEYS, ["seq"], "_chunk", ["v"], 2, "prev")
    want = plain.select("seq", F.lag("v", 1).over(w).alias("a"), F.lag("v", 2).over(w).alias("b"))
    assert rows(got.select("seq", "prev1_v", "prev2_v")) == rows(want)
    later = F.when(F.col("v") == 3, F.col("seq"))
    got = seq.next_value(chunked, KEYS, ["seq"], "_chunk", later, "nx").select("seq", "nx")
    after = w.rowsBetween(1, Window.unboundedFollowing)
    want = plain.withColumn("x", later).select("seq", F.first("x", ignorenulls=True).over(after).alias("nx"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("1 hour", "5 seconds"), ("1 hour", None)])
def test_window_forms_agree_on_null_keys_and_null_values(spark, size, slide):
    data = [(None, "x", 1, 1000), ("a", None, None, 1010), ("a", None, 2, 5000), (None, None, None, 9000), ("b", "y", None, 9001)]
    df = spark.createDataFrame(data, "channel string, behavior string, v int, t long").withColumn("ts", F.timestamp_seconds("t"))
    for expr in (None, F.col("v")):
        forms = [sorted(map(tuple, windows.window_count(df, ["channel", "behavior"], size, slide, method=m,
                                                        count_expr=expr).collect()), key=repr)
                 for m in ("direct", "expand", "delta", "auto")]
        assert forms[0] and all(f == forms[0] for f in forms[1:])


def test_order_pay_match_keeps_a_null_order(spark):
    orders = spark.createDataFrame([(None, "create", "", 10), (None, "pay", "t", 20), (1, "create", "", 10)],
                                   "order_id long, event_type string, tx_id string, timestamp long")
    got = {r["order_id"]: r["result_state"] for r in patterns.order_pay_match(orders).collect()}
    assert got == {None: "payed", 1: "timeout 310000"}


def test_blocker_and_login_with_null_keys(spark):
    clicks = spark.createDataFrame([(None, 1, "p", "c", i, i) for i in range(5)],
                                   "user_id long, ad_id long, province string, city string, timestamp long, seq long")
    assert blocking.block_clicks(clicks, 3).count() == 3 and blocking.blacklist_warnings(clicks, 3).count() == 1
    logins = spark.createDataFrame([(None, "ip", "fail", t, i) for i, t in enumerate((1, 2, 9))],
                                   "user_id long, ip string, login_state string, timestamp long, seq long")
    assert patterns.login_fail_pairs(logins).count() == 1
    assert patterns.login_fail_streak(logins, 3, 100).count() == 1
    assert patterns.login_fail_timed(logins, 2).count() == 1


def test_reconcile_keeps_a_null_tx(spark):
    pays = spark.createDataFrame([(1, "a", 10)], "order_id long, tx_id string, timestamp long")
    receipts = spark.createDataFrame([(None, "x", 11), ("a", "x", 11)], "tx_id string, pay_channel string, timestamp long")
    for mode in ("interval", "key"):
        tags = sorted(r["tag"] for r in joins.reconcile(pays, receipts, mode).collect())
        assert tags == ["matched-pays", "unmatched-receipts"]
