"""Ranking changes, window firings, rolling resets and sketches on small tables with every case."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidemark.operators import blocking, changelog, distinct, topn, windows
from tidemark.operators import sequence as seq
from tidemark.plans import jobs


@pytest.fixture(scope="module")
def views(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 2, 3, 4, 5, None]), t) for t in (rng.randrange(0, 9000) for _ in range(400))]
    return spark.createDataFrame(data, "item_id long, timestamp long").withColumn("ts", F.timestamp_seconds("timestamp"))


def test_changes_fold_to_the_ranking_of_every_epoch(spark, views):
    rows_ = [(r["item_id"], r["timestamp"]) for r in views.collect()]
    changes = changelog.ranking_changes(changelog.running_ranks(views, "item_id", 3, "20 minutes", "5 minutes"), "item_id").cache()
    assert not changes.filter("op is null").count()
    for epoch in range(300_000, 11_000_000, 900_000):
        want = []
        for end in range(300_000, 9000_000 + 1_200_001, 300_000):
            counts = {}
            for item, t in rows_:
                if end - 1_200_000 <= t * 1000 < min(end, epoch):
                    counts[item] = counts.get(item, 0) + 1
            # NULL ids come first among equals
            top = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[:3]
            want += [(end, i + 1, item, n) for i, (item, n) in enumerate(top)]
        got = changelog.rankings_at(changes, "item_id", epoch).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    final = topn.top_n(windows.window_count(views, ["item_id"], "20 minutes", "5 minutes", count_col="cnt"), 3, id_col="item_id")
    assert sorted(map(repr, map(tuple, changelog.rankings_at(changes, "item_id").collect()))) == sorted(
        map(repr, map(tuple, final.select("window_end", "rank", "item_id", "cnt").collect())))


def test_firings_by_hand_and_in_chunks(spark):
    # windows of 10 s: the watermark is the largest time so far, minus 1 s; windows are kept for 5 s
    data = [("a", 1000, 0), ("a", 12_000, 1), ("a", 2000, 2), ("b", 3000, 3), (None, 4000, 4), ("a", 15_998, 5), ("a", 5000, 6), ("b", 6000, 7),
            ("a", 20_000, 8), ("a", 7000, 9)]
    df = spark.createDataFrame(data, "url string, t long, seq long")
    want = {("a", 10_000, 1, 1), ("a", 10_000, 2, 2), ("b", 10_000, 1, 1), (None, 10_000, 1, 1), ("a", 10_000, 3, 3),
            ("b", 10_000, 2, 2), ("a", 20_000, 1, 2), ("a", 30_000, 1, 1)}
    for chunk in (1, 3, 1 << 20):
        got = changelog.window_firings(df, ["url"], "t", "10 seconds", "10 seconds", "1 second", "5 seconds", rows_per_chunk=chunk)
        assert {tuple(r) for r in got.collect()} == want


@pytest.fixture()
def small_broadcasts(spark):
    """Fails whatever broadcasts more than the small tables that are meant to be (a hash table takes 1 or 2 MB at least)."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "4m")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_firings_are_never_broadcast(spark, small_broadcasts):
    # few rows in small files, but 120 windows for each; every 7th row is late for a part of its windows
    data = [(f"/page/{i % 5}", 20_000 * i - (90_000 if i % 7 == 3 else 0), i) for i in range(5, 1500)]
    df = spark.createDataFrame(data, "url string, t long, seq long")
    first, again, top = {}, {}, None
    for url, t, _ in data:
        for end in range(t // 5000 * 5000 + 5000, t // 5000 * 5000 + 605_000, 5000):
            if top is None or end - 1 > top - 1000:
                first[url, end] = first.get((url, end), 0) + 1
            elif end - 1 + 60_000 > top - 1000:
                again[url, end] = again.get((url, end), 0) + 1
        top = max(t, top or t)
    assert len(again) > 100
    want = [(*k, 1, n) for k, n in first.items()]
    for k, n in again.items():
        had = first.get(k, 0)
        want += [(*k, i + (had > 0), had + i) for i in range(1, n + 1)]
    got = changelog.window_firings(df, ["url"], "t", "10 minutes", "5 seconds", "1 second", "1 minute")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_the_last_firing_has_the_count_of_the_window(spark):
    firings = jobs.page_firings(spark, SF["0.001"])
    last = firings.groupBy("url", "window_end").agg(F.max("cnt").alias("cnt"), F.max("firing").alias("n"), F.count("*").alias("m"))
    assert not last.filter("n <> m").count()
    assert rows(last, "url", "window_end", "cnt") == rows(jobs.page_counts(spark, SF["0.001"]), "url", "window_end", "cnt")


def test_rolling_reset(spark):
    rng = random.Random(6)
    data = [(rng.choice([1, 2, None, 1, 1]), 1, t, i) for i, t in enumerate(sorted(rng.randrange(0, 3000) for _ in range(150)))]
    data += [(9, 1, 0, 200), (9, 1, 100, 201)]
    df = spark.createDataFrame(data, "user_id long, ad_id long, timestamp long, seq long")
    passed, warned, state = [], [], {}
    for user, ad, t, i in data:
        began, n = state.get(user, (None, 0))
        if began is None or t >= began + 100:
            began, n = t, 0
        state[user] = (began, n + 1)
        if n < 3:
            passed.append(i)
        elif n == 3:
            warned.append((user, ad))
    for chunk in (7, 1 << 20):
        got = blocking.block_clicks(df, 3, reset="rolling", period_s=100, rows_per_chunk=chunk)
        assert sorted(r["seq"] for r in got.collect()) == sorted(passed) and got.columns == df.columns
        warn = blocking.blacklist_warnings(df, 3, reset="rolling", period_s=100, rows_per_chunk=chunk)
        assert sorted(((r["user_id"], r["ad_id"]) for r in warn.collect()), key=repr) == sorted(warned, key=repr)


def test_rolling_reset_broadcasts_no_keys_or_starts(spark, small_broadcasts, monkeypatch):
    monkeypatch.setattr(seq, "BROADCAST_ROWS", 1000)  # the table of heavy keys is broadcast up to this on purpose
    # every user alike: periods of 100 s begin at 0, 120 and 300, the first two of them with a third click
    times = [0, 30, 60, 120, 130, 140, 300]
    clicks = spark.range(20_000).select(F.col("id").alias("user_id"), F.lit(1).alias("ad_id"), F.posexplode(F.array(*map(F.lit, times))))
    clicks = clicks.select("user_id", "ad_id", F.col("col").cast("long").alias("timestamp"), (F.col("user_id") * 7 + F.col("pos")).alias("seq"))
    for chunk in (1 << 20, 3):
        warned = blocking.blacklist_warnings(clicks, 2, reset="rolling", period_s=100, rows_per_chunk=chunk).groupBy("user_id").count()
        assert [tuple(r) for r in warned.groupBy("count").agg(F.count("*")).collect()] == [(2, 20_000)]


def test_sketches_make_windows_of_whole_panes(spark):
    df = spark.createDataFrame([(i % 40, i * 50) for i in range(400)], "user_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    sketches = distinct.uv_sketches(df, "5 minutes")
    for size, slide in (("1 hour", "10 minutes"), ("1 hour", None), ("1 hour", "2 hours")):
        exact = {}
        step, long = {"10 minutes": 600, None: 3600, "2 hours": 7200}[slide], 3600
        for r in df.collect():
            for end in range(step, 40_000, step):
                if end - long <= r["t"] < end:
                    exact.setdefault(end * 1000, set()).add(r["user_id"])
        got = {r["window_end"]: r["cnt"] for r in distinct.uv_from_sketches(sketches, "5 minutes", size, slide).collect()}
        assert got == {e: len(u) for e, u in exact.items()}      # small sketches are exact
    with pytest.raises(ValueError):
        distinct.uv_from_sketches(sketches, "5 minutes", "1 hour", "7 minutes")
