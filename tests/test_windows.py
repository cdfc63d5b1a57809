"""Pane and direct window counts agree with each other and with a brute-force count, also with lateness."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import distinct, lateness, windows
from tidemark.session import materialize


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    data = []
    t = 1_700_000_000_000
    for i in range(3000):
        t += rnd.randrange(0, 4000)
        # arrival disorder: some rows are stamped earlier than their position
        ts = t - (rnd.choice([0, 0, 0, 2000, 30000, 700000]))
        data.append((i, rnd.choice(["a", "b", "c", "d"]), ts, rnd.randrange(0, 40)))
    return spark.createDataFrame(data, "seq long, k string, timestamp long, user_id long").withColumn(
        "ts", F.timestamp_millis("timestamp"))


def brute(data, size, slide, lateness_ms=None, bound=0):
    counts = {}
    wm = None
    for seq, k, t, _ in sorted(data):
        first = (t // slide + 1) * slide
        last = (t // slide) * slide + size
        for e in range(first, last + 1, slide):
            if lateness_ms is None or wm is None or e - 1 + lateness_ms > wm:
                counts[(k, e)] = counts.get((k, e), 0) + 1
        wm = t - bound if wm is None else max(wm, t - bound)
    return sorted((k, e, c) for (k, e), c in counts.items())


@pytest.mark.parametrize("size,slide", [("1 minute", "5 seconds"), ("10 minutes", "1 minute"),
                                        ("30 seconds", None)])
def test_pane_equals_direct_equals_brute(spark, events, size, slide):
    data = [tuple(r) for r in events.select("seq", "k", "timestamp", "user_id").collect()]
    from tidemark.functions.time import duration_ms
    exp = brute(data, duration_ms(size), duration_ms(slide or size))
    for method in ("expand", "delta", "direct"):
        got = rows(windows.window_count(events, ["k"], size, slide, method=method, count_col="cnt",
                                        chunk_panes=7), "k", "window_end", "cnt")
        assert got == exp, method


def test_lateness_against_brute_force(spark, events):
    data = [tuple(r) for r in events.select("seq", "k", "timestamp", "user_id").collect()]
    on_time, late = lateness.split_late(events, "timestamp", "10 minutes", "5 seconds", "1 second", "1 minute",
                                        watermark=None)
    exp = brute(data, 600000, 5000, 60000, 1000)
    for method in ("expand", "delta", "direct"):
        got = rows(windows.window_count(on_time, ["k"], "10 minutes", "5 seconds", method=method,
                                        count_col="cnt", first_end="first_end"), "k", "window_end", "cnt")
        assert got == exp, method
    # late rows are exactly those that no window takes
    counted = sum(c for _, _, c in exp)
    assert late.count() > 0
    assert counted == sum(r.cnt for r in windows.window_count(
        on_time, [], "10 minutes", "5 seconds", count_col="cnt", first_end="first_end").collect())


def test_watermark_chunks(spark, events):
    a = rows(lateness.watermark_before(events, "timestamp", 1000, rows_per_chunk=1 << 20), "seq", "watermark")
    b = rows(lateness.watermark_before(events, "timestamp", 1000, rows_per_chunk=64), "seq", "watermark")
    assert a == b and a[0][1] is None


def test_uv_forms(spark, events):
    exact = {r.window_end: r.cnt for r in distinct.uv_exact(events, "10 minutes").collect()}
    bm = {r.window_end: r.cnt for r in distinct.uv_bitmap(events, "10 minutes").collect()}
    small = {r.window_end: r.cnt for r in distinct.uv_bitmap(events, "10 minutes", bits=3).collect()}
    assert bm == exact                                  # small ids: no collisions in 2^29 bits
    assert all(small[w] <= exact[w] for w in exact) and any(small[w] < exact[w] for w in exact)
    run = distinct.uv_running(events, "10 minutes", rows_per_chunk=50).collect()
    per = {}
    for r in run:
        per.setdefault(r.window_end, []).append(r.cnt)
    assert {w: sorted(v) for w, v in per.items()} == {w: list(range(1, n + 1)) for w, n in bm.items()}


@pytest.fixture
def plans(monkeypatch):
    """(tag, plan) of all that lateness writes."""
    class Seen(list):
        pass

    seen, write = Seen(), lateness.materialize
    seen.written = []

    def noted(df, tag="stage", files=None):
        seen.append((tag, df._jdf.queryExecution().executedPlan().toString()))
        out = write(df, tag, files)
        seen.written.append((tag, out))
        return out

    monkeypatch.setattr(lateness, "materialize", noted)
    return seen


@pytest.mark.parametrize("block,wide", [(1, 5), (3, 4), (7, 1000), (256, 1000)])
def test_open_ends_of_awkward_arrivals(spark, monkeypatch, plans, block, wide):
    """Every depth of blocks gives the ends that the exact watermark gives: many late rows, NULL times, gaps in seq."""
    monkeypatch.setattr(lateness, "FANOUT", 4)
    rng = random.Random(block)
    data, now = [], 1_000_000
    for i in range(0, 900, 2):
        now += rng.randrange(0, 4000)
        data.append((i + rng.randrange(2), rng.choice("ab"), rng.choice([now, now, now - rng.randrange(0, 700_000), None])))
    data.append((None, "a", 5000))
    df = spark.createDataFrame(data, "seq long, k string, t long").repartition(5)
    got = lateness.open_ends(df, "t", "10 minutes", "5 seconds", "1 second", {"e0": 0, "e1": "1 minute"},
                             wanted=F.col("k") == "a", block=block, broadcast_rows=wide)
    assert got.columns == ["seq", "k", "t", "e0", "e1"]
    want, top = [], None
    for i, k, t in data:
        if k == "a":
            ends = []
            for kept in (0, 60_000):
                ends.append(None if t is None else (t // 5000 + 1) * 5000)
                if top is not None and i is not None:
                    gone = -(-(top - 1000 - kept + 2) // 5000) * 5000
                    ends[-1] = gone if t is None else max(ends[-1], gone)
            want.append((i, k, t, *ends))
        top = t if top is None else top if t is None else max(top, t)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    tags = [tag for tag, _ in plans]
    assert tags.count("wide-ends") == (900 // block >= wide)


def test_only_open_blocks_are_ordered(spark, plans):
    """A dense log: 256 arrivals are short beside the slide, so few blocks hold rows that their bounds leave undecided."""
    rng = random.Random(1)
    data = [(i, "a", i - (rng.choice((65_000, 71_000)) if rng.random() < 0.01 else 0)) for i in range(200_000)]
    df = materialize(spark.createDataFrame(data, "seq long, k string, t long"), "dense")
    for most in (1 << 18, 10):
        got = lateness.open_ends(df, "t", "10 minutes", "5 seconds", "1 second", {"e": "1 minute"}, broadcast_rows=most)
        exact = lateness.watermark_before(df, "t", "1 second").withColumn(
            "e", lateness.first_open_end("t", "watermark", "10 minutes", "5 seconds", "1 minute")).drop("watermark")
        assert got.exceptAll(exact).isEmpty() and got.count() == 200_000
    bounds = [b for tag, b in plans.written if tag == "block-bounds"][0]
    assert 0 < bounds.filter("_open").count() < bounds.count() / 10
    wide = [plan for tag, plan in plans if tag == "wide-ends"][0]
    assert "BroadcastHashJoin" in wide and "Window" not in wide and "SortMergeJoin" not in wide


def test_open_ends_of_an_empty_log(spark, events):
    on_time, late = lateness.split_late(events.limit(0), "timestamp", "10 minutes", "5 seconds", "1 second", "1 minute")
    assert on_time.count() == 0 and late.count() == 0
