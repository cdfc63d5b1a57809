"""Order ids that are used again: batch, stream and a walk through the rows agree."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tests.test_streaming import FAR, collect_stream, replay, rocks  # noqa: F401
from tidemark.operators import patterns
from tidemark.sources import adapters
from tidemark.streaming import jobs as sjobs

SCHEMA = "order_id long, event_type string, timestamp long, seq long"


def walk(data, timeout_s, late_s=None, early_s=None):
    out, per = [], {}
    for order_id, event, t, n in data:
        if t is not None and event in ("create", "pay"):
            per.setdefault(order_id, []).append((t, event == "pay", n))
    for order_id, own in per.items():
        kind, since = None, None
        for t, pay, _ in sorted(own):
            meets = kind is not None and kind != pay and (
                (late_s is None or t < since + timeout_s + late_s) if pay else (early_s is None or t <= since + early_s))
            if meets:
                out.append((order_id, since, patterns.PAYED_LATE if pay and t >= since + timeout_s else patterns.PAYED_OK))
                kind = None
                continue
            if kind is True:
                out.append((order_id, since, patterns.NO_CREATE))
            elif kind is False and (pay or t >= since + timeout_s):
                out.append((order_id, since, patterns.TIMED_OUT))
            kind, since = pay, t
        if kind is not None:
            out.append((order_id, since, patterns.NO_CREATE if kind else patterns.TIMED_OUT))
    return sorted(out, key=repr)


def events(n=400, ids=6, seed=1):
    rng = random.Random(seed)
    out = [(rng.choice([*range(ids), None, 0, 0]), rng.choice(["create", "pay", "pay", "create", "view"]), rng.randint(0, 3000), i)
           for i in range(n)]
    return out + [(1, "create", None, n), (99, "pay", 5, n + 1)]


def test_the_two_results_of_a_reused_id(spark):
    df = spark.createDataFrame([(1, "create", 0, 0), (1, "pay", 100, 1), (1, "create", 5000, 2), (1, "pay", 9000, 3)], SCHEMA)
    assert rows(patterns.order_cycles(df)) == [(1, 0, patterns.PAYED_OK), (1, 5000, patterns.PAYED_LATE)]
    assert rows(patterns.order_cycles(df, late_s=100)) == [
        (1, 0, patterns.PAYED_OK), (1, 5000, patterns.TIMED_OUT), (1, 9000, patterns.NO_CREATE)]


@pytest.mark.parametrize("waits", [(20, None, None), (20, 15, 10), (5, 0, 0)])
@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_cycles_equal_a_walk(spark, waits, chunk):
    data = events()
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted((tuple(r) for r in patterns.order_cycles(df, *waits, rows_per_chunk=chunk).collect()), key=repr)
    assert got == walk(data, *waits)


def test_ids_used_once_give_the_result_per_order(spark):
    orders = adapters.order_events(adapters.table(spark, SF["0.001"], "orders"))
    assert rows(patterns.order_cycles(orders, 900).drop("cycle_time")) == rows(patterns.order_state(orders, 900))


@pytest.mark.parametrize("per_batch", [37, 150, 1000])
def test_stream_equals_batch_however_batches_are_cut(rocks, tmp_path, per_batch):  # noqa: F811
    spark = rocks
    data = [r for r in events(seed=3) if r[2] is not None]
    df = spark.createDataFrame(sorted(data, key=lambda r: (r[2] + r[3] % 7, r[3])), SCHEMA).withColumn(
        "ts", F.timestamp_seconds("timestamp"))
    place = {r[3]: i for i, r in enumerate(sorted(data, key=lambda r: (r[2] + r[3] % 7, r[3])))}
    part = F.floor(F.element_at(F.create_map(*[F.lit(x) for kv in place.items() for x in kv]), F.col("seq").cast("int")) / per_batch)
    flush = spark.createDataFrame([(-1, "create", FAR, 0)], SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, df, tmp_path, "cycles", part, flush)
    got = collect_stream(spark, sjobs.order_cycles_stream(src, 20, 15, 10, delay="10 seconds"), tmp_path, "c")
    assert sorted((tuple(r) for r in got if r[0] != -1), key=repr) == walk(data, 20, 15, 10)


def test_login_groups_wait_for_the_watermark(rocks, tmp_path):  # noqa: F811
    """A fail that arrives batches late, inside the watermark's delay, still changes its group."""
    spark = rocks
    schema = "user_id long, login_state string, timestamp long, seq long"
    data = [(1, "fail", 100, 0), (1, "fail", 103, 1), (1, "fail", 101, 2), (1, "success", 108, 3), (2, "fail", 200, 4),
            (2, "success", 201, 5), (2, "fail", 202, 6), (2, "fail", 203, 7)]
    df = spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("timestamp"))
    flush = spark.createDataFrame([(-1, "success", FAR, 9)], schema).withColumn("ts", F.timestamp_seconds("timestamp"))
    for i, cut in enumerate((F.col("seq"), F.floor(F.col("seq") / 3), F.lit(0))):
        src = replay(spark, df, tmp_path, f"logins{i}", cut, flush)
        got = collect_stream(spark, sjobs.login_fail_timed_stream(src, 2, 2, delay="20 seconds"), tmp_path, f"l{i}")
        assert sorted(tuple(r) for r in got) == rows(patterns.login_fail_timed(df, 2, 2))
