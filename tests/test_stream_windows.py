"""Window counts by rings and bitmaps of state, late rows of the same query, counts that the clock resets."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import FAR, collect_stream, replay, rocks  # noqa: F401
from tidemark.operators import distinct, windows
from tidemark.streaming import aggregations as sagg
from tidemark.streaming import jobs as sjobs

SCHEMA = "url string, user_id long, timestamp long, seq long"


def views(spark, n=300, seed=2, span=4000):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(60), t, i)
            for i, t in enumerate(sorted(36000 + rng.randrange(span) for _ in range(n)))]
    return spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))


def flush(spark):
    return spark.createDataFrame([("end", -1, FAR, -1)], SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))


@pytest.mark.parametrize("per_batch", [40, 300])
def test_ring_counts_equal_batch(rocks, tmp_path, per_batch):  # noqa: F811
    spark = rocks
    df = views(spark)
    src = replay(spark, df, tmp_path, "v", F.floor(F.col("seq") / per_batch), flush(spark))
    out = sagg.sliding_count_stream(src, ["url"], "10 minutes", "5 seconds")
    got = []
    q = (out.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck"))
         .foreachBatch(lambda b, _: got.extend(b.collect())).start())
    q.awaitTermination(600)
    progress = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"] if "transform" in op["operatorName"]]
    want = windows.window_count(df, ["url"], "10 minutes", "5 seconds", count_col="cnt")
    assert sorted(map(repr, map(tuple, (r for r in got if r["url"] != "end")))) == sorted(map(repr, map(tuple, want.collect())))
    # state follows the panes that open windows hold (and their timers), not 120 windows for each
    assert progress and max(progress) < 6 * df.count()
    assert len(got) > 10 * max(progress)


@pytest.mark.parametrize("per_batch", [10, 60, 300])
def test_counts_and_late_rows_of_one_query(rocks, tmp_path, per_batch):  # noqa: F811
    spark = rocks
    rng = random.Random(8)
    base = 1_600_000_000
    data = [(rng.choice("ab"), i, base + i * 5 - rng.choice([0, 0, 0, 30, 90, 300, 900]), i) for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, df, tmp_path, "r", F.floor(F.col("seq") / per_batch), flush(spark))
    size, slide, bound, lateness = 120_000, 30_000, 1000, 60_000
    got = collect_stream(spark, sagg.counts_and_late_rows(src, ["url"], "2 minutes", "30 seconds", "1 second", "1 minute"),
                         tmp_path, "r")
    want, late, seen = {}, [], None
    for b in range(0, len(data), per_batch):
        batch = data[b:b + per_batch]
        closed = None if seen is None else (seen * 1000 - bound - lateness + 1) // slide
        for url, user, t, i in batch:
            ends = [e for e in range(t * 1000 // slide + 1, t * 1000 // slide + size // slide + 1) if closed is None or e > closed]
            for e in ends:
                want[url, e * slide] = want.get((url, e * slide), 0) + 1
            if not ends:
                late.append(i)
        seen = max([t for _, _, t, _ in batch] + ([] if seen is None else [seen]))
    runs = [r for r in got if r["tag"] == "count" and r["url"] != "end"]
    counted = {(r["url"], e): r["cnt"] for r in runs for e in range(r["first_end"], r["last_end"] + 1, slide)}
    assert counted == want and sum(len(range(r["first_end"], r["last_end"] + 1, slide)) for r in runs) == len(want)
    assert sorted(r["late"]["seq"] for r in got if r["tag"] == "late") == late and (late or per_batch == 300)
    assert all(r["late"]["timestamp"] == data[r["late"]["seq"]][2] for r in got if r["tag"] == "late")


def test_bitmap_state_is_bounded(rocks, tmp_path):  # noqa: F811
    spark = rocks
    df = spark.createDataFrame([("a", i * 7919, 36000 + i * 9, i) for i in range(800)], SCHEMA).withColumn("ts", F.timestamp_seconds("timestamp"))
    src = replay(spark, df, tmp_path, "b", F.floor(F.col("seq") / 200), flush(spark))
    for bits in (6, 17):
        got = []
        q = (sagg.uv_bitmap_stream(src, bits=bits).writeStream.outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / f"ck{bits}")).foreachBatch(lambda b, _: got.extend(b.collect())).start())
        q.awaitTermination(600)
        assert sorted(tuple(r) for r in got if r["window_end"] < FAR * 1000) == rows(distinct.uv_bitmap(df, bits=bits))
        held = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"] if "transform" in op["operatorName"]]
        # a block and its timer rows per bucket of the open windows (three at most here), whatever the number of visitors
        assert held and max(held) <= 4 * 3 * max(1, 2 ** bits // 32768)


def test_blocker_reset_by_the_clock(rocks, tmp_path):  # noqa: F811
    spark = rocks
    path = tmp_path / "clicks"

    def put(name, ids):
        spark.createDataFrame([(1, 7, i) for i in ids], "user_id long, ad_id long, seq long").coalesce(1).write.parquet(str(path / name))

    put("a", range(0, 5))
    # with processing-time timers a query never runs out of batches, so it is a live one
    src = spark.readStream.schema("user_id long, ad_id long, seq long").option("recursiveFileLookup", "true").parquet(str(path))
    got = []
    q = (sjobs.blocker_stream(src.withColumn("timestamp", F.lit(0).cast("long")), 2, "rolling", period_s=12)
         .writeStream.outputMode("append").trigger(processingTime="500 milliseconds")
         .option("checkpointLocation", str(tmp_path / "ck"))
         .foreachBatch(lambda b, _: got.extend((r["seq"], r["tag"]) for r in b.collect())).start())

    def until(n, seconds):
        end = time.time() + seconds
        while len(got) < n and time.time() < end:
            time.sleep(0.5)
        return sorted(got)

    try:
        first = [(0, "data"), (1, "data"), (2, "blacklist")]
        assert until(3, 60) == first
        put("b", range(5, 7))
        assert until(4, 4) == first                      # still the same period
        time.sleep(12)
        put("c", range(7, 11))
        assert until(6, 60) == first + [(7, "data"), (8, "data"), (9, "blacklist")]
    finally:
        q.stop()
