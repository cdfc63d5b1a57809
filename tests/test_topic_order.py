"""Arrival order over the partitions of a topic against a plain walk along each partition."""

import random

from pyspark.sql import functions as F

from tidemark.operators.arrival import arrival_order
from tidemark.sources import topic_lines
from tidemark.sources.lines import topic_seq

SCHEMA = "partition int, offset long, timestamp_ms long, seq_name string"


def walk(rows):
    """Names in arrival order."""
    marked = []
    for p in {r[0] for r in rows}:
        progress = None
        for r in sorted((r for r in rows if r[0] == p and r[1] is not None), key=lambda r: r[1]):
            progress = r[2] if progress is None else progress if r[2] is None else max(progress, r[2])
            marked.append((float("-inf") if progress is None else progress, -1 if p is None else p, r[1], r[3]))
    return [m[3] for m in sorted(marked)]


def messages(seed=3, n=900):
    rng = random.Random(seed)
    at, rows = {}, []
    for i in range(n):
        p = 0 if rng.random() < 0.6 else rng.choice([1, 2, 7, None])
        at[p] = at.get(p, 0) + rng.choice([1, 1, 1, 40])
        t = None if rng.random() < 0.1 else i * 50 - rng.choice([0, 0, 10, 9_000]) if rng.random() < 0.7 else 20_000
        rows.append((p, at[p], t, f"m{i}"))
    return rows


def test_every_partition_keeps_its_order_and_progress_interleaves(spark):
    rows = messages()
    rows = [(7, -5, None, "first of 7"), *rows, (1, None, 3, "no place")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for per_chunk in (1 << 20, 37):
        out = arrival_order(df, rows_per_chunk=per_chunk).collect()
        assert len(out) == len(rows) and out[0].asDict().keys() == {*df.columns, "seq"}
        placed = sorted((r for r in out if r["seq"] is not None), key=lambda r: r["seq"])
        assert [r["seq"] for r in placed] == list(range(len(rows) - 1))
        assert [r["seq_name"] for r in placed] == walk(rows)
        assert [r["seq_name"] for r in out if r["seq"] is None] == ["no place"]


def test_many_messages_of_one_instant(spark):
    rows = [(i % 3, i, 77, f"m{i}") for i in range(600)]
    out = arrival_order(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()
    assert [r["seq_name"] for r in out] == walk(rows)


def test_repeated_and_empty(spark):
    rows = [(0, 1, 5, "a"), (0, 1, 5, "a"), (0, 2, 4, "b")]
    out = arrival_order(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()
    assert [(r["seq"], r["seq_name"]) for r in out] == [(0, "a"), (1, "a"), (2, "b")]
    assert arrival_order(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lines_of_a_stored_topic(spark):
    topic = spark.createDataFrame([(b"x,3", 1, 0, 3_000), (b"x,1", 0, 0, 1_000), (b"x,2", 0, 1, 2_000), (b"x,4", 0, 2, 900)],
                                  "value binary, partition int, offset long, ms long")
    topic = topic.select("value", "partition", "offset", F.timestamp_millis("ms").alias("timestamp"))
    assert [r["value"] for r in topic_lines(topic).orderBy("seq").collect()] == ["x,1", "x,2", "x,4", "x,3"]


def test_stream_seq_is_unique_over_partitions(spark):
    df = spark.range(400).select((F.col("id") % 4).cast("int").alias("partition"), F.floor(F.col("id") / 4).alias("offset"))
    out = df.withColumn("seq", topic_seq(F.col("partition"), F.col("offset"))).collect()
    assert len({r["seq"] for r in out}) == 400
    for p in range(4):
        own = sorted((r for r in out if r["partition"] == p), key=lambda r: r["seq"])
        assert [r["offset"] for r in own] == list(range(100))
