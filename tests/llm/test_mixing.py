from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import awkward
from tidemark.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=150, most=2):
    """Water-filling by raising the level source by source."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()) * share / 100, set(names), {}
    while open_:
        level = (total - sum(out.values())) / sum(w[s] for s in open_)
        above = {s for s in open_ if most * sizes[s] <= level * w[s]}
        if not above:
            return {**out, **{s: level * w[s] for s in open_}}
        out |= {s: float(most * sizes[s]) for s in above}
        open_ -= above
    return out


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    got = mixing.mix(docs).collect()
    rows = docs.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    want = targets(sizes)
    assert len(got) == len(rows)
    assert sorted(len((r["text"] or "").encode().split()) for r in rows) == sorted(r["size"] for r in got)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + (rate > int(rate))) and r["copies"] <= 2


def test_emitted_copies_are_those_of_the_mix_and_reruns_agree(spark):
    docs = awkward.documents(spark)
    taken = sum(r["copies"] for r in mixing.mix(docs).collect())
    out = mixing.emit(docs)
    # a column of that name in the documents is replaced
    assert out.columns == docs.columns and out.count() == taken and {r["copy_no"] for r in out.collect()} <= {1, 2}
    again = mixing.emit(docs.repartition(7))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))


def test_many_sources_and_none_above(spark):
    rows = [(i, "w " * (1 + (i * 7919) % 50), f"s{i % 23:02d}" if i % 23 else None) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["source"]: r for r in mixing.mix(docs).groupBy("source").agg(
        F.first("target").alias("t"), F.first("source_size").alias("s"), F.sum("size").alias("x")).collect()}
    want = targets({s: r["s"] for s, r in got.items()})
    assert all(r["t"] == pytest.approx(want[s]) and r["t"] <= 2 * r["s"] + 1e-6 and r["x"] == r["s"] for s, r in got.items())
    assert sum(r["t"] for r in got.values()) == pytest.approx(1.5 * sum(r["s"] for r in got.values()))


def test_words_only_at_one_source_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b"), (3, "x y", "c")], "doc_id long, text string, source string")
    by = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert by[1]["target"] == by[2]["target"] == 0 and by[3]["target"] == 3.0
    assert mixing.mix(awkward.empty(spark)).count() == 0 and mixing.emit(awkward.empty(spark)).count() == 0
