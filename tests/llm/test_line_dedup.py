import hashlib
import random

from pyspark.sql import functions as F

from tests.llm import awkward
from tidemark.llm import line_dedup
from tidemark.session import path_exists

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    order = lambda d: (d is not None, d or 0)
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = line.strip(SPACES).translate(LOWER)
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(d)
    top = {k: max(ds, key=order) for k, ds in holders.items() if len(ds) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if top.get(x.strip(SPACES).translate(LOWER), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def got(docs, **params):
    return [(r["doc_id"], r["_n_lines"], r["_n_dropped"], r["text"]) for r in
            line_dedup.dedup(docs, **params).select("doc_id", "_n_lines", "_n_dropped", "text").collect()]


def norm(rows):
    return sorted(rows, key=repr)


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns + ["_n_lines", "_n_dropped"]
    assert norm(got(docs)) == norm(brute(awkward.texts()))


def test_batches_and_compaction_do_not_matter(spark):
    rng = random.Random(3)
    pool = [f"a common line number {i} that is longer than forty characters" for i in range(12)]
    rows = [(d, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own {d} {j} " + "z" * rng.randrange(60)
                          for j in range(rng.randrange(8)))) for d in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = norm(brute(rows))
    for batches, fanout in ((1, 2), (6, 3)):
        assert norm(got(docs, batches=batches, fanout=fanout)) == want


def test_runs_return_the_new_lines_of_each_batch(spark):
    store = line_dedup.LineRuns(spark, buckets=3, fanout=2)

    def batch(keys, top):
        return spark.createDataFrame([(k, -k, 1, top) for k in keys], "h1 long, h2 long, n_docs long, top long")

    fresh = [sorted(r["h1"] for r in store.add(batch(keys, top)).collect())
             for keys, top in (([1, 2, 3], 9), ([2, 3, 4], 8), ([1, 5], 7), ([5, 6], 6))]
    assert fresh == [[1, 2, 3], [4], [5], [6]]
    assert [len(level) for level in store.levels] == [0, 0, 1]
    lines = {r["h1"]: (r["n_docs"], r["top"]) for r in store.lines().collect()}
    assert lines == {1: (2, 9), 2: (2, 9), 3: (2, 9), 4: (1, 8), 5: (2, 7), 6: (1, 6)}


def test_runs_join_without_a_shuffle_of_their_own(spark):
    store = line_dedup.LineRuns(spark, buckets=3, fanout=10)
    rows = spark.range(50).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).cast("long").alias("n_docs"),
                                  F.lit(1).cast("long").alias("top"))
    store.add(rows)
    store.add(rows)
    plan = store.lines()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_runs_go_when_dropped(spark):
    def batch(k):
        return spark.range(k, k + 3).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).cast("long").alias("n_docs"),
                                            F.col("id").alias("top"))

    store = line_dedup.LineRuns(spark, buckets=2, fanout=2)
    for k in (0, 2):
        store.add(batch(k))
    old = {n: store.paths[n] for n in store.merged}
    assert len(old) == 2 and all(path_exists(spark, p) for p in old.values())
    store.drop(list(store.merged))
    assert not store.merged and not any(path_exists(spark, p) or spark.catalog.tableExists(n) for n, p in old.items())
    assert store.lines().count() == 5
    last = dict(store.paths)
    store.drop()
    assert len(last) == 1 and not store.runs() and not any(
        path_exists(spark, p) or spark.catalog.tableExists(n) for n, p in last.items())


def test_dedup_leaves_no_merged_runs(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = [(d, f"a line that is longer than forty characters, for everyone\nown {d}") for d in range(20)]
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), batches=4, fanout=2)
    assert out.agg(F.sum("_n_dropped")).first()[0] == 19
    assert len({t.name for t in spark.catalog.listTables()} - before) == 1


def test_empty_table(spark):
    assert got(awkward.empty(spark)) == []


def test_digest_is_of_the_kept_text(spark):
    from tidemark.llm.queries import op6_line_dedup
    from tests.conftest import SF
    row = op6_line_dedup(spark, SF["0.001"]).where("n_dropped = 0").first()
    text = spark.read.parquet(f"{SF['0.001']}/documents.parquet").where(F.col("doc_id") == row["doc_id"]).first()["text"]
    assert row["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()
