import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import awkward
from tidemark.llm import outliers


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {p for at in where.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_statistics(spark):
    rng = random.Random(8)
    texts = [t for _, t in awkward.texts()]
    for _ in range(80):
        words = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(60))] + ["own", "#x", "<b>", "a|b"]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for w in words * rng.randrange(1, 3)))
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in outliers.base_statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_awkward_rows_and_empty_table(spark):
    out = outliers.judge(awkward.documents(spark)).collect()
    assert sorted(repr(tuple(r[c] for c in BASE)) for r in out) == sorted(repr(brute(t)) for _, t in awkward.texts())
    assert all(r["kept"] == (not r["base_failed"]) for r in out)  # the prior scatter holds for a few rows
    assert outliers.judge(awkward.empty(spark)).count() == 0


def test_chi2():
    assert outliers.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)
    assert outliers.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-4)


def test_estimate_is_the_covariance_of_clean_rows(spark):
    """A third of the rows lies far off: centre and scatter are those of the others."""
    rng = np.random.default_rng(3)
    mix = np.tril(rng.normal(0, 1, (outliers.D, outliers.D))) + 2 * np.eye(outliers.D)
    clean = rng.normal(0, 1, (3000, outliers.D)) @ mix.T + 5
    bad = rng.normal(0, 0.3, (900, outliers.D)) + 60
    x = np.vstack([clean, bad])
    rows = spark.createDataFrame([("g", *map(float, v)) for v in x], ["g", *outliers.X]).repartition(4)
    est = outliers._factored(outliers.estimates(rows)).first()
    assert est["n"] == 3900
    m = np.array([est[f"m{i}"] for i in range(outliers.D)])
    w = np.zeros((outliers.D, outliers.D))
    for i, j in outliers._PAIRS:
        w[i, j] = est[f"w{i}{j}"]
    cov = np.linalg.inv(w.T @ w)
    want = np.cov(clean.T) + np.diag(np.square(outliers.FLOORS))
    assert np.allclose(m, clean.mean(0), atol=0.3)
    assert np.allclose(np.sqrt(np.diag(cov)), np.sqrt(np.diag(want)), rtol=0.1)
    assert est["log_det"] == pytest.approx(math.log(np.linalg.det(cov)), rel=1e-6)
    far = rows.crossJoin(F.broadcast(outliers._factored(outliers.estimates(rows)).drop("g"))).select(
        (F.col("x0") > 40).alias("bad"), (outliers.distance() > outliers.CUTOFF).alias("out"))
    assert far.where("bad").agg(F.min("out")).first()[0] is True
    assert far.where("not bad").agg(F.avg(F.col("out").cast("int"))).first()[0] < 0.01


@pytest.mark.parametrize("feature", [0, 4])
def test_a_third_of_identical_far_copies(spark, feature):
    """They bend neither centre nor scatter, and hide no other row that lies out in their direction."""
    rng = np.random.default_rng(5)
    sd = np.array([1.0, 0.1, 0.05, 0.03, 0.03])
    clean = rng.normal(0, 1, (2000, outliers.D)) * sd + 3
    unit = np.hypot(sd, outliers.FLOORS) * (np.arange(outliers.D) == feature)
    x = np.vstack([clean, np.tile(3 + 12 * unit, (1000, 1)), [3 + 8 * unit]])
    kind = ["clean"] * 2000 + ["copy"] * 1000 + ["other"]
    rows = spark.createDataFrame([("g", k, *map(float, v)) for k, v in zip(kind, x)], ["g", "kind", *outliers.X]).repartition(4)
    est = outliers._factored(outliers.estimates(rows.drop("kind")))
    gone = rows.join(est, "g").groupBy("kind").agg(F.avg((outliers.distance() > outliers.CUTOFF).cast("int")).alias("out"))
    by = {r["kind"]: r["out"] for r in gone.collect()}
    assert by["copy"] == 1 and by["other"] == 1 and by["clean"] < 0.01


def test_groups_of_a_document_are_judged(spark):
    docs = spark.read.parquet(f"{SF['0.01']}/documents.parquet").select("doc_id", "lang", "source", "text")
    own = docs.withColumn("source", F.when(F.col("doc_id") % 100 == 0, F.concat(F.lit("tiny"), F.col("doc_id").cast("string")))
                          .otherwise(F.col("source")))
    out = outliers.judge(own).where("not base_failed")
    assert out.where("distance is null").count() == 0


def test_native_plan(spark):
    plan = outliers.judge(awkward.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_junk_goes_and_clean_text_stays(spark):
    docs, labels = (spark.read.parquet(f"{SF['0.01']}/{t}.parquet") for t in ("documents", "labels"))
    kept = outliers.judge(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    by = {r["quality"]: r["k"] for r in kept.collect()}
    assert by[1] > 0.97 and by[0] < 0.3
