import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import awkward
from tidemark.llm import qda


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    labels = spark.createDataFrame([(d, q, 0.0) for d in range(1, 21) for q in ((d % 2, None) if d % 5 else (1, 0))]
                                   + [(None, 1, 0.0)], "doc_id long, quality int, score double")
    got = qda.classify(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    out = qda.accepted(docs, labels)
    assert out.columns == docs.columns
    assert out.count() == sum(r["predicted"] for r in got)


def test_without_labels_or_with_one_class(spark):
    docs = awkward.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in qda.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(1, 20)], "doc_id long, quality int")
    assert {r["score"] for r in qda.classify(docs, one).collect()} == {1.0}
    assert qda.classify(awkward.empty(spark), one).count() == 0


def test_moments_and_scores_equal_plain_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (60, qda.D)), rng.normal(0.7, 2, (40, qda.D))])
    q = np.r_[np.zeros(60, int), np.ones(40, int)]
    rows = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(q, x)], "quality int, x array<double>")
    model = qda.fit(rows.repartition(5))
    within = sum((q == c).mean() * np.cov(x[q == c].T, bias=True) for c in (0, 1))
    scale = np.sqrt(np.diag(within))
    dens = []
    for c in (0, 1):
        cov = (1 - qda.POOLED) * np.cov(x[q == c].T, bias=True) + qda.POOLED * within
        cov = (1 - qda.RIDGE) * cov / np.outer(scale, scale) + qda.RIDGE * np.eye(qda.D)
        z = (x - x[q == c].mean(0)) / scale
        dens.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(-((dens[1] - dens[0]) / qda.TEMPER + np.log(40 / 60))))
    assert np.allclose(qda.predict(x, model), want)


def test_held_out_rows_are_not_learnt_from(spark):
    labels = spark.read.parquet(f"{SF['0.01']}/labels.parquet")
    stats = labels.select("doc_id").distinct().withColumn("x", F.array(*[F.lit(0.0)] * qda.D))
    used = qda.training_rows(stats, labels).count()
    assert used == labels.where("quality is not null and crc32(cast(doc_id as string)) % 4 <> 2").count()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF['0.01']}/{t}.parquet") for t in ("documents", "labels"))
    got = qda.classify(docs, labels).join(labels, "doc_id").where(qda.held_out())
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95
