"""The registered queries that SQL cannot express, against brute force; the pipeline's stages, each on its input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tests.llm import awkward
from tests.llm.test_decontam import brute as brute_decontam
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minmax import brute as brute_groups
from tests.llm.test_outliers import brute as brute_base
from tests.llm.test_ppm import plain_bits
from tidemark.llm import decontam, mixing, outliers, ppm, qda
from tidemark.llm.queries import QUERIES

DIR = SF["0.001"]


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def test_op3_quality(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    x = {d: qda.statistics(t.encode()) for d, t, _, _ in docs}
    learn = [(x[d], q) for d, q in labels.items() if crc(d) % 4 != 2]
    means, covs, n = {}, {}, {}
    for c in (0, 1):
        own = np.array([v for v, q in learn if q == c])
        means[c], covs[c], n[c] = own.mean(0), np.cov(own.T, bias=True), len(own)
    within = sum(n[c] * covs[c] for c in covs) / sum(n.values())
    scale = np.sqrt(np.maximum(np.diag(within), 1e-8))
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, DIR).collect()}
    assert len(got) == len(docs)
    for d, v in x.items():
        dens = []
        for c in (0, 1):
            cov = ((1 - qda.POOLED) * covs[c] + qda.POOLED * within) / np.outer(scale, scale)
            cov = (1 - qda.RIDGE) * cov + qda.RIDGE * np.eye(qda.D)
            z = (v - means[c]) / scale
            dens.append(-0.5 * z @ np.linalg.solve(cov, z) - 0.5 * np.linalg.slogdet(cov)[1])
        logit = (dens[1] - dens[0]) / qda.TEMPER + np.log(n[1] / n[0])
        want = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        assert got[d]["score"] == pytest.approx(want, abs=1e-6)
        assert got[d]["predicted"] == (want >= 0.7) and got[d]["held_out"] == (crc(d) % 4 == 2)


def mcd(x):
    """Minimum covariance determinant with the operator's bins, in numpy."""
    floors = np.square(outliers.FLOORS)
    share, d = outliers.KEPT_SHARE, outliers.D

    def bins(d2):
        return np.clip(np.floor((np.log(np.maximum(d2, 1e-9)) - outliers.LOWEST) * outliers.PER_UNIT), 0, outliers.BINS - 1)

    def nearest(d2):
        b = bins(d2)
        order = np.sort(b)
        return x[b <= order[int(np.ceil(share * len(x))) - 1]]

    def estimate(rows, factor, add=floors):
        m = rows.mean(0)
        cov = factor * np.cov(rows.T, bias=True).reshape(d, d)
        np.fill_diagonal(cov, np.maximum(np.diag(cov), 0) + add)
        return m, cov

    def dist(est):
        z = x - est[0]
        return np.einsum("ij,jk,ik->i", z, np.linalg.inv(est[1]), z)

    factor = share / outliers.chi2_cdf(outliers.chi2_quantile(share, d), d + 2)
    r = np.round(x, 2)
    med = np.sort(r, 0)[(len(x) + 1) // 2 - 1]
    z2 = np.square((x - med) / np.sqrt(floors))
    found = []
    for start in (z2.sum(1), z2.max(1)):
        est = estimate(nearest(start), factor)
        for _ in range(outliers.STEPS):
            est = estimate(nearest(dist(est)), factor)
        found.append(est)
    est = min(found, key=lambda e: np.linalg.slogdet(e[1])[1])
    inside = outliers.chi2_quantile(1 - outliers.REWEIGHT_TAIL, d)
    rows = x[dist(est) <= inside]
    return estimate(rows, (1 - outliers.REWEIGHT_TAIL) / outliers.chi2_cdf(inside, d + 2), 0)


@pytest.mark.parametrize("merged", [False, True])
def test_op5_outliers(spark, merged, tmp_path):
    """Each document's verdict by its group's estimate, pulled towards its language's and that towards all's. The groups of
    the table are small; merged, some have far more documents than the estimates are pulled by, others one."""
    table = spark.read.parquet(f"{SF['0.01']}/documents.parquet")
    if merged:
        own = F.when(F.col("doc_id") % 50 == 1, F.col("doc_id").cast("string")).when(F.col("doc_id") % 5 > 0, "big")
        table = table.withColumn("source", own.otherwise(F.col("source")))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    docs = [tuple(r) for r in table.select("doc_id", "text", "lang", "source").collect()]
    base = {d: brute_base(t) for d, t, _, _ in docs}

    def feature(n, chars, symbols, lines, repeats, _):
        n1 = max(n, 1)
        return [np.log1p(n), np.log(max(chars / n1, 1)), np.sqrt(symbols / n1), np.sqrt(lines / n1), np.sqrt(repeats / n1)]

    x = {d: np.array(feature(*base[d])) for d, _, _, _ in docs}
    groups = {}
    for d, _, lang, source in docs:
        if not base[d][5]:
            for g in ((lang, source), (lang,), ()):
                groups.setdefault(g, []).append(x[d])
    sizes = [len(v) for g, v in groups.items() if len(g) == 2]
    assert min(sizes) < outliers.SHRINK and (max(sizes) > 2 * outliers.SHRINK) == merged
    prior = np.diag(np.square(outliers.PRIOR))
    shrunk = {}
    for g in sorted(groups, key=len):
        m, cov = mcd(np.array(groups[g]))
        up_m, up_cov = shrunk[g[:-1]] if g else (m, prior)
        w = len(groups[g]) / (len(groups[g]) + outliers.SHRINK)
        shrunk[g] = w * m + (1 - w) * up_m, w * cov + (1 - w) * up_cov
    got = {r["doc_id"]: r for r in QUERIES["op5_outliers"](spark, str(tmp_path)).collect()}
    dist = {r["doc_id"]: r["distance"] for r in outliers.judge(table).collect()}
    for d, _, lang, source in docs:
        assert tuple(got[d][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base[d]
        if base[d][5]:
            assert got[d]["kept"] is False
            continue
        m, cov = shrunk[lang, source]
        want = (x[d] - m) @ np.linalg.solve(cov + np.diag(np.square(outliers.FLOORS)), x[d] - m)
        assert dist[d] == pytest.approx(want, rel=1e-6, abs=1e-9)
        if abs(want / outliers.CUTOFF - 1) > 1e-6:
            assert got[d]["kept"] == (want <= outliers.CUTOFF)


def test_op7_language(spark):
    words = {"aa": "the cat sat on a mat and the dog ran", "bb": "der hund und die katze sind im haus", "cc": "zażółć gęślą jaźń"}
    rows = [(i, " ".join((words[k] + " ").split() * 2)[i % 5:30 + i], k if i % 7 else None) for i, k in
            enumerate(list(words) * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = {}
    for d, t, lang in rows:
        if lang and crc(d) % 5:
            learn.setdefault(lang, []).append(t.encode())
    got = {r["doc_id"]: r for r in ppm.identify(docs).collect()}
    for d, t, _ in rows:
        bits = plain_bits(learn, t.encode(), ppm.MIN_COUNT)
        best = min(sorted(bits), key=lambda k: bits[k])
        assert got[d]["lang_pred"] == best and got[d]["held_out"] == (crc(d) % 5 == 0)
        assert got[d]["score"] == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()), abs=1e-4)


def test_op10_minmax(spark, docs):
    got = sorted(tuple(r) for r in QUERIES["op10_minmax"](spark, DIR).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == sorted(brute_groups([(d, t) for d, t, _, _ in docs], 2))


def tables(spark, tmp_path, docs, items=None):
    """A folder of tables with the given documents."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(d, int(d % 3 > 0)) for d in range(0, 21)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    (items if items is not None else awkward.items(spark).where("item_id <> 8")).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def key(rows):
    return sorted(map(repr, rows))


def test_stages_on_awkward_documents(spark, tmp_path):
    """Every stage against brute force on what the stage before has left."""
    sf = tables(spark, tmp_path, awkward.documents(spark))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["quality", "line_dedup", "near_dedup", "decontam", "mixing"]
    columns = docs.columns
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    stats = {r["doc_id"]: r for r in qda.classify(docs, spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "text").collect()}
    out = by_name["quality"](spark, docs, sf)
    assert out.columns == columns
    scored = qda.classify(docs, spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "text").where("predicted = 1")
    assert key(pairs(out)) == key(pairs(scored)) and stats

    # the other stages take all documents, so that every awkward row reaches them
    out = by_name["line_dedup"](spark, docs, sf)
    assert out.columns == columns
    assert key(pairs(out)) == key((d, t) for d, _, _, t in brute_lines(pairs(docs)))
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())

    out = by_name["near_dedup"](spark, docs, sf)
    kept = [x for x, g in zip(pairs(docs), brute_groups(pairs(docs), 5)) if g[3]]
    assert out.columns == columns and key(pairs(out)) == key(kept)

    out = by_name["decontam"](spark, docs, sf)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [x for x, g in zip(pairs(docs), brute_decontam(pairs(docs), items)) if not g[2]]
    assert out.columns == columns and key(pairs(out)) == key(clean)

    out = by_name["mixing"](spark, docs, sf)
    assert out.columns == columns   # the documents' own copy_no, the last column, gives way to that of the copies
    assert out.count() == sum(r["copies"] for r in mixing.mix(docs).collect())


def test_pipeline_takes_each_document_at_its_sources_rate(spark):
    out = corpus_pipeline.run(spark, DIR).collect()
    copies = {}
    for r in out:
        copies.setdefault((r["doc_id"], r["text"]), []).append(r["copy_no"])
    assert 0 < len(copies) < 200 and all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2 for c in copies.values())
    assert len({r["source"] for r in out}) == 20


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, awkward.empty(spark))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_extra_columns_stay(spark):
    index = decontam.build_index(awkward.documents(spark))
    assert index.select(F.explode("doc_ids")).count() == len(awkward.texts())
