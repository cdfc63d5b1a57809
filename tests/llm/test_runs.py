import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm import awkward
from tidemark.llm import runs


def brute(w, least=6, periods=4):
    """(start, end, q) of all runs: every period, every stretch, smallest periods only."""
    n, found = len(w), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                if not any(q % p == 0 and a <= i and b >= j + q for a, b, p in found):
                    found.append((i, j + q, q))
            i = max(i + 1, j)
    return found


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, w):
    found = sorted((s, e - s, q) for s, e, q in brute(w))
    found.sort(key=lambda r: (r[0], r[2]))
    keep = [True] * len(w)
    for s, length, q in found:
        for i in range(s + q, s + length):
            keep[i] = False
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    text = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *top, top[1] and 1000 * top[1] // top[2], hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for x, k in zip(w, keep) if k)).hexdigest())


def test_grammar_finds_all_runs():
    rng = random.Random(7)
    for _ in range(1500):
        letters, n, docs = rng.choice([1, 2, 3, 5]), rng.randint(0, 60), []
        for _ in range(rng.randint(1, 4)):
            w = []
            while len(w) < n:
                w += [rng.randrange(letters) for _ in range(rng.randint(1, 7))] * rng.randint(1, 7)
            docs += [w[:n]] * rng.choice([1, 1, 2])     # copies share the grammar
        ids, at = [], []
        for d, w in enumerate(docs):
            at.append(len(ids))
            ids += w + [-1 - d]
        want = sorted((s + x, e + x, q) for w, x in zip(docs, at) for s, e, q in brute(w))
        assert sorted(runs.word_runs(np.array(ids, np.int64))) == want


def test_long_runs():
    words = np.array([0] * 100_000 + [1, 2, 3] * 20_000 + list(range(4, 3000)) * 4 + [-1], np.int64)
    assert sorted(runs.word_runs(words)) == [(0, 100_000, 1), (100_000, 160_000, 3), (160_000, 160_000 + 4 * 2996, 2996)]
    with pytest.raises(ValueError):
        runs.word_runs(words, min_exponent=3)


def test_small_batches_give_the_same(spark):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet").select("doc_id", "text")
    docs = runs.with_planted_runs(docs)
    rows = docs.collect()
    want = sorted(tuple(expected(r["doc_id"], (r["text"] or "").encode().split())) for r in rows if len(r["text"]) < 4000)
    got = sorted(tuple(r) for r in runs.digest(runs.find(docs.where("length(text) < 4000"))).collect())
    assert got == want and any(r[1] for r in want)
    texts = [r["text"] for r in rows]
    assert runs._of_batch(texts) == [runs._of_batch([t])[0] for t in texts]


def test_awkward_documents(spark):
    docs = awkward.documents(spark).where("length(text) is null or length(text) <> 30000")
    more = spark.createDataFrame([(31, "x " * 9), (32, "a b a b a b a b"), (32, "a b a b a b a b"), (None, "           ")],
                                 "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    docs = docs.withColumn("runs", docs.doc_id).withColumn("start", docs.doc_id).withColumn("period", docs.text)
    got = [tuple(r) for r in runs.digest(runs.find(runs.with_planted_runs(docs))).collect()]
    rows = [r for r in docs.select("doc_id", "text").collect() if len((r["text"] or "").split()) < 5000]
    want = [expected(r["doc_id"], planted(r["doc_id"], r["text"])) for r in rows]
    assert sorted(r for r in map(repr, got) if r in set(map(repr, want))) == sorted(map(repr, want))
    assert len(got) == docs.count()


def test_empty_table(spark):
    assert runs.digest(runs.find(runs.with_planted_runs(awkward.empty(spark)))).count() == 0
