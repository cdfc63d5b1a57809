import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import awkward
from tidemark.llm import minmax
from tidemark.llm.graph import components


def shingles(text, size):
    words = text.encode().lower().split() if text else []
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), low, d == low))
    return out


def norm(rows):
    return sorted(rows, key=repr)


def got(df):
    return norm((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def test_awkward_rows(spark):
    for size in (1, 2):
        assert got(minmax.near_duplicates(awkward.documents(spark), size)) == norm(brute(awkward.texts(), size))


def test_awkward_rows_in_five_words(spark):
    assert got(minmax.near_duplicates(awkward.documents(spark), 5)) == norm(brute(awkward.texts(), 5))


def test_groups_chains_and_strangers(spark):
    rng = random.Random(11)
    rows, n = [], 0
    for _ in range(12):  # chains: each text some edits away from the one before
        words = [f"v{rng.randrange(500)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(rng.randrange(1, 25)):
            rows.append((n, " ".join(words)))
            n += 1
            if rng.random() < 0.8:
                words = list(words)
                for _ in range(rng.randrange(1, 4)):
                    words[rng.randrange(len(words))] = f"v{rng.randrange(500)}"
    passage = [f"p{i}" for i in range(40)]  # strangers that share a passage
    for _ in range(40):
        rows.append((n, " ".join(passage + [f"q{rng.randrange(9999)}" for _ in range(rng.randrange(5, 40))])))
        n += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minmax.near_duplicates(docs, 2)) == norm(brute(rows, 2))


def test_signature_is_unbiased_and_better_than_its_halves():
    rng = np.random.default_rng(1)
    errors, halves, j = [], [], 0.6
    for trial in range(60):
        n = 400
        both = int(n * j)
        h = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = h[:both + (n - both) // 2], np.r_[h[:both], h[n:n + (n - both) - (n - both) // 2]]
        true = both / len(np.union1d(a, b))
        perms = minmax.permutations(64, seed=trial)
        sa, sb = minmax.signature(a, perms), minmax.signature(b, perms)
        errors.append(minmax.estimate(sa, sb) - true)
        halves.append(minmax.estimate(sa[::2], sb[::2]) - true)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < np.std(halves)


def test_short_pairs_at_the_threshold_share_a_band():
    """4 of 5 shingles in common, the hardest pair at 0.8: at most 1 in 100,000 missed."""
    permutations = minmax.BAND // 2
    bands = 2 * minmax.PERMUTATIONS // minmax.BAND
    for k, n in ((4, 5), (8, 10), (80, 100)):
        assert (1 - (k * (k - 1) / (n * (n - 1))) ** permutations) ** bands < 1e-5
    rng = np.random.default_rng(7)
    perms, missed = minmax.permutations(), 0
    for h in rng.integers(0, 1 << 63, (10_000, 5), dtype=np.uint64):
        a, b = (minmax.bands_of(minmax.signature(x, perms)) for x in (h[:4], h))
        missed += not (a == b).any()
    assert missed == 0


def test_rare_shingles_of_repeated_rows(spark):
    """Rows that are all there twice give each class one set, and the exact search its pairs."""
    rng = random.Random(3)
    rows, n = [], 0
    for _ in range(15):
        words = [f"v{rng.randrange(60)}" for _ in range(20)]
        for _ in range(4):
            rows.append((n, " ".join(words)))
            n += 1
            words = list(words)
            words[rng.randrange(20)] = f"v{rng.randrange(60)}"
    want = {(i, j) for i in range(n) for j in range(i + 1, n)
            if 100 * len(shingles(rows[i][1], 1) & shingles(rows[j][1], 1))
            >= 80 * len(shingles(rows[i][1], 1) | shingles(rows[j][1], 1))}
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string")
    wanted = docs.distinct().select(F.col("doc_id").alias("cid"), F.col("doc_id").alias("home"), minmax.text_key().alias("tk"))
    sets = minmax._sets(docs, wanted, 1).cache()
    assert sets.count() == n
    rare = minmax._rarest(sets.withColumn("component", F.col("cid")), 80)
    found = {tuple(r) for r in minmax._linked(minmax._apart(rare, 80), sets, 80).collect()}
    assert len(want) > 20 and found == want


def test_one_of_each_keeps_rows_and_columns(spark):
    docs = awkward.documents(spark)
    out = minmax.one_of_each(docs, shingle=2)
    assert out.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    kept = {d: t for d, t in awkward.texts()}
    assert (1, kept[1]) in left and not any(d in (2, 7) for d, _ in left)
    assert sum(d is None for d, _ in left) == 3 and len([d for d, _ in left if d == 15]) == 2


def test_empty_table(spark):
    assert got(minmax.near_duplicates(awkward.empty(spark))) == []
    assert minmax.one_of_each(awkward.empty(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (100, 98), (7, 7), (200, 201), (201, 200)]
    out = {r["id"]: r["component"] for r in
           components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 98: 98, 99: 98, 100: 98, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_bucket_makes_no_pairs(spark):
    """A group of near copies is compared with its ends, not with itself."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i % 100] + [f"x{i}"] + base[i % 100 + 1:])) for i in range(400)]
    out = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert out.where(F.col("component_id") == 0).count() == 400
