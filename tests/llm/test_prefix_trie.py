import hashlib
import zlib

import numpy as np
import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, d long, depth long, n_words string"


def conversations():
    """(conv_id, turn, role, text): shared beginnings, copies, null and repeated turns, gaps, bases without turns."""
    rows = []
    for c in [*range(0, 45), 61, 63, 80, -3, -20, 8190, 8191, 8192, 8193, 20000]:
        if c == 20:
            continue                                    # 21 to 39 have no base
        for t in range(c % 7 + (c in (0, 40))):
            rows.append((c, t, "user" if t % 2 else "system", f"turn {t} of kind {c % 3}" if t else "hello  there"))
    rows += [(100, None, None, None), (100, None, "a", "b c"), (100, 0, None, "x"), (100, 0, None, "x"), (100, -5, "", "")]
    rows += [(101, 1, "user", ""), (102, 1, "user", None), (103, 1, None, "user"), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(200 + i, j, "r", f"w{min(j, 30)} " * 3) for i in range(4) for j in range(40 + i)]
    return rows


def brute(rows, order):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, order(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + v[h:]
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    out = []
    for node, cs in members.items():
        under = [n for n in members if n[:len(node)] == node]
        leaf = [n for n in under if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode().split()) for n in under if n)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                    sum(1 for m in members if m and m[:-1] == node), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in conversations()], SCHEMA)


@pytest.fixture(scope="module")
def want(spark, table):
    from pyspark.sql import functions as F
    pairs = table.select(F.coalesce("role", F.lit("")).alias("r"), F.coalesce("text", F.lit("")).alias("t")).distinct()
    of = {(r["r"], r["t"]): (r["a"], r["b"]) for r in pairs.select(
        "r", "t", F.xxhash64("r", "t").alias("a"), F.xxhash64(F.lit("turn"), "r", "t").alias("b")).collect()}
    return brute(conversations(), lambda role, text: of[role, text])


# 8 cells: nearly every estimate is too high, so nearly all goes to the exact grouping
@pytest.mark.parametrize("cells,chunk,rows_per_chunk", [(None, 1 << 16, 1 << 20), (8, 1 << 16, 1 << 20), (256, 7, 5)])
def test_trie(spark, table, want, cells, chunk, rows_per_chunk):
    turns = prefix_trie.rebuilt(prefix_trie.numbered(table, rows_per_chunk))
    got = prefix_trie.build(turns, cells=cells, chunk_turns=chunk)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_sketch_counts_over_tasks(spark):
    digests = np.random.default_rng(2).integers(-1 << 62, 1 << 62, (3000, 2))
    rows = digests.tolist() + digests[::3].tolist()
    df = spark.createDataFrame(rows, "p1 long, p2 long").repartition(7)
    two = prefix_trie.sketch_of(df, 1 << 16)
    p1, p2 = np.ascontiguousarray(digests[:, 0]), np.ascontiguousarray(digests[:, 1])
    single = prefix_trie.single(two, p1, p2)
    assert not single[::3].any()                        # never less than the truth
    assert single[np.arange(3000) % 3 > 0].mean() > 0.99
    assert prefix_trie.single(prefix_trie.sketch_of(df, 8), p1, p2).sum() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.build(prefix_trie.rebuilt(prefix_trie.numbered(empty))).count() == 0
