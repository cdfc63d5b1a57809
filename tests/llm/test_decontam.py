import random

from pyspark.sql import functions as F

from tests.llm import awkward
from tidemark.llm import decontam


def brute(docs, items, size=10):
    windows = {}
    for name, t in items:
        for w in decontam.windows_of(decontam.tokens(t.encode() if t else None), size):
            windows.setdefault(w, set()).add("" if name is None else str(name))
    lengths = {len(w) for w in windows}
    out = []
    for d, t in docs:
        words = decontam.tokens(t.encode() if t else None)
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out.append((d, len(words), len(hit), sorted(names)))
    return out


def got(matches):
    return [(r["doc_id"], r["n_words"], r["n"], r["items"]) for r in
            matches.select("doc_id", "n_words", decontam.span_words().alias("n"), "items").collect()]


def norm(rows):
    return sorted(rows, key=repr)


def test_words_are_those_of_the_contract():
    import re
    text = "Ab c9_d é\x7fz[Q]^`{~}/:@ \x00ÀB 中x"
    lower = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    assert [w.decode() for w in decontam.tokens(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_awkward_rows(spark):
    index = decontam.build_index(awkward.documents(spark))
    items = [(r["item_id"], r["text"]) for r in awkward.items(spark).collect()]
    want = norm(brute(awkward.texts(), items))
    assert norm(got(decontam.phrase_matches(index, awkward.items(spark)))) == want
    # the same with a query set of many blocks
    assert norm(got(decontam.phrase_matches(index, awkward.items(spark), block_windows=3))) == want
    digest = decontam.digest(decontam.phrase_matches(index, awkward.items(spark)))
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in digest.collect())


def test_random_texts_and_small_segments(spark):
    rng = random.Random(5)
    word = lambda: f"w{min(int(rng.expovariate(0.3)), 25)}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(0, 120)))) for i in range(80)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    items += [(100 + i, " ".join(t.split()[3:3 + rng.randrange(1, 30)])) for i, (_, t) in enumerate(docs[:30])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    for segment in (1, 100, 10_000):
        index = decontam.build_index(d, segment)
        for size in (3, 10):
            assert norm(got(decontam.phrase_matches(index, q, size))) == norm(brute(docs, items, size))


def test_proximity(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    items = [(0, "w1 w2 w3"), (1, "w4 w4 w5"), (2, "w8"), (3, "none w1")]
    index = decontam.build_index(spark.createDataFrame(docs, "doc_id long, text string"), 60)
    q = spark.createDataFrame(items, "item_id long, text string")
    for within in (1, 3, 6):
        want = []
        for d, t in docs:
            words, names, hit = t.split(), set(), set()
            for name, query in items:
                for s in range(len(words)):
                    span = words[s:s + within]
                    if set(query.split()) <= set(span) and span[0] in query.split():
                        names.add(str(name))
                        hit.update(range(s, s + len(span)))
            want.append((d, len(words), len(hit), sorted(names)))
        assert norm(got(decontam.proximity_matches(index, q, within))) == norm(want)


def test_clean_decides_each_row(spark):
    docs = awkward.documents(spark)
    out = decontam.clean(docs, awkward.items(spark).where("item_id = 7"))
    assert out.columns == docs.columns
    left = [r["doc_id"] for r in out.collect()]
    assert 14 not in left and left.count(15) == 1 and left.count(None) == 2 and len(left) == docs.count() - 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    index = decontam.build_index(awkward.documents(spark))
    assert decontam.phrase_matches(index, none).where(F.size("spans") > 0).count() == 0
    assert decontam.phrase_matches(index, none).count() == len(awkward.texts())
    assert decontam.phrase_matches(decontam.build_index(awkward.empty(spark)), awkward.items(spark)).count() == 0


def test_queries_of_common_words_are_taken_in_parts(monkeypatch):
    import numpy as np
    words = [b"a", b"b"] * 300 + [b"a"] * 100
    hashes = decontam.WordHashes()
    import pyarrow as pa
    i32 = pa.list_(pa.int32())
    seg_schema = pa.schema([("segment", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("starts", i32), ("n_words", i32),
                            ("terms", pa.binary()), ("offsets", pa.binary()), ("positions", pa.binary())])
    row = decontam._segment([1], [0], [len(words)], [hashes.of(words)], seg_schema).to_pylist()[0]
    seg = decontam.Segment(row["starts"], row["n_words"], row["terms"], row["offsets"], row["positions"])
    queries = np.array([hashes.of(list(q)) for q in ([b"a", b"b", b"a"], [b"b", b"a", b"a"], [b"a", b"a", b"a"], [b"b", b"b", b"a"])])
    whole = sorted(zip(*(x.tolist() for x in seg.phrases(queries))))
    want = sorted((i, s) for i, q in enumerate(([b"a", b"b", b"a"], [b"b", b"a", b"a"], [b"a", b"a", b"a"], [b"b", b"b", b"a"]))
                  for s in range(len(words) - 2) if words[s:s + 3] == q)
    monkeypatch.setattr(decontam, "CANDIDATES", 50)
    assert whole == want == sorted(zip(*(x.tolist() for x in seg.phrases(queries))))


def test_long_items_are_cut_into_blocks_without_losing_a_window(spark):
    words = [f"w{i}" for i in range(500)]
    # every window of the long item once, alone in a document, so that a lost one shows
    docs = spark.createDataFrame([(i, "x " + " ".join(words[i:i + 10]) + " y") for i in range(491)] + [(999, "w1 w2 w3")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([("long", " ".join(words)), ("short", "W1, w2 w3"), ("none", "!"), (None, None)],
                                  "item_id string, text string")
    sizes = [(sum(len(m) for m, _ in block.values()), last) for block, last in decontam._blocks(items, 10, 64)]
    assert len(sizes) == 8 and [last for _, last in sizes] == [False] * 7 + [True]
    assert sum(n for n, _ in sizes) == 492 and max(n for n, _ in sizes) < 2 * 64
    index = decontam.build_index(docs)
    whole = decontam.digest(decontam.phrase_matches(index, items)).collect()
    cut = decontam.digest(decontam.phrase_matches(index, items, block_windows=64)).collect()
    assert sorted(whole) == sorted(cut) and all(r["contaminated"] for r in cut) and len(cut) == 492
    assert {r["doc_id"]: r["n_hit"] for r in cut} == {**{i: 10 for i in range(491)}, 999: 3}
