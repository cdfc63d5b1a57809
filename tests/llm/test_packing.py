import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF
from tests.llm import awkward
from tidemark.llm import packing
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


def ids_of(known, text):
    return known.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check(rows, documents, known, window, slack=packing.SLACK):
    """Pieces give back the documents, sequences have no gap, and padding is bounded."""
    docs, sequences = {}, {}
    for r in rows:
        ids = [int.from_bytes(r["ids"][i:i + 4], "little") for i in range(0, len(r["ids"]), 4)]
        assert len(ids) == r["length"] > 0
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for d, t in documents:
        ids = ids_of(known, t)
        want.setdefault((d, len(ids)), []).append(ids)
    assert set(docs) == set(want)
    for key, texts in want.items():
        pieces = sorted(docs[key])
        if len(texts) == 1:
            assert [s for s, _ in pieces] == [sum(len(p) for _, p in pieces[:i]) for i in range(len(pieces))]
            assert [i for _, p in pieces for i in p] == texts[0]
        else:
            assert sorted(i for _, p in pieces for i in p) == sorted(i for t in texts for i in t)
    lengths = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n <= window and (n >= window - slack or n & (n - 1) == 0) for n in lengths)
    return lengths


def test_ids_are_those_of_the_tokenizers_library(known):
    encode = packing.encoder(packing.read_vocabulary(PATH))
    rng = random.Random(3)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    some = rng.sample(points, 30_000) + list(range(0, 0x3000)) + list(range(0xFE00, 0x10000))
    texts = [f"a{c}b {c} 1{c}1 {c}{c}!{c}  {c}'{c}" for c in map(chr, some)]
    texts += ["", "a" * 50_000, " " * 50_000 + "x", "\n" * 9000, "<|endoftext|> a<|endoftext|>", "it's we'll I'D \u0085x ​", "éé\U0001f600" * 99]
    for text, e in zip(texts, known.encode_batch(texts, add_special_tokens=False)):
        assert encode(text).tolist() == e.ids
    other = packing.encoder(packing.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    assert other("Hello  World").tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(
        "Hello  World", add_special_tokens=False).ids


def test_tightest_window():
    rng = random.Random(5)
    tree, plain = packing.Capacities(100), []
    for i in range(4000):
        if rng.random() < 0.5 or not plain:
            c = rng.randint(1, 100)
            tree.add(c, i)
            plain.append(c)
        else:
            n = rng.randint(1, 100)
            found, best = tree.tightest(n), min((c for c in plain if c >= n), default=None)
            assert (found and found[0]) == best
            if best is not None:
                plain.remove(best)


def test_best_fit_decreasing_by_hand():
    rests = [(0, 0, 6), (1, 0, 3), (2, 0, 5), (3, 0, 4), (4, 0, 2), (5, 0, 7)]
    windows = packing.best_fit(rests, 10, [])
    assert [[p[2] for p in w] for w in windows] == [[7, 3], [6, 4], [5, 2]]
    done, opened = packing.fill_up(windows, 10, 0)
    assert [sum(p[2] for p in w) for w in done] == [10, 10] and [[p[2] for p in w] for w in opened] == [[5, 2]]
    assert [[p[2] for p in s] for s in packing.powers_of_two(opened[0])] == [[4], [1, 1], [1]]
    # windows that nothing fits together: the emptiest are cut to fill the fullest
    done, opened = packing.fill_up([[(i, 0, 6)] for i in range(5)], 10, 0)
    assert [sum(p[2] for p in w) for w in done] == [10, 10, 10] and not opened
    assert sorted((r, s + i) for w in done for r, s, n in w for i in range(n)) == [(r, i) for r in range(5) for i in range(6)]


def test_whole_table_round_trip(spark, known):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    lengths = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], known, 1024)
    full = [n for n in lengths if n >= 1020]
    assert sum(1024 - n for n in full) < 0.002 * sum(full) and len(lengths) - len(full) <= 10
    got = {(r["doc_id"], r["start"]): r for r in QUERIES["op13_packing"](spark, SF["0.001"]).collect()}
    assert len(got) == len(rows)
    for r in rows:
        q = got[r["doc_id"], r["start"]]
        assert q["ids_crc32"] == zlib.crc32(r["ids"]) and (q["length"], q["sequence_id"], q["offset"]) == (
            r["length"], r["sequence_id"], r["offset"])


@pytest.mark.parametrize("window,block,slack", [(1024, packing.BLOCK, 4), (16, 100, 0), (1, 7, 0), (1000, 3000, 9)])
def test_awkward_documents(spark, known, window, block, slack):
    docs = awkward.documents(spark).withColumnRenamed("key", "sequence_id").withColumnRenamed("level", "start").repartition(3)
    rows = packing.pack(docs, PATH, window=window, block=block, slack=slack).collect()
    check(rows, awkward.texts(), known, window, slack)


def test_empty_table(spark):
    assert packing.digest(packing.pack(awkward.empty(spark), PATH)).count() == 0
