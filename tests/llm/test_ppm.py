"""PPM code lengths against a plain per-byte version, and the defined cases."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ppm


def plain_bits(texts_by_lang, text, min_count):
    """Code length of a text by walking the contexts byte by byte."""
    count = {}
    for lang, texts in texts_by_lang.items():
        for t in texts:
            for i, b in enumerate(t):
                for k in range(min(i, ppm.ORDER) + 1):
                    d = count.setdefault((lang, t[i - k:i]), {})
                    d[b] = d.get(b, 0) + 1
    totals = {}
    for (lang, c), d in count.items():
        totals[c] = totals.get(c, 0) + sum(d.values())
    seen = {b for t in sum(texts_by_lang.values(), []) for b in t}

    def p(lang, c, b):
        if c is None:
            return 1 / 255
        up = (lambda x: p(lang, c[1:] if c else None, x))
        d = count.get((lang, c))
        if not d:
            return up(b)
        n, q = sum(d.values()), len(d)
        rest = sum(up(x) for x in seen if x not in d) + (255 - len(seen)) * up(1) if True else 0
        if rest <= 1e-12:
            return d.get(b, 0) / n
        return d[b] / (n + q) if b in d else q / (n + q) * up(b) / rest

    out = {}
    for lang in texts_by_lang:
        bits = 0.0
        for i, b in enumerate(text):
            c = max((text[i - k:i] for k in range(min(i, ppm.ORDER) + 1)
                     if not k or totals.get(text[i - k:i], 0) >= min_count), key=len)
            bits -= np.log2(p(lang, c, b))
        out[lang] = bits
    return out


def counts(texts_by_lang):
    return {lang: ppm._grams(texts) for lang, texts in texts_by_lang.items()}


def test_code_lengths_equal_the_plain_version(monkeypatch):
    texts = {"aa": [b"the cat sat", b"the hat", b"a"], "bb": [b"der hut sitzt", b"das ist der hut"]}
    for min_count in (1, 2, 3):
        trees = ppm.Trees(counts(texts), min_count)
        probe = [b"the hut", b"", b"zzz QQ", b"der cat sat the hat", b"a", "hüte".encode()]
        want = [[plain_bits(texts, t, min_count)[x] for x in trees.langs] for t in probe]
        assert np.allclose(trees.code_lengths(probe), want, rtol=1e-5)
        monkeypatch.setattr(ppm, "_BLOCK", 5)  # texts that reach over blocks
        assert np.allclose(trees.code_lengths(probe), want, rtol=1e-5)
        monkeypatch.undo()


def test_probabilities_of_a_context_sum_to_one():
    trees = ppm.Trees(counts({"x": [b"abracadabra", b"banana"], "y": [b"cabbage"]}), 1)
    bits = trees.bits.reshape(-1, trees.size, 2)
    m = trees.size - 2
    mass = np.exp2(-bits[:, :m]).sum(1) + (255 - m) * np.exp2(-bits[:, m])
    assert np.allclose(mass, 1, atol=1e-5)


def test_defined_cases(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 34 !", None, "x"), (None, "the dog", "en", "x"),
             (103, "the cat and the dog " * 20000, None, "x"), (103, "der hund", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = ppm.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 103}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (100, 101, 102))
    assert by[None]["lang_pred"] == "en" and by[None]["held_out"] is False
    assert sorted(r["lang_pred"] for r in got if r["doc_id"] == 103) == ["de", "en"]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert ppm.identify(docs).collect() == []
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in ppm.identify(docs).collect()] == ["und"]


def test_held_out_accuracy(spark):
    from tests.conftest import SF
    docs = spark.read.parquet(f"{SF['0.01']}/documents.parquet")
    got = ppm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


def test_numerals_are_no_letters(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(200, "\u00bd \u00b2 \u2460 \u2167", None), (201, "\u4e2d", None), (202, "\u00aa", None)]
    got = {r["doc_id"]: r for r in ppm.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[200]["lang_pred"] == "und" and got[200]["score"] == 0
    assert got[201]["lang_pred"] != "und" and got[202]["lang_pred"] != "und"


def test_a_language_of_long_texts_is_learnt(spark):
    long = "der hund und die katze laufen durch den wald und schlafen " * 1700     # 98,600 characters
    rows = [(i, long[i:], "de") for i in range(12)] + [(100 + i, "the cat and the dog are asleep", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = ppm.training_rows(docs).collect()
    assert {r["lang"] for r in sample} == {"de", "en"} and max(len(r["raw"]) for r in sample) == ppm.FIT_CHARS
    got = {r["doc_id"]: r["lang_pred"] for r in ppm.identify(docs).collect()}
    assert all(got[i] == ("de" if i < 100 else "en") for i in got)


def test_registered_query_text_by_text(spark):
    """The registered query on its whole table gives what trees built beside it say of each text alone (the trees
    themselves are held against the plain version above)."""
    from tests.conftest import SF
    from tidemark.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    counted = {}
    for r in ppm.gram_counts(ppm.training_rows(docs)).collect():
        counted.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    trees = ppm.Trees({k: (np.array(sorted(v)), np.array([v[g] for g in sorted(v)])) for k, v in counted.items()})
    got = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, SF["0.001"]).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        raw = (r["text"] or "").encode()
        bits = trees.code_lengths([raw])[0]
        if any(c.isalpha() for c in r["text"] or ""):
            assert got[r["doc_id"]]["lang_pred"] == trees.langs[int(bits.argmin())]
        else:
            assert got[r["doc_id"]]["lang_pred"] == "und"
