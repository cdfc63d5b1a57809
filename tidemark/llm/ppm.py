"""Language ID by prediction by partial matching.

Per language a variable-order tree of byte contexts (up to ``ORDER`` bytes) with the counts of the byte that
follows. In a context seen n times with q different next bytes, a seen byte has probability count / (n + q) and
the escape q / (n + q); the escape's share is spread over the other bytes as the next shorter context predicts
them (renormalised, so the probabilities of each context sum to 1), down to a uniform order -1. The statistics
are frozen after training, so a text's exact code length under a language is a sum over its bytes. The
language with the shortest code wins; the score is its posterior probability with equal priors.

The frozen trees of all languages are unrolled into tables over the union of their contexts: from the last
bytes to the longest context known to any language, and from context and byte to the code length under every
language. Scoring a byte is ORDER + 1 table look-ups, over whole texts.

Training takes a bounded sample of labelled rows: on average ``FIT_DOCS`` documents per language, chosen by a hash of
the doc_id, fewer only where a language has fewer; of a text of more than ``FIT_CHARS`` characters a span of so many,
placed by a hash. Gram counts
are aggregated by Spark, and the driver builds the tables. Contexts that are seen less than ``MIN_COUNT``
times in all languages together are not kept; the bound rises until the tables have at most ``MOST_ENTRIES``.

Learnt from: text and non-null lang of the documents whose crc32(doc_id as text) mod 5 is not 0. Prediction
reads the text alone.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything if no language
could be learnt; equal code lengths go to the language that sorts first; null doc_ids are not learnt from and
not held out; repeated rows are predicted alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_values, crc_mod
from tidemark.session import materialize

FOLDS, HELD_OUT = 5, 0
ORDER = 3
FIT_DOCS, FIT_CHARS = 2000, 1 << 16
MIN_COUNT = 2
MOST_ENTRIES = 1 << 25
UNKNOWN = "und"
#: A byte that no UTF-8 text holds; it stands between texts.
NONE = 0xFF
_CUT = bytes([NONE]) * ORDER
_BLOCK = 1 << 19
#: A letter is a character of a Unicode category L; numerals such as \u00bd or \u2167 are none.
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> DataFrame:
    """lang and raw of the sample that is learnt from."""
    rows = docs.where(F.col("lang").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT) & (F.length("text") > 0))
    # one row per language, written so that its size is known and no text is dealt out by language to meet it
    sizes = materialize(rows.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n")), "ppm-sizes", 1)
    draw = F.pmod(F.xxhash64(F.lit("ppm"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    begin = F.pmod(F.xxhash64(F.lit("span"), "doc_id"), F.greatest(F.length("text") - fit_chars, F.lit(0)) + 1)
    span = F.when(F.length("text") <= fit_chars, F.col("text")).otherwise(
        F.substring("text", (begin + 1).cast("int"), F.lit(fit_chars)))
    return (rows.join(sizes, F.col("lang") == F.col("_lang")).where(draw * F.col("_n") < fit_docs)
            .select("lang", span.cast("binary").alias("raw")))


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ORDER + 1 bytes as integers, last byte lowest, and their counts."""
    b = np.frombuffer(_CUT + _CUT.join(texts), np.uint8).astype(np.int64)
    key = np.zeros(len(b) - ORDER, np.int64)
    for i in range(ORDER + 1):
        key = key << 8 | b[i:len(b) - ORDER + i]
    return np.unique(key[key & 0xFF != NONE], return_counts=True)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over rows (lang, raw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, raw in zip(batch.column("lang").to_pylist(), binary_values(batch.column("raw"))):
                by.setdefault(lang, []).append(raw)
            for lang, texts in by.items():
                key, n = _grams(texts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """The frozen trees of all languages as tables."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], min_count: int = MIN_COUNT,
                 most_entries: int = MOST_ENTRIES):
        self.langs = sorted(counts)
        seen = np.unique(np.concatenate([k & 0xFF for k, _ in counts.values()]))
        m = len(seen)
        self.size = m + 2  # the seen bytes, any other byte, and the cut between texts
        novel, cut = m, m + 1
        self.of_byte = np.full(256, novel, np.int32)
        self.of_byte[seen] = np.arange(m)
        self.of_byte[NONE] = cut
        s = self.size
        # by language, the classes of each gram: column 0 the byte, column j the j-th byte before it
        grams = {lang: (np.stack([self.of_byte[k >> (8 * j) & 0xFF] for j in range(ORDER + 1)], 1).astype(np.int64), n)
                 for lang, (k, n) in counts.items()}

        def contexts(order: int) -> dict[str, np.ndarray]:
            """Key of each gram's context of that order, -1 if it reaches over a cut."""
            out = {}
            for lang, (g, _) in grams.items():
                key = np.zeros(len(g), np.int64)
                for j in range(1, order + 1):
                    key = key * s + g[:, j]  # nearest byte highest
                out[lang] = np.where((g[:, 1:order + 1] == cut).any(1), -1, key)
            return out

        keyed = [contexts(k) for k in range(ORDER + 1)]
        while True:
            kept = []  # sorted keys of the contexts of each order
            for by in keyed:
                key = np.concatenate([by[x] for x in self.langs])
                n = np.concatenate([grams[x][1] for x in self.langs])
                u, inverse = np.unique(key, return_inverse=True)
                total = np.bincount(inverse, n)
                kept.append(u[(u >= 0) & (total >= (min_count if len(kept) else 0))])
            rows = sum(map(len, kept))
            if rows * s * len(self.langs) <= most_entries or rows == 1:
                break
            min_count *= 2
        first = np.cumsum([0, *map(len, kept)])

        probs = np.zeros((len(self.langs), rows, m + 1))
        base = np.append(np.full(m, 1 / 255), (255 - m) / 255)
        for li, lang in enumerate(self.langs):
            g, n = grams[lang]
            for k in range(ORDER + 1):
                at = np.searchsorted(kept[k], keyed[k][lang])
                ok = (at < len(kept[k])) & (keyed[k][lang] >= 0)
                ok[ok] &= kept[k][at[ok]] == keyed[k][lang][ok]
                count = np.zeros((len(kept[k]), m + 1))
                np.add.at(count, (at[ok], g[ok, 0]), n[ok])
                # without its farthest byte a context's key is the key of its parent
                parent = (probs[li, first[k - 1] + np.searchsorted(kept[k - 1], kept[k] // s)] if k
                          else np.broadcast_to(base, count.shape))
                total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
                rest = (parent * (count == 0)).sum(1, keepdims=True)
                with np.errstate(invalid="ignore", divide="ignore"):
                    p = np.where(count > 0, count / (total + kinds), kinds / (total + kinds) * parent / rest)
                    p = np.where(rest <= 1e-12, count / total, p)
                probs[li, first[k]:first[k + 1]] = np.where(total > 0, p, parent)
        with np.errstate(divide="ignore"):
            bits = -np.log2(probs)
            bits[:, :, novel] += np.log2(max(1, 255 - m))
        bits = np.where(np.isfinite(bits), bits, 64.0)
        self.bits = np.zeros((rows, s, len(self.langs)), np.float32)  # the cut costs nothing
        self.bits[:, :m + 1] = bits.transpose(1, 2, 0)
        self.bits = self.bits.reshape(rows * s, len(self.langs))
        # steps[k]: from the state after k bytes back and the class of the next byte back to the state after
        # it. States 0.. are the contexts of order k; then one resting state for each shorter context that
        # has been left. After ORDER steps a state is a row of ``bits``.
        self.steps, self.rows = [], None
        resting = np.zeros(0, np.int64)  # rows of the resting states
        for k in range(ORDER):
            n_k, n_next = len(kept[k]), len(kept[k + 1])
            rest_rows = np.r_[resting, first[k] + np.arange(n_k)]
            step = np.empty((n_k + len(resting), s), np.int64)
            step[:n_k] = (n_next + len(resting) + np.arange(n_k))[:, None]
            step[n_k:] = (n_next + np.arange(len(resting)))[:, None]
            step[np.searchsorted(kept[k], kept[k + 1] // s), kept[k + 1] % s] = np.arange(n_next)
            self.steps.append(step.ravel().astype(np.int32))
            resting = rest_rows
        self.rows = np.r_[first[ORDER] + np.arange(len(kept[ORDER])), resting].astype(np.int64)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        if not texts:
            return out
        ends = np.cumsum([len(t) + ORDER for t in texts])
        starts = ends - np.array([len(t) for t in texts])  # where each text begins, its cut before it
        cls = self.of_byte[np.frombuffer(b"".join(_CUT + t for t in texts), np.uint8)]
        s = self.size
        for lo in range(ORDER, len(cls), _BLOCK):
            hi = min(lo + _BLOCK, len(cls))
            state = np.zeros(hi - lo, np.int32)
            for k, step in enumerate(self.steps):
                state = step[state * s + cls[lo - 1 - k:hi - 1 - k]]
            bits = self.bits[self.rows[state] * s + cls[lo:hi]]
            a, b = np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi - 1, side="right")
            cuts = np.maximum(starts[a:b + 1] - ORDER, lo) - lo
            out[a:b + 1] += np.add.reduceat(bits.astype(np.float64), cuts, axis=0)
        return out


def fit(rows: DataFrame, min_count: int = MIN_COUNT) -> Trees | None:
    """Trees from rows (lang, raw); None if there are none. The driver receives the distinct grams of the
    bounded sample."""
    got = gram_counts(rows).toPandas()
    if got.empty:
        return None
    return Trees({lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.int64)) for lang, g in got.groupby("lang")},
                 min_count)


def predict(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, lang_pred, score; one row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def some(texts: list[bytes]) -> tuple[list[str], list[float]]:
        bits = sent.value.code_lengths(texts)
        best = bits.argmin(1)
        low = bits[np.arange(len(bits)), best]
        return [sent.value.langs[i] for i in best], (1 / np.exp2(low[:, None] - bits).sum(1)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = binary_values(batch.column("raw"))
            langs, scores = [UNKNOWN] * len(raws), [0.0] * len(raws)
            todo = [i for i, r in enumerate(raws) if sent.value and r and _LETTER.search(r.decode(errors="replace"))]
            while todo:
                size, part = 0, []
                while todo and (not part or size < _BLOCK):  # some texts at a time
                    part.append(todo.pop())
                    size += len(raws[part[-1]])
                for i, lang, score in zip(part, *some([raws[i] for i in part])):
                    langs[i], scores[i] = lang, score
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return (docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
            .mapInArrow(run, f"doc_id {kind}, lang_pred string, score double"))


def identify(docs: DataFrame, **sample) -> DataFrame:
    """Learn from and predict the same documents: doc_id, held_out, lang_pred, score."""
    trees = fit(training_rows(docs.select("doc_id", "lang", "text"), **sample))
    return predict(docs, trees).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
