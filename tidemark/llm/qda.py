"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class (quality 1 and 0) is a Gaussian over the statistics. Its covariance is shrunk towards the pooled
covariance and towards a multiple of the identity; the Cholesky factor of it is kept in the model, so scoring
is a triangular product per class: log density = -0.5 * |L^-1 (x - m)|^2 - sum(log diag L). The score is the
logistic function of the difference of the two log densities plus the log prior odds.

The statistics are computed once per document, written with the doc_id, and read for training and scoring.
Training sums counts, first and second moments per class over all labelled training rows; the driver receives
two matrices whatever the input. Moments are taken around fixed centres, so the sums stay accurate.

Inputs of a score are functions of the text alone: labels, lang, source and doc_id are never among them.
Training rows are the label rows with a quality of 0 or 1 whose crc32(doc_id as text) mod 4 is not 2.

Defined cases: null and empty texts have the statistics of a text without words; label rows that repeat count
each; null doc_ids and null qualities are not learnt from, and a null doc_id is not held out; with no label of
a class the score is the share of class 1 among the labels (0.5 without labels). Texts may be of any length:
every statistic is a ratio or the logarithm of a count over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod
from tidemark.session import materialize

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Shares of the pooled covariance and of the identity in a class covariance.
POOLED, RIDGE = 0.1, 0.05
#: The log density difference is divided by this: neighbouring statistics carry much the same evidence.
TEMPER = 2.0

STATISTICS = ["upper", "symbols", "bangs", "pipes", "digits", "stops", "blank", "other", "words", "word_len",
              "distinct", "adjacent", "dup_lines", "line_len"]
D = len(STATISTICS)

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "symbols": b"#*$%&<>@^~=+\\_{}[]", "bangs": b"!?", "pipes": b"|/",
            "digits": b"0123456789", "stops": b".,;:", "blank": b" \t\n\x0b\f\r"}
_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[list(range(97, 123)) + list(range(128, 256))] = True
_MASKS = np.array([[b in chars for b in range(256)] for chars in _CLASSES.values()], dtype=np.float64)
_OTHER = ~(_ASCII_WORD | (_MASKS.sum(0) > 0))


def statistics(raw: bytes | None) -> np.ndarray:
    """Transformed statistics of a text in UTF-8. Shares go through asin(sqrt), counts through log1p."""
    x = np.zeros(D)
    if not raw:
        return x
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = raw.split()
    k = len(words)
    shares = np.append(_MASKS @ hist, hist[_OTHER].sum()) / n
    x[:8] = np.arcsin(np.sqrt(np.minimum(shares, 1.0)))
    if not k:
        return x
    x[8] = np.log1p(k)
    x[9] = np.log1p((n - hist[[9, 10, 11, 12, 13, 32]].sum()) / k)
    # distinct words fall with length; log(distinct) / log(words) is stable over lengths
    x[10] = np.log1p(len(set(words))) / np.log1p(k)
    same = sum(map(bytes.__eq__, words, words[1:]))
    x[11] = np.arcsin(np.sqrt(same / k))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    x[12] = np.arcsin(np.sqrt(1 - len(set(lines)) / len(lines)))
    x[13] = np.log1p(n / len(lines))
    return x


def document_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``x``, the statistics of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column("_raw")]
            arrays = [batch.column(c) for c in keep] + [pa.array([list(v) for v in x], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "x"])

    own = docs.select(*keep, F.col("text").cast("binary").alias("_raw"))
    fields = [f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keep]
    return own.mapInArrow(run, ", ".join([*fields, "x array<double>"]))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products per class of rows (quality, x): each task adds up its rows, one
    aggregation adds up the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            q = np.asarray(batch.column("quality").to_pylist(), dtype=np.int64)
            x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(-1, D)
            for c in np.unique(q):
                z = np.hstack([np.ones((int((q == c).sum()), 1)), x[q == c]])
                acc[int(c)] = acc.get(int(c), 0) + z.T @ z
        out = [(c, i, v) for c, m in acc.items() for i, v in enumerate(m.ravel().tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in
                                          enumerate((pa.int32(), pa.int32(), pa.float64()))], names=["c", "i", "v"])

    summed = rows.mapInArrow(run, "c int, i int, v double").groupBy("c", "i").agg(F.sum("v").alias("v"))
    got: dict[int, np.ndarray] = {}
    for r in summed.collect():  # at most 2 * (D + 1)^2 numbers
        got.setdefault(r["c"], np.zeros((D + 1) ** 2))[r["i"]] = r["v"]
    mats = {c: m.reshape(D + 1, D + 1) for c, m in got.items()}
    return {c: (m[0, 0], m[0, 1:], m[1:, 1:]) for c, m in mats.items()}


def fit(rows: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> dict:
    """Model from rows (quality 0 or 1, x): prior, and per class mean, inverse Cholesky factor, log determinant."""
    sums = moments(rows)
    total = sum(s[0] for s in sums.values())
    if len(sums) < 2 or min(s[0] for s in sums.values()) < 2:
        return {"constant": sums[1][0] / total if 1 in sums and total else 0.0 if total else 0.5}
    means = {c: s[1] / s[0] for c, s in sums.items()}
    covs = {c: s[2] / s[0] - np.outer(means[c], means[c]) for c, s in sums.items()}
    within = sum(sums[c][0] * covs[c] for c in covs) / total
    scale = np.sqrt(np.maximum(np.diag(within), 1e-8))
    model = {"odds": float(np.log(sums[1][0] / sums[0][0])), "scale": scale}
    for c in (0, 1):
        cov = (1 - pooled) * covs[c] + pooled * within
        cov = cov / np.outer(scale, scale)
        cov = (1 - ridge) * cov + ridge * np.eye(D)
        low = np.linalg.cholesky(cov)
        model[c] = (means[c], np.linalg.inv(low), float(np.log(np.diag(low)).sum()))
    return model


def predict(x: np.ndarray, model: dict, temper: float = TEMPER) -> np.ndarray:
    """Score in [0, 1] of each row of statistics."""
    if "constant" in model:
        return np.full(len(x), model["constant"])
    dens = []
    for c in (0, 1):
        mean, inverse, log_det = model[c]
        z = ((x - mean) / model["scale"]) @ inverse.T
        dens.append(-0.5 * (z * z).sum(1) - log_det)
    logit = (dens[1] - dens[0]) / temper + model["odds"]
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, x) of the label rows that may be learnt from; ``stats`` has doc_id and x."""
    lab = (labels.select(F.col("doc_id").alias("_label_id"), "quality")
           .where(F.col("quality").isin(0, 1) & (crc_mod("doc_id", FOLDS) != HELD_OUT)))
    return stats.join(lab, F.col("doc_id") == F.col("_label_id")).select(F.col("quality").cast("int"), "x")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """The ``keep`` columns (doc_id by default) with score and predicted, a row per document."""
    keep = keep or ("doc_id",)
    stats = materialize(document_statistics(docs, *dict.fromkeys(("doc_id", *keep))), "qda-stats")
    model = fit(training_rows(stats, labels))
    kind = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(-1, D)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(predict(x, model))],
                                             names=[*keep, "score"])

    scored = stats.mapInArrow(run, f"{kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that the classifier does not reject, with all their columns. The decision needs no join: a
    second, streamed pass scores each text beside its row."""
    stats = materialize(document_statistics(docs, "doc_id"), "qda-stats")
    model = fit(training_rows(stats, labels))

    @F.pandas_udf("double")
    def score(raw):
        import pandas as pd
        return pd.Series(predict(np.array([statistics(t) for t in raw]).reshape(-1, D), model))

    return docs.where(score(F.col("text").cast("binary")) >= threshold)
