"""Quality rules: robust multivariate outliers, in DataFrame functions only.

Base statistics are counted over each whole text in one row-wise expression, written once, and transformed to
five features. Per language and source a minimum-covariance-determinant estimate of their centre and scatter
is found by concentration steps: the half of the rows with the smallest Mahalanobis distances under the current
estimate gives the next one, which never raises the determinant. Two starts are concentrated, and the one with
the smaller determinant is taken, corrected for the trimming, reweighted once, and used for the distances. A
document whose squared distance exceeds the cutoff is rejected. Half of the rows, as a third of a group may be
copies of one junk text: these share a bin, and a mark that falls into it would take all of them.

A step is a single aggregation: distances fall into bins of their logarithm, and count and moments are summed
per group and bin, at most ``BINS`` rows a group however many documents it has; the bins up to the half mark are
then added up. So a group with most of the documents is summed by all tasks. Scatter matrices get a small
diagonal (``FLOORS``), as features such as symbols are constant in most clean text. Cholesky factors and their inverses
are columns of the small table of estimates.

Every group has an estimate of its own, whatever its size, pulled towards that of its language with the weight of
``SHRINK`` documents: centre and scatter are n / (n + SHRINK) its own. The language's is pulled towards that of all
documents likewise, and the scatter of that towards ``PRIOR``. So a small group is judged mostly by its language, a
large one by itself, and nothing changes at any size at once.

Defined cases: a null or empty text has no words, so it fails the base rules; a null lang or source is a value
of its own; rows that repeat count each; documents that fail the base rules take no part in the estimates; an
empty table gives an empty result. Windows are compared by 64-bit hashes. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let
from tidemark.llm.graph import files_for
from tidemark.session import materialize

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEAT_PERCENT = 30

#: Standard deviations that are added to each feature's own, in the order of ``features``.
FLOORS = (0.5, 0.15, 0.1, 0.05, 0.1)
D = len(FLOORS)
KEPT_SHARE = 0.5
STEPS = 3
#: Documents that the estimate of the level above counts for, and the standard deviations that the scatter of all documents
#: is pulled towards, which matters for tables of a few documents only.
SHRINK = 50
PRIOR = (1.5, 0.5, 0.3, 0.3, 0.3)
#: Documents of a clean group beyond the cutoff: 1 in 100,000 if its features were normal.
CUTOFF_TAIL = 1e-5
REWEIGHT_TAIL = 0.025
#: Bins of the logarithm of a squared distance: 16 a unit, from -8 to 24.
BINS, PER_UNIT, LOWEST = 512, 16, -8.0


def chi2_cdf(x: float, df: int) -> float:
    a, x = df / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= x / (a + n)
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < p else (lo, mid)
    return lo


CUTOFF = chi2_quantile(1 - CUTOFF_TAIL, D)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text."""
    hashes = F.when(F.size(words) < window, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - F.lit(window - 1))),
                    lambda i: F.xxhash64(F.slice(words, i, window))))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
            twice = F.filter(s, lambda e, k: same(e, k + 1) | same(e, k - 1))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        def step(acc: Column, p: Column) -> Column:
            return F.struct((acc["n"] + p + F.lit(window) - F.greatest(acc["end"], p)).cast("long").alias("n"),
                            (p + F.lit(window)).alias("end"))

        count = F.aggregate(let(ordered, positions), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                            step, lambda acc: acc["n"])
        # most texts have no repeated window; only the others are sorted
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(count)

    return let(hashes, covered)


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.trim(text, F.lit(SPACES))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    counted = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    out = docs.select(
        "doc_id", "lang", "source", counted.alias("w"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")).alias("n_dup_lines"))
    out = out.select("doc_id", "lang", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
                     "n_dup_lines", F.col("w.r").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def features() -> list[Column]:
    """Length, word length, symbols, repeated lines and repeated words; shares by their square roots."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p(F.col("n_words").cast("double")), F.log(F.greatest(F.col("word_chars") / n, F.lit(1.0))),
            F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]


def group_key(*parts: str | None) -> Column:
    """Name of a group; None stands for any value, and a null value is a value."""
    one = [F.lit("*") if p is None else F.coalesce(F.concat(F.lit("="), F.col(p)), F.lit("null")) for p in parts]
    return F.concat_ws("\u0001", *one)


X = [f"x{i}" for i in range(D)]
_PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _moments(weight: Column | None = None) -> list[Column]:
    w = (lambda c: c) if weight is None else (lambda c: F.when(weight, c))
    return [F.count(w(F.lit(1))).alias("n"), *[F.sum(w(F.col(X[i]))).alias(f"s{i}") for i in range(D)],
            *[F.sum(w(F.col(X[i]) * F.col(X[j]))).alias(f"q{i}{j}") for i, j in _PAIRS]]


_SUMS = ["n", *[f"s{i}" for i in range(D)], *[f"q{i}{j}" for i, j in _PAIRS]]


_MOMENTS = [*[f"m{i}" for i in range(D)], *[f"c{i}{j}" for i, j in _PAIRS]]


def _moments_of(sums: DataFrame, factor: float) -> DataFrame:
    """Centre m and scatter c from sums; ``factor`` corrects for the trimming."""
    keys = [c for c in sums.columns if c not in _SUMS]
    out = sums.select(*keys, "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(D)],
                      *[F.col(f"q{i}{j}") for i, j in _PAIRS])
    cov = {(i, j): factor * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) for i, j in _PAIRS}
    return out.select(*keys, *[f"m{i}" for i in range(D)], *[
        (F.greatest(v, F.lit(0.0)) if i == j else v).alias(f"c{i}{j}") for (i, j), v in cov.items()])


def _factored(moments: DataFrame) -> DataFrame:
    """Centre m, inverse Cholesky factor w and log determinant of centre and scatter; the scatter gets its floors."""
    keys = [c for c in moments.columns if c not in _MOMENTS]
    out = moments.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[i] ** 2 for i in range(D)})
    low = lambda i, j: F.col(f"l{i}{j}")
    dot = lambda terms: sum(terms, F.lit(0.0))
    for j in range(D):
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(
            F.col(f"c{j}{j}") - dot(low(j, k) * low(j, k) for k in range(j)), F.lit(1e-12))))
        if j + 1 < D:
            out = out.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - dot(low(i, k) * low(j, k) for k in range(j)))
                                   / low(j, j) for i in range(j + 1, D)})
    for off in range(D):
        out = out.withColumns({f"w{j + off}{j}": 1 / low(j, j) if not off else
                               -dot(low(j + off, k) * F.col(f"w{k}{j}") for k in range(j, j + off)) / low(j + off, j + off)
                               for j in range(D - off)})
    return out.select(*keys, *[f"m{i}" for i in range(D)], *[f"w{i}{j}" for i, j in _PAIRS],
                      (2 * dot(F.log(low(j, j)) for j in range(D))).alias("log_det"))


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    return _factored(_moments_of(sums, factor))


def distance() -> Column:
    """Squared Mahalanobis distance of x under the estimate beside it."""
    total = F.lit(0.0)
    for i in range(D):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w{i}{j}") * (F.col(X[j]) - F.col(f"m{j}"))
        total = total + y * y
    return total


def _bin(d2: Column) -> Column:
    at = F.floor((F.log(F.greatest(d2, F.lit(1e-9))) - LOWEST) * PER_UNIT)
    return F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1)).cast("int")


def _concentrated(binned: DataFrame, share: float) -> DataFrame:
    """Add up, per group, the bins that hold the ``share`` of rows nearest to the centre."""
    from pyspark.sql import Window
    order = Window.partitionBy("g", "start").orderBy("bin")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy("g", "start"))
    near = (binned.withColumn("before", F.coalesce(upto, F.lit(0))).withColumn("total", total)
            .where(F.col("before") < F.ceil(F.lit(share) * F.col("total"))))
    return near.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _medians(members: DataFrame) -> DataFrame:
    """Per group the median of each feature, to the hundredth: counts of rounded values, at most some thousand
    a group, and their running sums."""
    from pyspark.sql import Window
    long = members.select("g", F.posexplode(F.array(*X)).alias("f", "v"))
    counts = long.groupBy("g", "f", F.round("v", 2).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("g", "f")
    upto = F.sum("n").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    mid = (counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(w))
           .where(2 * F.col("upto") >= F.col("total")).groupBy("g", "f").agg(F.min("v").alias("v")))
    return mid.groupBy("g").agg(*[F.max(F.when(F.col("f") == i, F.col("v"))).alias(f"c{i}") for i in range(D)])


def estimates(rows: DataFrame, steps: int = STEPS, share: float = KEPT_SHARE) -> DataFrame:
    """One row per group g of rows (g, x0 ..): n (its rows), m, c, the minimum-covariance-determinant estimate."""
    d2 = chi2_quantile(share, D)
    factor = share / chi2_cdf(d2, D + 2)
    inside = chi2_quantile(1 - REWEIGHT_TAIL, D)
    # the small tables are written, in few files, so that their size is known and the rows need not be dealt out
    # by group to meet them; a shuffle of the result makes the files, so the tasks before it stay as many as they are
    files = files_for(rows.select("g").distinct().count())
    written = lambda df: materialize(df.repartition(files), "mcd")
    centre = written(_medians(rows))
    # the first subsets: nearest to the medians in all features together, and in the worst of them
    scaled = [(F.col(X[i]) - F.col(f"c{i}")) / F.lit(FLOORS[i]) for i in range(D)]
    first = rows.join(centre, "g").select("g", *X, F.explode(F.array(
        F.struct(F.lit(0).alias("start"), _bin(sum((s * s for s in scaled), F.lit(0.0))).alias("bin")),
        F.struct(F.lit(1).alias("start"), _bin(F.greatest(*[s * s for s in scaled])).alias("bin")))).alias("b"))
    binned = first.select("g", "b.start", "b.bin", *X).groupBy("g", "start", "bin").agg(*_moments())
    est = written(_estimate(_concentrated(binned, share), factor))
    for _ in range(steps):
        binned = rows.join(est, "g").select("g", "start", _bin(distance()).alias("bin"), *X).groupBy(
            "g", "start", "bin").agg(*_moments())
        est = written(_estimate(_concentrated(binned, share), factor))
    best = est.groupBy("g").agg(F.min(F.struct("log_det", "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    est = written(est.join(best, ["g", "start"]))
    near = rows.join(est, "g").withColumn("near", distance() <= F.lit(inside))
    sums = near.groupBy("g").agg(F.count(F.lit(1)).alias("n_rows"), *_moments(F.col("near")))
    return written(_moments_of(sums, (1 - REWEIGHT_TAIL) / chi2_cdf(inside, D + 2))).withColumnRenamed("n_rows", "n")


def shrunk(est: DataFrame, names: DataFrame, shrink: int = SHRINK) -> DataFrame:
    """names (group, g0 its own group, g1 its language's, g2 all) with m and w: each level's estimate (g, n, m, c) pulled
    towards the one above, the scatter of all documents towards ``PRIOR``."""
    out = names
    for level in (2, 1, 0):
        own = est.select(F.col("g").alias(f"g{level}"), F.col("n").alias("_n"), *[F.col(c).alias(f"_{c}") for c in _MOMENTS])
        out = out.join(own, f"g{level}")
        weight = F.col("_n") / (F.col("_n") + F.lit(shrink))
        if level == 2:
            above = {c: F.col(f"_{c}") for c in _MOMENTS} | {
                f"c{i}{j}": F.lit(PRIOR[i] ** 2 if i == j else 0.0) for i, j in _PAIRS}
        else:
            above = {c: F.col(c) for c in _MOMENTS}
        # an estimate without any near row (a few rows far apart) leaves it to the level above
        out = out.withColumns({c: F.coalesce(weight * F.col(f"_{c}") + (1 - weight) * above[c], above[c]) for c in _MOMENTS})
        out = out.drop("_n", *[f"_{c}" for c in _MOMENTS])
    return _factored(out.drop("g0", "g1", "g2"))


def judge(docs: DataFrame, cutoff: float = CUTOFF, shrink: int = SHRINK) -> DataFrame:
    """The base statistics with distance (null for documents that fail the base rules) and kept, one row per document."""
    base = materialize(base_statistics(docs.select("doc_id", "lang", "source", "text"))
                       .withColumns(dict(zip(X, features()))), "mcd-base")
    good = base.where(~F.col("base_failed"))
    levels = [group_key("lang", "source"), group_key("lang", None), group_key(None, None)]
    rows = materialize(good.select(F.explode(F.array(*levels)).alias("g"), *X), "mcd-rows")
    est = estimates(rows)
    names = good.select("lang", "source").distinct().select(
        group_key("lang", "source").alias("group"), *[g.alias(f"g{i}") for i, g in enumerate(levels)])
    chosen = materialize(shrunk(est, names, shrink).repartition(files_for(est.count())), "mcd")
    out = base.withColumn("group", group_key("lang", "source")).join(chosen, "group", "left")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), distance()))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= F.lit(cutoff), F.lit(True)))
                      .alias("kept"))
