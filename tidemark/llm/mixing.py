"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target and with it a repetition rate target / size, and a
document is emitted floor(rate) times plus once more with a probability equal to the fraction, decided by a
hash of the seed, the doc_id and the text. The draw depends on nothing else, so reruns, partitionings and
retried tasks agree.

Defined cases: a null text has no words; a document without words is taken 0 words (its copies are empty); a
null source is a source of its own, sorted last; rows that repeat a doc_id and text share one draw; an empty
table gives an empty mix. A source without any word has target 0 and rate 0. ``emit`` keeps extra columns, but for one
named ``copy_no``, which its own replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACES
from tidemark.session import materialize

#: Fixed values of the contract: the weights repeat over the sorted sources.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_REPEATS = 2
SEED = "mix"
#: The draw is the first 13 hex digits of an md5: 52 bits, exact in a double.
DRAW_DIGITS = 13


def words_in(text: str) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; 0 for null."""
    t = F.trim(F.col(text), F.lit(SPACES))
    return F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.size(F.split(t, r"[\x20\x09-\x0D]+"))).cast("long")


def draw(seed: str, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Uniform number in [0, 1) from (seed, doc_id, text)."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                      F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, DRAW_DIGITS), 16, 10).cast("double") / F.lit(float(16 ** DRAW_DIGITS))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT,
                   most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source, source_size, target.

    The sources are ranked by one distributed sort (zipWithIndex over one row per source). The shares are a
    water-filling: a source whose share lies above its cap stops there and the excess is shared anew, until
    none is above. A round is one aggregate over the sources that brings two sums to the driver.
    """
    spark = sizes.sparkSession
    per = materialize(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "mix-sources")
    ranked = per.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda r: (r[0]["source"], r[0]["source_size"], int(weights[r[1] % len(weights)])))
    schema = T.StructType([T.StructField("source", per.schema["source"].dataType),
                           T.StructField("source_size", T.LongType()), T.StructField("weight", T.LongType())])
    ranked = materialize(spark.createDataFrame(ranked, schema), "mix-ranked")
    cap = most * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_capped = -1.0, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        r = ranked.agg(F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                       F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if r[0] == n_capped or r[2] == 0:
            break
        n_capped = r[0]
        level = (total * share_percent / 100 - r[1]) / r[2]
    share = F.lit(float(level)) * F.col("weight")
    return ranked.select("source", "source_size",
                         F.when(cap <= share, cap.cast("double")).otherwise(share).alias("target"))


def _copies(u: Column, rate: str) -> Column:
    return (F.floor(rate) + (u < F.col(rate) - F.floor(rate)).cast("long")).cast("long")


def source_rates(sizes: DataFrame, **targets) -> DataFrame:
    """``source_targets`` with the repetition rate of each source."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return source_targets(sizes, **targets).withColumn("rate", rate)


def mix(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """doc_id, source, size, u (the draw), source_size, target, rate and copies, one row per document. Texts
    are read once; the few columns derived from them are written and read for the second use."""
    sized = materialize(docs.select("doc_id", "source", words_in("text").alias("size"), draw(seed).alias("u")),
                        "mix-sizes")
    per = source_rates(sized, **targets).withColumnRenamed("source", "_src")
    return (sized.join(per, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
            .withColumn("copies", _copies(F.col("u"), "rate")))


def emit(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """The mix itself: each document's row as often as it is taken, with ``copy_no`` from 1."""
    per = source_rates(docs.select("source", words_in("text").alias("size")), **targets).select(
        F.col("source").alias("_src"), F.col("rate").alias("_rate"))
    own = [F.col(f"`{c}`") for c in docs.columns if c != "copy_no"]
    out = docs.join(per, F.col("source").eqNullSafe(F.col("_src"))).withColumn(
        "_copies", _copies(draw(seed), "_rate").cast("int"))
    return out.where(F.col("_copies") > 0).select(
        *own, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy_no"))
