"""MinHash near-dedup with min-max hashing.

Under each permutation of the 64-bit shingle hashes the smallest and the largest value are kept: two values of
a signature for one hash evaluation. Either agrees between two sets with a probability equal to their Jaccard
similarity, and as the two come from one permutation they are negatively correlated, so the share of agreeing
values is an unbiased estimate with a lower variance. The values are cut into bands; documents that agree in a
band are candidates. With 336 permutations, 672 values, 84 bands of 8, a pair of long texts at the threshold 0.8 is
missed with a probability of 2e-7. In short texts smallest and largest agree together less often, for k of n
shingles in k (k - 1) / (n (n - 1)): 1e-6 for 8 of 10, 9e-6 for 4 of 5. Candidates are confirmed on their full
shingle sets.

Groups of any size: documents with equal word sequences are one class and are represented by one text. In a
bucket no pairs are listed: each class is compared with the bucket's smallest and largest class only (one
of each over all its buckets), and confirmed links are put together to components. Then only candidates that
are still in different components are compared, so that no link between components is lost. Buckets have no
cap; the smallest and largest class come from partial aggregations that are joined back.

Texts are read twice: for the signatures and, of the classes with candidates alone, for their sets.

Defined cases: null texts and texts without words have an empty set and are linked with nothing, not even
their copies; of fewer words than a shingle the whole sequence is the one shingle. Rows that repeat a doc_id
are documents of their own with the same id; a null doc_id is no component's name as long as another member
has one. Ties cannot matter, as the component's smallest doc_id is kept. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, binary_values
from tidemark.llm.graph import components, files_for
from tidemark.session import materialize

SHINGLE = 5
PERCENT = 80
PERMUTATIONS = 336
BAND = 8
ROUNDS = 2
SEED = 20
_CHUNK = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct 64-bit hashes, sorted, of the shingles of a sequence of word hashes."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = _scramble(h * _MIX + words[i:i + n])
    return np.unique(h)


def permutations(n: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of bijections of the 64-bit integers."""
    rng = np.random.default_rng(seed)
    draw = lambda: rng.integers(0, 1 << 64, size=(n, 1), dtype=np.uint64)
    return draw() | np.uint64(1), draw()


def signature(hashes: np.ndarray, perms: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest and largest value under each permutation: 2 n values."""
    a, b = perms
    low = high = None
    for i in range(0, len(hashes), _CHUNK):
        v = a * hashes[i:i + _CHUNK][None, :] + b
        lo, hi = v.min(1), v.max(1)
        low = lo if low is None else np.minimum(low, lo)
        high = hi if high is None else np.maximum(high, hi)
    return np.ravel(np.column_stack([low, high]))


def bands_of(sig: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key for each band of ``band`` values; keys of different bands differ."""
    m = sig[:len(sig) // band * band].reshape(-1, band)
    key = np.arange(1, len(m) + 1, dtype=np.uint64)
    for j in range(band):
        key = _scramble(key * _MIX + m[:, j])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Unbiased estimate of the Jaccard similarity from two signatures."""
    return float((a == b).mean())


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-cased words [^\\x20\\x09-\\x0D]+ of a text in UTF-8."""
    return raw.lower().split() if raw else []


def text_key(text: str = "text") -> Column:
    """Tells the rows of one doc_id apart."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def _signed(docs: DataFrame, shingle: int, perms, band: int) -> DataFrame:
    """doc_id, tk, ck (128-bit key of the word sequence, null without words), n_shingles, bands."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys, n, bands = [], [], []
            for raw in binary_values(batch.column("raw")):
                words = words_of(raw)
                s = shingle_hashes(hashes.of(words), shingle)
                keys.append(hashlib.md5(b" ".join(words)).digest() if words else None)
                n.append(len(s))
                bands.append(bands_of(signature(s, perms), band) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tk"), pa.array(keys, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "tk", "ck", "n_shingles", "bands"])

    return (docs.select("doc_id", text_key().alias("tk"), F.col("text").cast("binary").alias("raw"))
            .mapInArrow(run, f"doc_id {kind}, tk string, ck binary, n_shingles long, bands array<long>"))


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(cid, hashes) for the wanted classes (cid, home, tk): the set of one document of each."""
    own = docs.select("doc_id", text_key().alias("own_tk"), F.col("text").cast("binary").alias("raw"))
    found = (wanted.join(own, F.col("doc_id").eqNullSafe(F.col("home")) & (F.col("own_tk") == F.col("tk")))
             .select("cid", "raw").dropDuplicates(["cid"]))  # a repeated row has its class once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            s = [shingle_hashes(hashes.of(words_of(raw)), shingle).view(np.int64)
                 for raw in binary_values(batch.column("raw"))]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(s, pa.list_(pa.int64()))],
                                             names=["cid", "hashes"])

    return found.mapInArrow(run, "cid long, hashes array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("cid").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("cid").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def _sizes_fit(n: str, m: str, percent: int) -> Column:
    return F.lit(100) * F.least(F.col(n), F.col(m)) >= F.lit(percent) * F.greatest(F.col(n), F.col(m))


def _merged(label: DataFrame, links: DataFrame, files: int) -> DataFrame:
    """``label`` (cid, component) after the links (a, b) have merged components."""
    end = lambda c: label.select(F.col("cid").alias(c), F.col("component").alias(f"c{c}"))
    edges = links.join(end("a"), "a").join(end("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    new = components(edges, files).select("id", F.col("component").alias("root"))
    return materialize(label.join(new, F.col("component") == F.col("id"), "left")
                       .select("cid", F.coalesce("root", "component").alias("component")), "minmax-labels", files)


def _mixed(members: DataFrame, label: DataFrame, turn: int) -> DataFrame:
    """The members of buckets with several components, with their number and with one class of the first and one
    of the last component; which of a component's classes changes by bucket and turn."""
    apart = members.join(label, "cid")
    pick = F.struct("component", F.xxhash64("cid", "key", F.lit(turn)).alias("draw"), "cid", "n")
    ends = (apart.groupBy("key").agg(F.min(pick).alias("low"), F.max(pick).alias("high"), F.count(F.lit(1)).alias("size"))
            .where("low.component <> high.component"))
    return apart.join(ends, "key")


def _partners(mixed: DataFrame, percent: int) -> DataFrame:
    """For each class, one class of another component in each of its buckets: pairs (a, b)."""
    other = F.when(F.col("component") != F.col("low.component"), F.col("low")).otherwise(F.col("high"))
    return (mixed.select("cid", "n", other.alias("o")).where(_sizes_fit("n", "o.n", percent))
            .select(F.least("cid", "o.cid").alias("a"), F.greatest("cid", "o.cid").alias("b")).distinct())


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(cid, n, left, component, h): of each set (cid, component, hashes) the rarest shingles, so many that a set
    that reaches the similarity must hold one of them among its own rarest; ``left`` is how many shingles of the
    set are not rarer than this one, itself included."""
    each = sets.select("cid", "component", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    counts = each.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("cid").orderBy("df", "h"))
    need = F.ceil(F.lit(percent) * F.col("n") / F.lit(100))
    return (each.join(counts, "h").withColumn("left", F.col("n") - rank + 1)
            .where((F.col("left") >= need) & (F.col("df") > 1)).select("cid", "n", "left", "component", "h"))


def _apart(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a rare shingle that can be the first of enough. Two sets
    that reach the similarity p have at least p / (1 + p) of their sizes in common, all of it from the first
    common shingle (in the order of rarity) on; so at that one, both have as many shingles left."""
    sizes = rare.groupBy("h", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("h").agg(F.max(F.struct("m", "component")).alias("top"), F.count(F.lit(1)).alias("k")).where(
        "k > 1").select("h", F.col("top.component").alias("largest"))
    shared = rare.join(largest, "h")
    x = shared.where("component <> largest").select("h", F.col("cid").alias("a"), F.col("n").alias("na"),
                                                    F.col("left").alias("la"), F.col("component").alias("ca"))
    y = shared.select("h", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("left").alias("lb"),
                      F.col("component").alias("cb"))
    enough = (100 + percent) * F.least("la", "lb") >= percent * (F.col("na") + F.col("nb"))
    return (x.join(y, "h").where((F.col("ca") != F.col("cb")) & _sizes_fit("na", "nb", percent) & enough)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _classified(docs: DataFrame, shingle: int, percent: int, n_permutations: int, band: int) -> DataFrame:
    """doc_id, tk, n_shingles, component_id; one row per document."""
    docs = docs.select("doc_id", "text")
    signed = materialize(_signed(docs, shingle, permutations(n_permutations), band), "minmax-signed")
    # one row per class of equal word sequences; its number is fixed by being written
    classes = materialize(
        signed.where(F.col("ck").isNotNull()).groupBy("ck").agg(
            F.min(F.struct("doc_id", "tk")).alias("home"), F.min("doc_id").alias("smallest"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "minmax-classes")
    keyed = classes.select("cid", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("cid").alias("c0"), F.max("cid").alias("c1")).where("c0 <> c1").select("key")
    members = materialize(keyed.join(shared, "key"), "minmax-members")
    files = files_for(members.count())
    label = materialize(members.select("cid").distinct().withColumn("component", F.col("cid")), "minmax-labels", files)
    sets = materialize(_sets(docs, label.join(classes, "cid").select(
        "cid", F.col("home.doc_id").alias("home"), F.col("home.tk").alias("tk")), shingle), "minmax-sets")
    tested = None
    for turn in range(ROUNDS):
        pairs = _partners(_mixed(members, label, turn), percent)
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "minmax-pairs", files)
        links = materialize(_linked(pairs, sets, percent).repartition(files), "minmax-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not links.isEmpty():
            label = _merged(label, links, files)
    # classes that still share a bucket with another component; the one pair of a bucket of two is tested
    rest = _mixed(members, label, ROUNDS).where("size > 2").select("cid", "component").distinct()
    rare = materialize(_rarest(sets.join(rest, "cid"), percent), "minmax-rarest")
    pairs = _apart(rare, percent).join(tested, ["a", "b"], "left_anti")
    label = _merged(label, materialize(_linked(pairs, sets, percent).repartition(files), "minmax-links"), files)
    named = classes.select("cid", F.col("ck").alias("class_key"), "smallest").join(label, "cid", "left")
    lowest = (named.where("component is not null").groupBy("component").agg(F.min("smallest").alias("lowest"))
              .withColumnRenamed("component", "of"))
    by_class = (named.join(lowest, F.col("component") == F.col("of"), "left")
                .select("class_key", F.coalesce("lowest", "smallest").alias("lowest")))
    return (signed.select("doc_id", "tk", "ck", "n_shingles").join(by_class, F.col("ck") == F.col("class_key"), "left")
            .select("doc_id", "tk", "n_shingles",
                    F.when(F.col("ck").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    n_permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per document."""
    return _classified(docs, shingle, percent, n_permutations, band).drop("tk").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                n_permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """The documents that stay, one of each group, with all their columns. Rows that repeat the kept doc_id with
    an equal text are one document and stay together."""
    gone = (_classified(docs, shingle, percent, n_permutations, band)
            .where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_gone_id"), F.col("tk").alias("_gone_tk")).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (text_key() == F.col("_gone_tk")), "left_anti")
