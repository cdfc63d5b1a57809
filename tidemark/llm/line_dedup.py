"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed, sorted table (line hash, number of documents, top) with one row per hash. Documents come
in batches, largest doc_ids first. Each batch counts its own hashes and merge-anti-joins the runs so far: the
hashes that no run holds are its new lines, and the batch's largest doc_id with such a line is its keeper
(``top``); hashes that a run holds only add to the count. Both make up the batch's own run at level 0. When a
level holds ``fanout`` runs, they are compacted by one merge into a run of the next level. All runs are
bucketed and sorted by the hash alike, so neither anti-joins nor compactions move a run through a shuffle.

After the last batch the runs tell of each line in how many documents it stands and which of them keeps it.
``dedup`` drops the lines that stand in at least ``min_docs`` documents from all others. Only the hashes of
dropped lines are joined back to the documents. A very common line is counted by partial aggregation, and the
join that finds its documents can be split by adaptive execution, as nothing stands between its shuffles.

Hashes are two 64-bit hashes of the key (128 bits).

Defined cases: a null or empty text is one empty line, and comes back as an empty text; rows that repeat a
doc_id are one document, all of them keep or lose a line alike; a null doc_id is one document that sorts
before all others; a key that a document holds more than once counts once. An empty table gives an empty
result. Extra columns are carried by ``dedup`` and otherwise not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, ascii_lower, let
from tidemark.session import checkpoint_path, delete_path, scratch_path

MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 2
BATCHES = 3
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def key_hash(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("line"), key)


def lines_of(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


class LineRuns:
    """The runs of one store, as bucketed tables with their files in the shared checkpoint folder. ``kept``: a store that
    later sessions go on with; else its files go when the driver ends. ``merged`` names the runs that a compaction has
    put into another; they stay while the lines returned by :meth:`add` may read them, until :meth:`drop`."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT, kept: bool = True):
        self.spark, self.fanout, self.kept = spark, fanout, kept
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        self.merged: list[str] = []
        self.n = 0

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.name}_{self.n}"
        self.n += 1
        folder = f"{self.name}-{self.n}"
        self.paths[name] = checkpoint_path(self.spark, folder) if self.kept else scratch_path(self.spark, folder)
        (rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet")
         .option("path", self.paths[name]).saveAsTable(name))
        return name

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """One row per hash over some runs: merge-joins of tables that are bucketed alike."""
        out = self._table(names[0])
        for name in names[1:]:
            b = self._table(name).select(*KEY, F.col("n_docs").alias("n2"), F.col("top").alias("t2"))
            out = out.join(b.hint("merge"), KEY, "full").select(
                *KEY, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n_docs"),
                F.greatest("top", "t2").alias("top"))
        return out

    def add(self, own: DataFrame) -> DataFrame:
        """Add a batch (h1, h2, n_docs, top; one row per hash). Returns its new lines, those in no earlier run."""
        fresh, seen = own, None
        for name in self.runs():
            run = self._table(name).select(*KEY)
            known = fresh.join(run.hint("merge"), KEY, "left_semi")
            fresh = fresh.join(run.hint("merge"), KEY, "left_anti")
            seen = known if seen is None else seen.unionByName(known)
        if seen is None:
            rows = own
        else:
            rows = fresh.unionByName(seen.withColumn("top", F.lit(None).cast(own.schema["top"].dataType)))
        self._push(0, self._write(rows))
        self.compact()
        return fresh

    def _push(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def compact(self) -> None:
        """Merge every level that is full into one run of the next."""
        level = 0
        while level < len(self.levels):
            names = self.levels[level]
            if len(names) >= self.fanout:
                merged = self._write(self._merged(names))
                self.levels[level] = []
                self._push(level + 1, merged)
                self.merged += names
            level += 1

    def drop(self, names: list[str] | None = None) -> None:
        """Remove runs (all by default): tables and files. What still reads them fails afterwards."""
        gone = list(self.paths) if names is None else names
        for name in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(self.spark, self.paths.pop(name))
        self.levels = [[n for n in level if n not in gone] for level in self.levels]
        self.merged = [n for n in self.merged if n not in gone]

    def lines(self) -> DataFrame:
        """One row per hash over all runs: h1, h2, n_docs, top."""
        return self._merged(self.runs())


def _long_hashes(min_chars: int) -> Column:
    """Distinct hashes of a document's lines whose key has at least ``min_chars`` code points."""
    keys = F.filter(F.transform(lines_of(), line_key), lambda k: F.length(k) >= min_chars)
    return F.array_distinct(F.transform(keys, lambda k: F.struct(*[h.alias(n) for n, h in zip(KEY, key_hash(k))])))


def _ranges(docs: DataFrame, n: int) -> Column:
    """Batch of a doc_id: 0 for the largest ids. The cuts are approximate quantiles; any cuts are right."""
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 1000)).first()[0] or []
    batch = F.lit(0)
    for i, cut in enumerate(sorted(set(cuts), reverse=True)):
        batch = F.when(F.coalesce(F.col("doc_id") < F.lit(cut), F.lit(True)), F.lit(i + 1)).otherwise(batch)
    return batch


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id and ``gone``, the hashes of the lines that this document loses; only documents that lose any."""
    spark = docs.sparkSession
    n = max(1, batches)
    hashed = (docs.select("doc_id", _ranges(docs, n).alias("batch"), F.explode(_long_hashes(min_chars)).alias("k"))
              .select("doc_id", "batch", "k.h1", "k.h2"))
    path = scratch_path(spark, f"line-hashes-{uuid.uuid4().hex}")
    hashed.write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema("doc_id " + docs.schema["doc_id"].dataType.simpleString()
                               + ", h1 long, h2 long, batch int").parquet(path)
    store = LineRuns(spark, fanout=fanout, kept=False)
    for b in range(n):
        store.add(hashed.where(F.col("batch") == b).groupBy(*KEY).agg(
            F.count_distinct(F.struct("doc_id")).alias("n_docs"), F.max("doc_id").alias("top")))
        store.drop(list(store.merged))  # the batch's new lines are read no more
    common = store.lines().where(F.col("n_docs") >= min_docs).select(
        *[F.col(k).alias(f"c{k}") for k in KEY], "top")
    gone = (hashed.join(common, (F.col("h1") == F.col("ch1")) & (F.col("h2") == F.col("ch2")))
            .where(~F.col("doc_id").eqNullSafe(F.col("top"))))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone"))


def dedup(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with the remaining lines as ``text``, and ``_n_lines`` and ``_n_dropped``."""
    min_chars = params.get("min_chars", MIN_CHARS)
    gone = dropped_lines(docs, **params).select(F.col("doc_id").alias("_gone_id"), F.col("gone").alias("_gone"))

    def stays(line: Column) -> Column:
        key = line_key(line)
        h = F.struct(*[h.alias(n) for n, h in zip(KEY, key_hash(key))])
        return (F.length(key) < min_chars) | ~F.array_contains(F.col("_gone"), h)

    kept = F.when(F.col("_gone").isNull(), lines_of()).otherwise(F.filter(lines_of(), stays))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")), "left")
    # the array is bound once, so the lines are split and filtered a single time
    out = let(kept, lambda a: F.struct(F.array_join(a, "\n").alias("text"), F.size(a).cast("long").alias("n")))
    own = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return (joined.select(*own, F.size(lines_of()).cast("long").alias("_n_lines"), out.alias("_out"))
            .select(*[F.col("_out.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                    "_n_lines", (F.col("_n_lines") - F.col("_out.n")).alias("_n_dropped")))
