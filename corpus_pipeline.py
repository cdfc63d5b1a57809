"""From raw documents to a training mix: five stages, each an operator of ``tidemark.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read as the next
stage's documents. The first four return the columns of ``documents``: the quality classifier drops what it
rejects, line dedup shortens texts, near-dedup keeps one document of each group, decontamination drops documents
with a benchmark passage. The last returns each document as often as the mix takes it, with ``copy_no``.

A null or empty text goes through all stages as a text without words; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, line_dedup, minmax, mixing, qda
from tidemark.llm.common import table
from tidemark.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    return qda.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another one keeps; ``n_chars`` follows the text."""
    out = line_dedup.dedup(docs).drop("_n_lines", "_n_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8 or more)."""
    return minmax.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a ``benchmark`` item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at the rates of their sources."""
    return mixing.emit(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontam", benchmark),
          ("mixing", mix)]

#: The classifier cannot be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
