"""The registered queries ``opN_<name>``: each runs its operator over the whole table and derives the columns
of its contract from what the operator returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontam, line_dedup, minmax, mixing, outliers, packing, ppm, prefix_trie, qda, runs, tool_calls, url_lists, warc)
from tidemark.llm.common import table


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluate(url_lists.captures_of(pages), url_lists.entries_of(pages))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read(spark, path).drop("url", "payload")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = qda.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                       table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("doc_id", qda.held_out().alias("held_out"), "score", "predicted")


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decontam.digest(decontam.phrase_matches(index, table(spark, sf_dir, "benchmark")))


def op5_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents")).drop("distance")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return tool_calls.link(tool_calls.calls_of(conversations), tool_calls.results_of(conversations),
                           tool_calls.tool_schemas(spark))


def op10_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digest(runs.find(runs.with_planted_runs(docs)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.build(prefix_trie.rebuilt(prefix_trie.numbered(turns)))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {
    "op1_url_lists": op1_url_lists,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_decontam": op4_decontam,
    "op5_outliers": op5_outliers,
    "op6_line_dedup": op6_line_dedup,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_tool_calls": op9_tool_calls,
    "op10_minmax": op10_minmax,
    "op11_runs": op11_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_packing": op13_packing,
}
