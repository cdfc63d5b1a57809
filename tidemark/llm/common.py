"""Shared pieces of the operators: reading a table, ASCII whitespace and letters, Arrow batches, keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The whitespace of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other code point unchanged."""
    return F.translate(c, UPPER, LOWER)


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; null for a null doc_id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element transform): Catalyst would
    otherwise copy a costly array expression into each of its uses."""
    return F.transform(F.array(value), body)[0]


class WordHashes(dict):
    """64-bit hash of each word, remembered while the vocabulary stays small."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def binary_values(column: pa.ChunkedArray | pa.Array) -> list:
    """Values of a binary Arrow column as bytes or None."""
    return column.to_pylist()

