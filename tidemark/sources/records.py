"""Comma-separated record files (no header, no quoting) read with an explicit schema.

The record files of the analyses are plain ``a,b,c`` lines. Spark's CSV reader with a fixed schema does the
split and the casts on the JVM side. The default ``mode="FAILFAST"`` makes a malformed line fail the job, as an
unguarded number parse does; ``PERMISSIVE`` keeps the job running and routes bad lines to ``_corrupt``.
:func:`parse_records` does the same for lines that come from elsewhere (a message bus, a socket, a text stream).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BY_NAME, ORDER


def _schema(kind: str | T.StructType) -> T.StructType:
    return BY_NAME[kind] if isinstance(kind, str) else kind


def _clean(df: DataFrame, schema: T.StructType) -> DataFrame:
    # An empty third field (create rows of the order log) is read as NULL; the records use "".
    if schema == ORDER:
        df = df.withColumn("tx_id", F.coalesce(F.col("tx_id"), F.lit("")))
    return df


def read_records(spark: SparkSession, path: str, kind: str | T.StructType, mode: str = "FAILFAST",
                 arrival: bool = True) -> DataFrame:
    """Read record lines of ``kind`` (``behavior``, ``ad_click``, ``login``, ``order``, ``receipt``,
    ``marketing``) or an explicit schema.

    With ``arrival=True`` a ``seq`` column gives the line order (file path, then position), which the
    arrival-ordered operators use: files carry no inherent order in Spark.
    """
    schema = _schema(kind)
    reader = spark.read.schema(
        schema if mode.upper() != "PERMISSIVE"
        else T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    ).option("header", "false").option("sep", ",").option("quote", "").option("mode", mode.upper())
    if mode.upper() == "PERMISSIVE":
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt")
    df = reader.csv(path)
    df = _clean(df, schema)
    return with_arrival(df) if arrival else df


def with_arrival(df: DataFrame, col: str = "seq") -> DataFrame:
    """Add an arrival sequence to a file scan: 0, 1, 2 .. over the lines, files by path, then by position.

    Spark packs file splits into partitions by size, so the order of partitions is not that of files. Within a
    split, ``monotonically_increasing_id`` follows the lines; the splits' line counts (one row per split, summed
    up in the order of path and offset) say where each split begins. Filters above do not move below the id.
    """
    own = df.columns
    tagged = df.select("*", F.col("_metadata.file_path").alias("_path"),
                       F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    splits = tagged.groupBy("_path", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_path", "_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_path", "_at", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return tagged.join(splits, ["_path", "_at"]).select(*own, (F.col("_id") + F.col("_shift")).alias(col))


def parse_records(lines: DataFrame, kind: str | T.StructType, value_col: str = "value", mode: str = "FAILFAST",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Lines to records of ``kind``, batch or streaming: the record's columns and the ``keep`` columns.

    ``FAILFAST`` fails on a malformed line; ``PERMISSIVE`` keeps all lines and gives a malformed one NULL fields
    and itself as ``_corrupt`` (the reject rows: ``filter("_corrupt is not null")``)."""
    schema = _schema(kind)
    permissive = mode.upper() == "PERMISSIVE"
    full = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())]) if permissive else schema
    options = {"sep": ",", "quote": "", "mode": mode.upper(), "columnNameOfCorruptRecord": "_corrupt"}
    record = F.from_csv(F.col(value_col), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full), options)
    out = lines.select(record.alias("_r"), *keep).select("_r.*", *keep)
    return _clean(out, schema)


def render_records(df: DataFrame, kind: str | T.StructType) -> DataFrame:
    """Records to lines (``value``), the reverse of :func:`parse_records`; NULL is an empty field."""
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in _schema(kind)]
    return df.select(F.concat_ws(",", *fields).alias("value"), *[c for c in df.columns if c == "seq"])


def with_event_time(df: DataFrame, unit: str = "s") -> DataFrame:
    """``ts`` from the records' ``timestamp``, in seconds or (marketing events) milliseconds."""
    return df.withColumn("ts", (F.timestamp_seconds if unit == "s" else F.timestamp_millis)("timestamp"))


def read_records_stream(spark: SparkSession, path: str, kind: str | T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of :func:`read_records`: a file-source stream of record lines."""
    schema = _schema(kind)
    reader = spark.readStream.schema(schema).option("header", "false").option("quote", "").option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _clean(reader.csv(path), schema)
