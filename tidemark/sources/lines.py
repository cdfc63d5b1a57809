"""Line streams in and out: message-bus or socket sources, and publishing lines to a sink.

Only thin configuration over Spark's own readers and writers. The kafka format needs the connector jar
on the classpath (not present in the test image); the socket format is a development aid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.arrival import arrival_order


def topic_seq(partition: Column, offset: Column) -> Column:
    """A number per message that no other message of the topic has, in the order of the offsets inside a partition
    (partitions below 65,536, offsets below 2^47)."""
    return offset.cast("long") * (1 << 16) + partition.cast("long")


def topic_lines(messages: DataFrame) -> DataFrame:
    """(value, seq): the lines of a stored or batch-read topic (value, partition, offset, timestamp) in their arrival
    order over all partitions, see :func:`arrival_order`."""
    own = messages.select(F.col("value").cast("string").alias("value"), "partition", "offset",
                          F.unix_millis("timestamp").alias("timestamp_ms"))
    return arrival_order(own).select("value", "seq")


def line_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                path: str | None = None) -> DataFrame:
    """A streaming DataFrame with one string column ``value`` per line or message (kafka: and ``seq``, see
    :func:`topic_seq`).

    ``fmt`` is ``kafka`` (options such as ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``),
    ``socket`` (``host``, ``port``) or ``text`` (a folder of files, ``path``).
    """
    reader = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return df.select(F.col("value").cast("string").alias("value"), topic_seq(F.col("partition"), F.col("offset")).alias("seq"))
    return df.select("value")


def lines_of(df: DataFrame, sep: str = ",") -> DataFrame:
    """One line per row (``value``): the columns joined by ``sep``, a NULL as an empty field in its place."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).alias("value"))


def publish_lines(df: DataFrame, fmt: str, options: dict[str, str] | None = None,
                  path: str | None = None, sep: str = ","):
    """Write each row as one keyless line/message: the columns joined by ``sep`` in a ``value`` column (see
    :func:`lines_of`). Batch DataFrames are written once; streaming ones start a query (returned).
    """
    out = lines_of(df, sep)
    writer = out.writeStream if df.isStreaming else out.write
    writer = writer.format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if df.isStreaming:
        return writer.start(path) if path else writer.start()
    if not df.isStreaming and fmt != "kafka":
        writer = writer.mode("append")
    return writer.save(path) if path else writer.save()
