"""A total arrival order over the partitions of a message topic.

Offsets order the messages of one partition only, and producers' timestamps may run backwards in it. A message's
*progress* is the latest timestamp that its partition has reached by then, which never falls along the offsets.
Messages are ordered by (progress, partition, offset): every partition keeps its own order, partitions are
interleaved by time, and the same messages always get the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import arrival_chunk, rank, running_agg
from tidemark.session import materialize


def arrival_order(messages: DataFrame, time_ms: str = "timestamp_ms", partition: str = "partition", offset: str = "offset",
                  out: str = "seq", rows_per_chunk: int = 1 << 20) -> DataFrame:
    """Add ``out``: the position of each message, from 0, gapless.

    Progress is a running maximum per partition over chunks of ``rows_per_chunk`` offsets, so a partition that holds most
    of the messages is spread over tasks. The order is cut by ranges of (progress, partition, offset) from Spark's
    own sample, and written with its range number; positions in a range are then moved by the rows of the ranges
    before. So however many messages one instant holds, no task orders more than its range.

    A NULL timestamp takes its partition's progress (before the first timestamp: ahead of all others). A NULL
    partition is a partition of its own. A message without an offset has no place: its ``out`` is NULL. Rows that
    repeat (partition, offset) are next to each other, in any order.
    """
    placed = messages.where(F.col(offset).isNotNull()).withColumn("_ochunk", arrival_chunk(offset, rows_per_chunk))
    marked = running_agg(placed, [partition], [offset], "_ochunk", time_ms, "_progress", agg="max").drop("_ochunk")
    order = ["_progress", partition, offset]
    ranges = materialize(marked.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "arrival-ranges")
    numbered = rank(ranges, [], order, "_range", "_place").select(*messages.columns, (F.col("_place") - 1).alias(out))
    lost = messages.where(F.col(offset).isNull()).withColumn(out, F.lit(None).cast("long"))
    return numbered.unionByName(lost)
