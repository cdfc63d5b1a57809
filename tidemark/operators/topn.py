"""Top-N per window: ``row_number`` over the window end, ordered by count then by id.

Spark plans ``row_number() <= n`` with a WindowGroupLimit on both sides of the shuffle, so each task
keeps at most n rows per window before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, partition_by: Sequence[str] = ("window_end",),
          order_by: Sequence[Column] | None = None, id_col: str | None = None, count_col: str = "cnt",
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per partition; default order: ``count_col`` descending, then ``id_col``."""
    if order_by is None:
        order_by = [F.col(count_col).desc()] + ([F.col(id_col).asc()] if id_col else [])
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).filter(F.col(rank_col) <= n)
