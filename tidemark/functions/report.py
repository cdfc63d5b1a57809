"""Text report of a top-N ranking per window, one string per window end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import ts_string

# Report layout of the ranking jobs.
BANNER_TOP = "============================"
BANNER_BOTTOM = "==============================="
END_LABEL = "窗口结束时间："
ITEM_LABELS = (" 商品ID = ", " 热门度 = ")
PAGE_LABELS = (" 页面URL = ", " 浏览量 = ")
NL = "\n"


def topn_report(ranked: DataFrame, id_col: str, labels: tuple[str, str] = ITEM_LABELS,
                window_col: str = "window_end", rank_col: str = "rank", count_col: str = "cnt") -> DataFrame:
    """(window_end, rank, id, cnt) rows, at most N per window -> (window_end, report).

    Each group holds the N ranked rows of one window only, so the collected list is bounded by N.
    """
    line = F.concat(F.lit("NO "), F.col(rank_col).cast("string"), F.lit(":"), F.lit(labels[0]),
                    F.col(id_col).cast("string"), F.lit(labels[1]), F.col(count_col).cast("string"), F.lit(NL))
    lines = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), line.alias("l"))))
    body: Column = F.array_join(F.transform(lines, lambda x: x["l"]), "")
    return ranked.groupBy(window_col).agg(body.alias("_body")).select(
        window_col,
        F.concat(F.lit(BANNER_TOP + NL + END_LABEL), ts_string(F.col(window_col)), F.lit(NL),
                 F.col("_body"), F.lit(BANNER_BOTTOM + NL)).alias("report"),
    )
