"""Access-log lines split on single spaces.

Fields used: 0 ip, 1 user, 3 time ``dd/MM/yyyy:HH:mm:ss``, 5 method, 6 url; fields 2 and 4 (the zone offset)
are ignored. Times are read in the session time zone (UTC in this library).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.records import with_arrival

# Fixed value: the time layout of the log lines.
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
# Fields a line must have at least.
N_FIELDS = 7


def parse_access_log(lines: DataFrame, value_col: str = "value", strict: bool = True) -> DataFrame:
    """Turn a DataFrame of text lines into (ip, user_id, timestamp ms, method, url [, seq]).

    ``strict=True`` fails on a line that is too short or has an unparsable time (ANSI ``to_timestamp``);
    ``strict=False`` leaves such lines out, and :func:`rejected_lines` returns exactly those. Works on batch and
    streaming DataFrames alike.
    """
    parts = F.split(F.col(value_col), " ")
    field = parts.getItem if strict else (lambda i: F.get(parts, F.lit(i)))
    keep = [c for c in lines.columns if c == "seq"]
    rows = lines if strict else lines.filter(~_bad(value_col))
    ts = (F.to_timestamp(field(3), LOG_TIME_FORMAT) if strict
          else F.try_to_timestamp(field(3), F.lit(LOG_TIME_FORMAT)))
    return rows.select(field(0).alias("ip"), field(1).alias("user_id"), F.unix_millis(ts).alias("timestamp"),
                       field(5).alias("method"), field(6).alias("url"), *keep)


def _bad(value_col: str):
    parts = F.split(F.col(value_col), " ")
    time = F.try_to_timestamp(F.get(parts, F.lit(3)), F.lit(LOG_TIME_FORMAT))
    return F.col(value_col).isNull() | (F.size(parts) < N_FIELDS) | time.isNull()


def rejected_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines that the lenient reading leaves out, with all their columns."""
    return lines.filter(_bad(value_col))


def read_access_log(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_access_log(with_arrival(spark.read.text(path)), strict=strict)
