"""Time helpers: durations, epoch conversions and the text form of a timestamp."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "millisecond": 1, "milliseconds": 1, "ms": 1,
    "second": 1000, "seconds": 1000, "s": 1000,
    "minute": 60_000, "minutes": 60_000, "min": 60_000,
    "hour": 3_600_000, "hours": 3_600_000, "h": 3_600_000,
    "day": 86_400_000, "days": 86_400_000, "d": 86_400_000,
}


def duration_ms(text: str | int) -> int:
    """'1 hour', '5 minutes', '200 milliseconds' (or an int of ms) -> milliseconds."""
    if isinstance(text, int):
        return text
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", text)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"bad duration: {text!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def ts_string(ms: str | Column) -> Column:
    """Epoch ms -> 'yyyy-MM-dd HH:mm:ss.f' as a SQL timestamp prints: the fraction without trailing zeros,
    at least one digit ('... 10:00:00.0', '... 09:59:59.999'). Session time zone (UTC)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    base = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")
    frac = F.pmod(ms, F.lit(1000))
    digits = F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", "")
    return F.concat(base, F.lit("."), F.when(frac == 0, F.lit("0")).otherwise(digits))


def end_string(ms: str | Column = "window_end") -> Column:
    """Text form of a window end (epoch ms)."""
    return ts_string(ms)
