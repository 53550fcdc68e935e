"""Calendar columns of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CYCLES = (("hour", "hour_of_day", 24), ("day", "day_of_week", 7), ("month", "month_of_year", 12))
CALENDAR_COLUMNS = (
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "month_of_year",
    "quarter",
    "is_weekend",
    *(f"{name}_{part}" for name, _, _ in CYCLES for part in ("sin", "cos")),
)


def calendar_parts(ts: str) -> dict[str, Column]:
    """Integer calendar parts; Monday is day 0."""
    t = F.col(ts)
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": F.weekday(t),
        "day_of_month": F.dayofmonth(t),
        "month_of_year": F.month(t),
        "quarter": F.quarter(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
    }


def cyclical(part: Column, length: int) -> tuple[Column, Column]:
    """Sine and cosine of a part's place on its cycle."""
    angle = part * F.lit(2 * math.pi / length)
    return F.sin(angle), F.cos(angle)


def calendar_columns(ts: str) -> dict[str, Column]:
    parts = calendar_parts(ts)
    out = dict(parts)
    for name, part, length in CYCLES:
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclical(parts[part], length)
    return out


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(calendar_columns(ts))


def to_text(ts: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """Timestamp as it travels in messages."""
    return F.date_format(ts, pattern)


def from_text(text: Column | str) -> Column:
    """ISO or space-separated timestamp text; unreadable text becomes NULL."""
    return F.try_to_timestamp(text)
