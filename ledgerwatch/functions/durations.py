"""Durations and event time as microseconds since the epoch (FN2)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000,
}


def _split(text: str) -> tuple[int, str]:
    match = re.fullmatch(r"\s*(\d+)\s+(\w+?)s?\s*", text)
    if not match or match[2] not in MICROS:
        raise ValueError(f"not a duration: {text!r}")
    return int(match[1]), match[2]


def micros(text: str) -> int:
    """``"5 minutes"`` → 300000000."""
    count, unit = _split(text)
    return count * MICROS[unit]


def label(text: str) -> str:
    """``"5 minutes"`` → ``"5-minute"``."""
    count, unit = _split(text)
    return f"{count}-{unit}"


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def as_time_of(df: DataFrame, ts: str, value: Column) -> Column:
    """Microseconds back to the type of ``df[ts]`` (with or without zone)."""
    out = F.timestamp_micros(value)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        out = out.cast("timestamp_ntz")
    return out


def floor_to(value: Column, step: int) -> Column:
    """Start of the epoch-aligned slice of ``step`` that holds ``value``."""
    return value - F.pmod(value, F.lit(step))
