"""Exact replay of the late-record rule (WIN2, OP3).

Stream time is the greatest event time seen so far in a partition, in arrival
order. A record is dropped for its window when the window ended ``grace`` or more
before stream time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import as_time_of, epoch_micros, floor_to, micros
from .slices import running

GRACE = "30 seconds"


def stream_time(df: DataFrame, ts: str, arrival: list[str], partition: str,
                slice_len: str | int | None = None) -> DataFrame:
    """Every row with ``stream_time``.

    ``arrival`` names the columns that order a partition's records uniquely. The
    first one, an offset or a timestamp, cuts a partition into slices, because one
    partition is far too much for one task. Prefer the offset where there is one:
    its slices are bounded in rows.
    """
    return running(df, [partition], arrival, F.col(ts), "stream_time",
                   slice_len=slice_len)


def late_audit(df: DataFrame, ts: str = "occurred_at",
               arrival: list[str] | None = None, partition: str = "partition",
               window: str = "1 hour", grace: str = GRACE,
               slice_len: str | int | None = None) -> DataFrame:
    """Every row with ``stream_time``, ``window_end`` and ``dropped``."""
    timed = stream_time(df, ts, arrival or ["offset"], partition, slice_len)
    length = micros(window)
    t = epoch_micros(F.col(ts))
    end = floor_to(t, length) + length
    closes = epoch_micros(F.col("stream_time")) - micros(grace)
    return (timed.withColumn("window_end", as_time_of(df, ts, end))
            .withColumn("dropped", end <= closes))


def on_time(df: DataFrame, **params) -> DataFrame:
    """The rows a windowed rule with this window and grace would accept."""
    audited = late_audit(df, **params)
    return audited.filter(~F.col("dropped")).select(*df.columns)
