"""Events per account within a sliding window (AGG1, OP2).

A window is ``[end - length, end]``, both ends included. There is one window per
distinct event time of an account, ending at it; ``all_windows`` adds the one
that starts 1 ms after each event time, when it holds any event.

The count is the difference of two running sums, so the work is linear however
many events share a window. Events of one account and time are counted before
the shuffle, and an account's time line is cut into slices (see ``slices``): a
row near the end of a slice is also sent to the next one, whose windows reach
back to it. A task therefore sorts at most the distinct event times of one slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.durations import as_time_of, epoch_micros, floor_to, micros
from .joins import lookup_join

WINDOW = "5 minutes"
MIN_COUNT = 3
SLICE = "1 hour"

_TICK = 1_000  # events carry millisecond times


def points(tx: DataFrame, key: str = "account_id",
           ts: str = "occurred_at") -> DataFrame:
    """``key, t, c``: events per key and time ``t`` in microseconds."""
    return (tx.select(key, epoch_micros(F.col(ts)).alias("t"))
            .filter(F.col(key).isNotNull() & F.col("t").isNotNull())
            .groupBy(key, "t").agg(F.count(F.lit(1)).alias("c")))


def window_sums(weights: DataFrame, window: str, key: str, measures: list[str],
                slice_len: str = SLICE) -> DataFrame:
    """``key, t`` and each measure summed over ``[t - window, t]``.

    ``weights`` has one row per key and ``t``.
    """
    length = micros(window)
    step = max(micros(slice_len), length)  # a window reaches one slice back at most
    reaches_next = F.col("t") >= F.col("home") + (step - length)
    placed = (
        weights.withColumn("home", floor_to(F.col("t"), step))
        .withColumn("slice", F.explode(F.when(
            reaches_next, F.array(F.col("home"), F.col("home") + step)
        ).otherwise(F.array("home")))))

    timeline = W.partitionBy(key, "slice").orderBy("t")
    seen = timeline.rangeBetween(W.unboundedPreceding, 0)
    gone = timeline.rangeBetween(W.unboundedPreceding, -(length + 1))
    sums = {m: F.sum(m).over(seen) - F.coalesce(F.sum(m).over(gone), F.lit(0))
            for m in measures}
    return (placed.withColumns({f"_{m}": v for m, v in sums.items()})
            .filter(F.col("slice") == F.col("home"))
            .select(key, "t", *[F.col(f"_{m}").alias(m) for m in measures]))


def _window_counts(tx: DataFrame, window: str, key: str, ts: str,
                   all_windows: bool, slice_len: str) -> DataFrame:
    """``key, t, c``: events in ``[t - window, t]``."""
    if all_windows:
        t = epoch_micros(F.col(ts))
        ends = F.array(
            F.struct(t.alias("t"), F.lit(1).alias("c")),
            F.struct((t + micros(window) + _TICK).alias("t"), F.lit(0).alias("c")))
        events = (tx.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
                  .select(key, F.inline(ends)).groupBy(key, "t")
                  .agg(F.sum("c").alias("c")))
    else:
        events = points(tx, key, ts)
    return (window_sums(events, window, key, ["c"], slice_len)
            .filter(F.col("c") > 0))


def sliding_windows(tx: DataFrame, window: str = WINDOW, key: str = "account_id",
                    ts: str = "occurred_at", all_windows: bool = False,
                    slice_len: str = SLICE) -> DataFrame:
    """``key, window_start, window_end, n``."""
    counts = _window_counts(tx, window, key, ts, all_windows, slice_len)
    return counts.select(
        key,
        as_time_of(tx, ts, F.col("t") - micros(window)).alias("window_start"),
        as_time_of(tx, ts, F.col("t")).alias("window_end"),
        F.col("c").alias("n"))


def trailing_counts(tx: DataFrame, window: str = WINDOW, key: str = "account_id",
                    ts: str = "occurred_at", slice_len: str = SLICE) -> DataFrame:
    """Every row with ``n``, the events of its key in the window ending at it."""
    counts = _window_counts(tx, window, key, ts, False, slice_len)
    return (lookup_join(tx.withColumn("t", epoch_micros(F.col(ts))), counts,
                        [key, "t"])
            .select(*tx.columns, F.col("c").alias("n")))
