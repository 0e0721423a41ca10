"""The three rules on a stream (OP1-OP4, OP12, OP13)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.durations import micros
from ..functions.tiers import TIER_LIMITS, lowest_limit
from ..operators import rules, velocity
from ..operators.joins import lookup_join
from ..operators.lateness import GRACE
from ..sources import streams
from . import runner


def start_high_value(tx: DataFrame, accounts: Callable[[SparkSession], DataFrame],
                     sink: runner.Handler, checkpoint: str,
                     limits: Mapping = TIER_LIMITS, work: str | None = None,
                     since: str | None = None, at: str | None = None,
                     every: str | None = runner.ONE_SECOND) -> StreamingQuery:
    """``accounts`` is called per micro-batch, so each sees the accounts as they
    are then. With ``since`` it gives their versions (``accounts.account_versions``) and a
    transaction meets the one current at ``at``: a replayed micro-batch raises the same
    alerts after accounts have changed. With an account table too large to broadcast a micro-batch is read
    several times; ``work`` names a folder to stage its large amounts in first."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        large = batch.filter(F.col("amount") > lowest_limit(limits))
        if work is not None:
            large = runner.staged(large, work, batch_id)
        known = accounts(batch.sparkSession)
        if since is not None:  # history of the accounts of this micro-batch only
            known = lookup_join(known, large, "account_id", "left_semi")
        sink(rules.high_value_alerts(large, known, limits, since=since, at=at), batch_id)

    return runner.run_stream(tx, handle, checkpoint, every=every)


def spend_stream(tx: DataFrame, window: str = rules.SPEND_WINDOW,
                 grace: str = GRACE, dedupe: bool = False,
                 ts: str = "occurred_at") -> DataFrame:
    """Running spend per account and tumbling window.

    Spark closes a window by the watermark of the previous micro-batch, so it
    accepts late records a little longer than a per-record check would;
    ``lateness.late_audit`` is the exact form.
    """
    marked = (streams.distinct_events(tx, grace, ts=ts) if dedupe
              else tx.withWatermark(ts, grace))
    return rules.tumbling_spend(marked, window, ts=ts)


def start_rapid_large(tx: DataFrame, sink: runner.Handler, checkpoint: str,
                      window: str = rules.SPEND_WINDOW, limit=rules.SPEND_LIMIT,
                      grace: str = GRACE, mode: str = "update",
                      dedupe: bool = False,
                      every: str | None = runner.ONE_SECOND) -> StreamingQuery:
    """``update`` emits every change of a window over the limit, ``append`` only
    its final value. With ``dedupe`` the mode is ``append``."""
    def handle(spend: DataFrame, batch_id: int) -> None:
        sink(rules.rapid_large_rows(spend, limit), batch_id)

    return runner.run_stream(
        spend_stream(tx, window, grace, dedupe), handle, checkpoint,
        mode="append" if dedupe else mode, every=every)


def start_velocity(tx: DataFrame, sink: runner.Handler, checkpoint: str,
                   state: str, window: str = velocity.WINDOW,
                   min_count: int = velocity.MIN_COUNT, grace: str = GRACE,
                   key: str = "account_id", ts: str = "occurred_at",
                   slice_len: str = velocity.SLICE,
                   every: str | None = runner.ONE_SECOND) -> StreamingQuery:
    """Sliding-window counts; every window a micro-batch changed is emitted.

    The state is a table of event counts per account and time. Each micro-batch
    writes its next version under ``state``: the counts open windows still reach,
    and its own. Window counts come from the batch operator, so a hot account is
    cut by time here as well.

    A window that ended ``grace`` or more before the stream time of the earlier
    micro-batches is closed: it neither counts late events nor is emitted again.
    """
    length = micros(window)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = velocity.points(batch, key, ts).withColumn("added", F.col("c"))
        before = [v for v in runner.versions(spark, state) if v < batch_id]
        closed = None
        if before:
            known = runner.read_batch(spark, state, before[-1])
            latest = known.agg(F.max("t")).first()[0]
            closed = None if latest is None else latest - micros(grace)
        if closed is not None:
            kept = (known.filter(F.col("t") + length > closed)
                    .withColumn("added", F.lit(0).cast("bigint")))
            new = (new.filter(F.col("t") + length > closed).unionByName(kept)
                   .groupBy(key, "t").agg(F.sum("c").alias("c"),
                                          F.sum("added").alias("added")))
        weights = runner.staged(new, state, batch_id)

        sums = velocity.window_sums(weights, window, key, ["c", "added"], slice_len)
        hits = sums.filter((F.col("added") > 0) & (F.col("c") >= min_count))
        if closed is not None:
            hits = hits.filter(F.col("t") > closed)
        windows = hits.select(
            key, F.timestamp_micros(F.col("t") - length).alias("window_start"),
            F.timestamp_micros("t").alias("window_end"), F.col("c").alias("n"))
        sink(rules.velocity_rows(windows, window), batch_id)

    return runner.run_stream(tx, handle, checkpoint, every=every)
