"""The three risk rules and their common alert row."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.durations import epoch_micros
from ..functions.ids import alert_id
from ..functions.tiers import TIER_LIMITS, lowest_limit, tier_threshold
from . import asof, velocity
from .joins import lookup_join
from .quality import APART, apart_without
from .slices import running

# Fixed values of the alert contract.
HIGH_VALUE = "HIGH_VALUE"
VELOCITY = "VELOCITY"
RAPID_LARGE = "RAPID_LARGE"
MANY_TRANSACTIONS = "MULTIPLE"
NO_TIER = "UNKNOWN"
SPEND_WINDOW = "1 hour"
SPEND_LIMIT = 100000


def _alert(df: DataFrame, kind: str, *, account: Column, subject: Column,
           transaction: Column, reason: Column, amount: Column, tier: Column,
           event_time: Column) -> DataFrame:
    """One alert per row; the id hashes type, account and subject, so a later
    version of the same alert keeps it."""
    return df.select(
        alert_id(F.lit(kind), account, subject).alias("alert_id"),
        account.alias("account_id"),
        transaction.cast("string").alias("transaction_id"),
        F.lit(kind).alias("alert_type"),
        reason.alias("reason"),
        amount.cast("double").alias("amount"),
        tier.alias("account_tier"),
        event_time.alias("event_time"),
    )


def enrich(tx: DataFrame, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    """Transactions with their account; those without one are left out (JN1).

    ``accounts`` holds one row per account, see ``latest_per_key``.
    """
    return lookup_join(tx, accounts, key)


def high_value_alerts(tx: DataFrame, accounts: DataFrame,
                      limits: Mapping = TIER_LIMITS,
                      ts: str = "occurred_at", since: str | None = None,
                      at: str | None = None) -> DataFrame:
    """Amounts above the limit of the account's tier (FLT1, PRJ6).

    Amounts no tier objects to are dropped at the scan, before the join. With ``since``
    ``accounts`` has all versions of the accounts, and a transaction meets the one that was
    current at ``at`` (its ``ts`` unless named), whatever has changed by now.
    """
    at = at or ts
    large = (tx.select(*dict.fromkeys(("transaction_id", "account_id", "amount", ts, at)))
             .filter(F.col("amount") > lowest_limit(limits)))
    if since is None:
        known = enrich(large, accounts.select("account_id", "tier"))
    else:
        known = asof.current_versions(large, accounts.select("account_id", "tier", since),
                                      at=at, since=since)
    hits = known.filter(F.col("amount") > tier_threshold(F.col("tier"), limits))
    return _alert(
        hits, HIGH_VALUE,
        account=F.col("account_id"), subject=F.col("transaction_id"),
        transaction=F.col("transaction_id"),
        reason=texts.high_value_reason(F.col("amount")),
        amount=F.col("amount"), tier=F.col("tier"), event_time=F.col(ts))


def velocity_alerts(tx: DataFrame, window: str = velocity.WINDOW,
                    min_count: int = velocity.MIN_COUNT,
                    all_windows: bool = False,
                    ts: str = "occurred_at") -> DataFrame:
    """Windows with at least ``min_count`` events (FLT2, PRJ7, PRJ9)."""
    hits = (velocity.sliding_windows(tx, window, ts=ts, all_windows=all_windows)
            .filter(F.col("n") >= min_count))
    return velocity_rows(hits, window)


def velocity_rows(windows: DataFrame, window: str) -> DataFrame:
    return _alert(
        windows, VELOCITY,
        account=F.col("account_id"),
        subject=epoch_micros(F.col("window_start")),
        transaction=F.lit(MANY_TRANSACTIONS),
        reason=texts.velocity_reason(F.col("n"), window),
        amount=F.lit(0.0), tier=F.lit(NO_TIER), event_time=F.col("window_end"))


def tumbling_spend(tx: DataFrame, window: str = SPEND_WINDOW,
                   key: str = "account_id", ts: str = "occurred_at") -> DataFrame:
    """``key, window_start, window_end, total`` per epoch-aligned window (AGG2).

    Sums are decimals, so they do not depend on row order, and are combined
    map-side. Events without a key or time have no window.
    """
    return (tx.filter(F.col(key).isNotNull()).groupBy(F.window(ts, window).alias("w"), key)
            .agg(F.sum(F.col("amount").cast("decimal(15,2)")).alias("total"))
            .select(key, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "total"))


def rapid_large_alerts(tx: DataFrame, window: str = SPEND_WINDOW,
                       limit=SPEND_LIMIT, ts: str = "occurred_at") -> DataFrame:
    """Accounts whose spend in a window exceeds ``limit`` (FLT3, PRJ8, PRJ9)."""
    return rapid_large_rows(tumbling_spend(tx, window, ts=ts), limit)


def rapid_large_rows(spend: DataFrame, limit=SPEND_LIMIT) -> DataFrame:
    hits = spend.filter(F.col("total") > F.lit(Decimal(str(limit))))
    return _alert(
        hits, RAPID_LARGE,
        account=F.col("account_id"),
        subject=epoch_micros(F.col("window_start")),
        transaction=F.lit(MANY_TRANSACTIONS),
        reason=texts.rapid_large_reason(F.col("total")),
        amount=F.col("total"), tier=F.lit(NO_TIER),
        event_time=F.col("window_start"))


def spend_updates(tx: DataFrame, window: str = SPEND_WINDOW,
                  key: str = "account_id", ts: str = "occurred_at",
                  order_by: str | list[str] = "offset",
                  slice_len: str | int | None = None) -> DataFrame:
    """Every event with ``window_start, window_end`` and ``total``, the spend of its
    window up to it in arrival order: each update of the window, not only the last
    (OP4). ``order_by`` must order an account's events uniquely."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    placed = (tx.withColumn("_w", F.window(ts, window))
              .withColumns({"window_start": F.col("_w.start"),
                            "window_end": F.col("_w.end")}).drop("_w"))
    return running(placed, [key, "window_start"], order,
                   F.col("amount").cast("decimal(15,2)"), "total", F.sum, slice_len)


def distinct_events(tx: DataFrame, id: str = "event_id",
                    ts: str = "occurred_at") -> DataFrame:
    """One row per event with the columns the rules read.

    The columns travel as one struct: all rules then read the same exchange,
    which Spark runs once, instead of three differently pruned ones. Copies are
    folded map-side; among differing copies the earliest one is kept. Rows without an
    id are not known to be copies: each stays an event of its own.
    """
    copy = F.struct(ts, "transaction_id", "account_id", "amount")
    return (apart_without(tx, id).groupBy(id, APART).agg(F.min(copy).alias("e"))
            .select(id, "e.*"))


def fraud_alerts(tx: DataFrame, accounts: DataFrame, dedupe: bool = True, *,
                 limits: Mapping = TIER_LIMITS,
                 velocity_window: str = velocity.WINDOW,
                 min_count: int = velocity.MIN_COUNT,
                 spend_window: str = SPEND_WINDOW, spend_limit=SPEND_LIMIT,
                 ts: str = "occurred_at") -> DataFrame:
    """The alerts of all three rules (SET1).

    ``dedupe=False`` counts every delivered copy, as rules on the raw stream do.
    """
    events = distinct_events(tx, ts=ts) if dedupe else tx
    return (
        high_value_alerts(events, accounts, limits, ts)
        .unionByName(velocity_alerts(events, velocity_window, min_count, ts=ts))
        .unionByName(rapid_large_alerts(events, spend_window, spend_limit, ts)))


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Rows of the ``fraud_alerts`` table with a JSON ``details`` column (SNK7)."""
    details = F.to_json(F.struct(
        "transaction_id", "reason", "amount", "account_tier"))
    return alerts.select(
        F.col("alert_id").alias("id"), "account_id", "alert_type",
        details.alias("details"), F.col("event_time").alias("created_at"))


def stamped(alerts: DataFrame) -> DataFrame:
    """Alerts in the layout of the wire record, with detection time (FN2)."""
    return alerts.select(
        "alert_id", F.col("account_id").cast("string").alias("account_id"),
        "transaction_id", "alert_type", "reason", "amount", "account_tier",
        F.unix_millis(F.current_timestamp()).alias("detected_at"))
