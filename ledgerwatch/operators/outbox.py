"""Accepting requests and relaying their outbox rows (OP8-OP10, OP16)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.durations import epoch_millis, micros
from ..functions.ids import stable_uuid
from . import quality
from .joins import lookup_join

# Write defaults, topic, relay batch and retry mark.
DEFAULT_STATUS = "INITIATED"
DEFAULT_CURRENCY = "INR"
TOPIC = "transaction.initiated"
BATCH = 100
MAX_RETRY = 5
KEEP = "7 days"
KNOWN = "_known"
BAD_PAYLOAD = "payload is not base64"


class Accepted(NamedTuple):
    transactions: DataFrame
    outbox: DataFrame
    rejected: DataFrame


def with_defaults(tx: DataFrame, now: Column) -> DataFrame:
    """Status, currency and times of a new transaction (PRJ2)."""
    given = set(tx.columns)

    def or_default(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value) if name in given else value

    return (tx.withColumn("status", or_default("status", F.lit(DEFAULT_STATUS)))
            .withColumn("currency", or_default("currency", F.lit(DEFAULT_CURRENCY)))
            .withColumn("created_at", or_default("created_at", now))
            .withColumn("updated_at", or_default("updated_at", now)))


def touch(df: DataFrame, changed: Column, now: Column) -> DataFrame:
    """Set ``updated_at`` on changed rows (PRJ3)."""
    return df.withColumn("updated_at",
                         F.when(changed, now).otherwise(F.col("updated_at")))


def event_rows(transactions: DataFrame) -> DataFrame:
    """Entity rows as wire events (PRJ1). The event id follows from the
    transaction id, so every copy of the event carries the same one."""
    return transactions.select(
        stable_uuid(F.lit("event"), F.col("id")).alias("eventId"),
        F.col("id").cast("string").alias("transactionId"),
        F.col("account_id").cast("string").alias("accountId"),
        F.col("amount").cast("double").alias("amount"), "currency", "type",
        "description", epoch_millis(F.col("created_at")).alias("occurredAt"),
        F.lit(None).cast("string").alias("merchantId"))


def outbox_rows(transactions: DataFrame, body: Column | None = None,
                schema_id: int = 1) -> DataFrame:
    """One pending outbox row per transaction (PRJ13).

    ``body`` encodes the event columns of ``event_rows`` as binary; JSON unless
    another codec is given.
    """
    events = event_rows(transactions)
    if body is None:
        body = F.to_json(F.struct(*events.columns)).cast("binary")
    # The event id is a function of the transaction id; both come from one row.
    made = events.withColumn("_frame", wire.frame(body, F.lit(schema_id)))
    return made.select(
        stable_uuid(F.lit("outbox"), F.col("transactionId")).alias("id"),
        F.lit(TOPIC).alias("topic"), F.col("accountId").alias("partition_key"),
        wire.quote_base64(F.col("_frame")).alias("payload"),
        F.lit(False).alias("published"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("last_error"),
        F.timestamp_millis("occurredAt").alias("created_at"))


def with_known_account(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """``requests`` with ``KNOWN``: whether their account exists. Accounts may repeat."""
    known = accounts.select("account_id").distinct().withColumn(KNOWN, F.lit(True))
    return (lookup_join(requests, known, "account_id", "left")
            .withColumn(KNOWN, F.coalesce(KNOWN, F.lit(False))))


def accept(requests: DataFrame, accounts: DataFrame | None,
           request_key: str | list[str], now: Column | None = None,
           body: Column | None = None, schema_id: int = 1) -> Accepted:
    """Split requests into transactions with outbox rows, and rejects (OP16).

    ``request_key`` identifies a request (its id, or source partition and
    offset). Transaction, event and outbox ids are hashes of it, so writing the
    two tables again after a failure repeats the same rows. ``amount`` may be text;
    it is rounded to two places like the column it is stored in. Without ``accounts``,
    requests that passed ``with_known_account`` are judged by what it found.
    """
    keys = [request_key] if isinstance(request_key, str) else list(request_key)
    number = F.round(F.col("amount").cast("string").try_cast("decimal(38,6)"), 2)
    rows = with_defaults(requests.withColumn("amount", number),
                         F.current_timestamp() if now is None else now)
    rules = quality.transaction_rules()
    if accounts is not None:
        rows = with_known_account(rows, accounts)
    if KNOWN in rows.columns:
        rules = {**rules, "account_exists": F.col(KNOWN)}

    good = (rows.filter(quality.holds(rules))
            .withColumn("amount", F.col("amount").cast("decimal(15,2)"))
            .withColumn("id", stable_uuid(*[F.col(k) for k in keys])))
    transactions = good.select(
        "id", "account_id", "amount", "currency", "type", "status", "description",
        "created_at", "updated_at")
    return Accepted(transactions, outbox_rows(transactions, body, schema_id),
                    quality.violations(rows, rules).drop(KNOWN))


def outbox_pending(outbox: DataFrame, limit: int | None = BATCH,
                   first: Sequence[str] = ()) -> DataFrame:
    """Oldest unpublished rows (FLT4, SRT1); ties are ordered by id, and columns named in
    ``first`` go before age. Without a limit the whole backlog is one unsorted batch.
    Spark merges the limit in one task: it is meant for passes of up to some 100,000."""
    pending = outbox.filter(~F.col("published"))
    if limit is None:
        return pending
    return pending.orderBy(*first, "created_at", "id").limit(limit)


def publishable(pending: DataFrame) -> DataFrame:
    """Pending rows with the record to publish: ``topic, key, value`` (FMT5)."""
    return pending.select("id", "topic", F.col("partition_key").alias("key"),
                          wire.unquote_base64(F.col("payload")).alias("value"),
                          "created_at")


def in_order(records: DataFrame) -> DataFrame:
    """Records of a key in one task, in order of creation (OP15): a writer that sends a
    task's rows one after another keeps the order of each account. A key's rows must
    follow each other, so they are not spread; a pass's limit bounds them."""
    return (records.repartition("key")
            .sortWithinPartitions("topic", "key", "created_at", "id"))


def publish_results(records: DataFrame, error: Column | None = None) -> DataFrame:
    """``id, error``: null error for what was published. A payload that does not
    decode fails on its own; ``error`` is a failure of the whole publish."""
    undecoded = F.when(F.col("value").isNull(), F.lit(BAD_PAYLOAD))
    failed = undecoded if error is None else F.coalesce(undecoded, error)
    return records.select("id", failed.alias("error"))


def outbox_apply(outbox: DataFrame, results: DataFrame, now: Column,
                 max_retry: int = MAX_RETRY) -> DataFrame:
    """Outbox after a publish (JN4, OP9): published rows are marked, failed ones
    get one more retry and the error; ``needs_manual`` from ``max_retry`` on.
    Failed rows stay pending however often they failed."""
    tried = results.select("id", "error", F.lit(True).alias("_tried"))
    joined = lookup_join(outbox, tried, "id", "left")
    was_tried = F.coalesce("_tried", F.lit(False))
    ok = was_tried & F.col("error").isNull()
    failed = was_tried & F.col("error").isNotNull()
    kind = dict(outbox.dtypes)["published_at"]
    return (
        joined
        .withColumn("published", F.col("published") | ok)
        .withColumn("published_at",
                    F.when(ok, now.cast(kind)).otherwise(F.col("published_at")))
        .withColumn("retry_count", F.col("retry_count") + F.when(failed, 1).otherwise(0))
        .withColumn("last_error", F.when(failed, F.col("error"))
                    .otherwise(F.col("last_error")))
        .withColumn("needs_manual",
                    ~F.col("published") & (F.col("retry_count") >= max_retry))
        .select(*outbox.columns, "needs_manual"))


def outbox_retain(outbox: DataFrame, now: Column, keep: str = KEEP) -> DataFrame:
    """Outbox without rows published longer than ``keep`` ago (OP10)."""
    limit = now - F.make_dt_interval(secs=F.lit(micros(keep) // 1_000_000))
    old = F.col("published") & (F.col("published_at") < limit)
    return outbox.filter(~F.coalesce(old, F.lit(False)))


def recent(df: DataFrame, ts: str = "created_at", n: int = 10,
           tie: str = "id") -> DataFrame:
    """Newest ``n`` rows (SRT2)."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)
