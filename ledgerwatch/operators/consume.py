"""Consumer outcomes: sent, duplicate or dead-lettered (OP5-OP7, FMT3, WIN1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import backoff, wire
from ..functions.ids import is_uuid
from ..functions.texts import notification_line
from .joins import lookup_join
from .quality import APART, apart_without

SENT = "SENT"
DUPLICATE = "DUPLICATE"
DLQ = "DLQ"

# Dead-letter reasons.
UNEXPECTED_TYPE = "Unexpected message type"
BAD_EVENT_ID = "bad event id"
GROUP = "notification-service"

#: Copies of one row that a task makes at once.
COPIES = 100_000


def split_frames(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows with ``schema_id``, ``body`` and ``bad_reason`` of their frame."""
    v = F.col(value)
    return (df.withColumn("schema_id", wire.schema_id(v))
            .withColumn("body", wire.body(v))
            .withColumn("bad_reason", wire.bad_frame(v)))


def frame_counts(frames: DataFrame) -> DataFrame:
    """Number of frames per schema id and bad-frame reason."""
    return (frames.groupBy("schema_id", "bad_reason")
            .agg(F.count(F.lit(1)).alias("frames")))


def numbered_copies(df: DataFrame, name: str = "copy") -> DataFrame:
    """Rows with a number from 1 among their exact copies.

    Gives rows of a source without offsets a unique order or key. Copies are counted
    map-side and made again in steps of at most ``COPIES`` rows that are dealt out anew
    in between, so no task makes all copies of a row.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    steps = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES))
    cut = counted.withColumn("_step", F.explode(steps))
    last = F.least(F.col("_n"), (F.col("_step") + 1) * COPIES)
    return (cut.hint("rebalance")
            .select(*df.columns, F.explode(F.sequence(
                F.col("_step") * COPIES + 1, last)).alias(name)))


def first_delivery(df: DataFrame, id: str = "event_id",
                   order_by: str | list[str] = "offset") -> DataFrame:
    """The first copy of each event; copies are folded map-side. Rows without an id
    all stay."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in order and c != id]
    return (apart_without(df, id).groupBy(id, APART)
            .agg(F.min(F.struct(*order, *rest)).alias("_first"))
            .select(id, "_first.*").select(*df.columns))


def new_events(df: DataFrame, ledger: DataFrame, id: str = "event_id") -> DataFrame:
    """Rows whose event is not in the ledger (JN2)."""
    return lookup_join(df, ledger.select(id), id, "left_anti")


def processed_events(df: DataFrame, ledger: DataFrame,
                     id: str = "event_id") -> DataFrame:
    """Rows whose event is in the ledger (JN2)."""
    return lookup_join(df, ledger.select(id), id, "left_semi")


def classify(df: DataFrame, ledger: DataFrame | None, failure: Column, *,
             id: str = "event_id", order_by: str | list[str] = "offset",
             decoded: Column | None = None, check_id: bool = True,
             max_attempts: int = backoff.MAX_ATTEMPTS,
             base_ms: int = backoff.BASE_MS) -> DataFrame:
    """Every delivery with ``status, attempts, backoff_ms, reason``.

    Deliveries are judged as if consumed one by one in ``order_by``. ``failure``
    is the handler's error message, null when it succeeds. Only a success enters
    the ledger, so a copy is a duplicate when the ledger has its event or an
    earlier copy succeeded; copies of a failing event each go to the dead letters.

    What is known of each event, its first success and its ledger entry, is one
    aggregate, combined map-side and looked up per row: no task ever holds all
    copies of an event.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = df.columns
    is_text = dict(df.dtypes)[id] == "string"
    event_key = F.lower(F.col(id)) if is_text else F.col(id)

    usable = F.lit(True) if decoded is None else F.coalesce(decoded, F.lit(False))
    known_id = is_uuid(F.col(id)) if check_id else F.col(id).isNotNull()
    rows = (
        df.withColumn("_bad", F.when(~usable, F.lit(UNEXPECTED_TYPE))
                      .when(~known_id, F.lit(BAD_EVENT_ID)))
        .withColumn("_error", F.when(F.col("_bad").isNull(), failure))
        .withColumn("_key", F.when(F.col("_bad").isNull(), event_key))
        .withColumn("_order", F.struct(*order) if order[1:] else F.col(order[0])))

    succeeds = F.col("_bad").isNull() & F.col("_error").isNull()
    seen = (rows.filter(succeeds)
            .select("_key", "_order", F.lit(False).alias("_in_ledger")))
    if ledger is not None:
        done = F.lower(F.col(id)) if is_text else F.col(id)
        none = F.lit(None).cast(rows.schema["_order"].dataType)
        seen = seen.unionByName(ledger.select(
            done.alias("_key"), none.alias("_order"), F.lit(True).alias("_in_ledger")))
    per_event = seen.groupBy("_key").agg(
        F.min("_order").alias("_first_ok"), F.max("_in_ledger").alias("_in_ledger"))
    judged = lookup_join(rows, per_event, "_key", "left")

    duplicate = F.coalesce(F.col("_in_ledger"), F.lit(False)) | F.coalesce(
        F.col("_order") > F.col("_first_ok"), F.lit(False))
    status = (F.when(F.col("_bad").isNotNull(), F.lit(DLQ))
              .when(duplicate, F.lit(DUPLICATE))
              .when(F.col("_error").isNotNull(), F.lit(DLQ))
              .otherwise(F.lit(SENT)))
    attempts = (F.when(F.col("_bad").isNotNull() | (F.col("status") == DUPLICATE), 0)
                .when(F.col("status") == DLQ, max_attempts).otherwise(1))
    return (
        judged.withColumn("status", status)
        .withColumn("attempts", attempts)
        .withColumn("backoff_ms", backoff.total_ms(F.col("attempts"), base_ms))
        .withColumn("reason", F.when(F.col("status") == DLQ,
                                     F.coalesce("_bad", "_error")))
        .select(*columns, "status", "attempts", "backoff_ms", "reason"))


def notification_lines(classified: DataFrame) -> DataFrame:
    """The line written for each sent notification (PRJ11)."""
    return (classified.filter(F.col("status") == SENT)
            .select("event_id", "account_id", notification_line(
                F.col("account_id"), F.col("currency"), F.col("amount"))
                .alias("line")))


def ledger_rows(classified: DataFrame, group: str = GROUP,
                id: str = "event_id") -> DataFrame:
    """New ``processed_events`` rows (PRJ12)."""
    return (classified.filter(F.col("status") == SENT)
            .select(F.col(id).alias("event_id"),
                    F.lit(group).alias("consumer_group"),
                    F.current_timestamp().alias("processed_at")))


def dead_letters(classified: DataFrame, key: str = "account_id",
                 envelope: tuple[str, ...] = ()) -> DataFrame:
    """Dead letters as ``key, value, reason`` (FMT6, SNK5); the value is the event's
    JSON.

    ``envelope`` names the columns of the record that are no event fields. With ``key``
    and ``value`` among them, a record keeps the key it came with, and one that could
    not be decoded its bytes.
    """
    added = ("status", "attempts", "backoff_ms", "reason", "decoded")
    payload = [c for c in classified.columns if c not in (*added, *envelope)]
    letter, text = F.col(key).cast("string"), F.to_json(F.struct(*payload))
    if "key" in envelope:
        letter = F.coalesce(F.col("key").cast("string"), letter)
    if "value" in envelope:
        unread = F.col("reason") == UNEXPECTED_TYPE
        text = F.when(unread, F.col("value").cast("binary")).otherwise(text.cast("binary"))
    return (classified.filter(F.col("status") == DLQ)
            .select(letter.alias("key"), text.alias("value"), "reason"))


def retry_due(attempts: DataFrame, now: Column,
              max_attempts: int = backoff.MAX_ATTEMPTS,
              base_ms: int = backoff.BASE_MS) -> DataFrame:
    """Failed attempts with ``next_attempt_at`` and ``state`` (OP7).

    ``attempts`` has ``attempt`` (1 = first) and ``last_attempt_at``. Rows out of
    attempts are EXHAUSTED and belong in the dead letters; the others are DUE
    once their back-off has passed, else WAITING.
    """
    left = F.col("attempt") < max_attempts
    wait = F.make_dt_interval(secs=backoff.delay_ms(F.col("attempt"), base_ms)
                              / F.lit(1000).cast("decimal(10,3)"))
    return (
        attempts.withColumn("next_attempt_at",
                            F.when(left, F.col("last_attempt_at") + wait))
        .withColumn("state", F.when(~left, F.lit("EXHAUSTED"))
                    .when(F.col("next_attempt_at") <= now, F.lit("DUE"))
                    .otherwise(F.lit("WAITING"))))


def retry_step(attempts: DataFrame, now: Column, failure: Column,
               max_attempts: int = backoff.MAX_ATTEMPTS,
               base_ms: int = backoff.BASE_MS) -> DataFrame:
    """``attempts`` after running the handler on its due rows (OP7).

    Due rows get one more ``attempt`` at ``now``. ``status`` is SENT or DLQ for
    rows that are finished, RETRY for those that stay in the table.
    """
    due = F.col("state") == "DUE"
    tried = (retry_due(attempts, now, max_attempts, base_ms)
             .withColumn("_error", F.when(due, failure))
             .withColumn("attempt", F.col("attempt") + F.when(due, 1).otherwise(0)))
    kind = dict(attempts.dtypes)["last_attempt_at"]
    status = (F.when(due & F.col("_error").isNull(), F.lit(SENT))
              .when(F.col("attempt") >= max_attempts, F.lit(DLQ))
              .otherwise(F.lit("RETRY")))
    return (tried.withColumn("status", status)
            .withColumn("last_attempt_at", F.when(due, now.cast(kind))
                        .otherwise(F.col("last_attempt_at")))
            .select(*attempts.columns, "status"))
