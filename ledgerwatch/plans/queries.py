"""One query per operator, bound to the test tables.

Limits and windows differ from the defaults where the test data would otherwise
never reach them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts, wire
from ..operators import (asof, consume, lateness, metrics, quality, reference, rules,
                         velocity)
from ..operators import outbox as ob
from ..sources import codecs, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VELOCITY_WINDOW = "6 hours"
SPEND_LIMIT = 200


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def uuid_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.deliveries(spark, folder)
    return raw.withColumn("event_id", tables.uuid_of(F.col("event_id")))


def uuid_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ledger(spark, folder).select(
        tables.uuid_of(F.col("event_id")).alias("event_id"))


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return consume.classify(
        uuid_deliveries(spark, folder), uuid_ledger(spark, folder),
        texts.simulated_failure(F.col("amount")))


# Risk rules

@query
def high_value_alerts(spark, folder):
    return rules.high_value_alerts(tables.order_transactions(spark, folder),
                                   tables.accounts(spark, folder))


@query
def high_value_elite(spark, folder):
    limits = {"STANDARD": 500000, "PREMIUM": 500000, "ELITE": 450000}
    return rules.high_value_alerts(tables.order_transactions(spark, folder),
                                   tables.accounts(spark, folder), limits)


@query
def rapid_large_alerts(spark, folder):
    return rules.rapid_large_alerts(tables.transactions(spark, folder),
                                    limit=SPEND_LIMIT)


@query
def velocity_alerts(spark, folder):
    return rules.velocity_alerts(tables.transactions(spark, folder),
                                 VELOCITY_WINDOW)


@query
def velocity_all_windows(spark, folder):
    return (velocity.sliding_windows(tables.transactions(spark, folder),
                                     VELOCITY_WINDOW, all_windows=True)
            .filter(F.col("n") >= 3))


@query
def trailing_counts(spark, folder):
    return (velocity.trailing_counts(tables.transactions(spark, folder),
                                     VELOCITY_WINDOW)
            .select("event_id", "account_id", "occurred_at", "n"))


@query
def fraud_alerts(spark, folder):
    return rules.fraud_alerts(tables.payments(spark, folder),
                              tables.accounts(spark, folder),
                              velocity_window=VELOCITY_WINDOW)


@query
def fraud_alerts_on_copies(spark, folder):
    return rules.fraud_alerts(tables.deliveries(spark, folder),
                              tables.accounts(spark, folder), dedupe=False,
                              spend_limit=SPEND_LIMIT)


@query
def fraud_alerts_on_events(spark, folder):
    return rules.fraud_alerts(tables.deliveries(spark, folder),
                              tables.accounts(spark, folder),
                              spend_limit=SPEND_LIMIT)


@query
def fraud_alerts_null_ids(spark, folder):
    """Deliveries whose ids are missing for one kind of event: none of them is folded."""
    known = F.when(F.col("description") != "click", F.col("event_id"))
    return rules.fraud_alerts(
        tables.deliveries(spark, folder).withColumn("event_id", known),
        tables.accounts(spark, folder), spend_limit=SPEND_LIMIT)


@query
def hourly_spend(spark, folder):
    return as_double(rules.tumbling_spend(tables.transactions(spark, folder)),
                     "total")


@query
def rapid_large_updates(spark, folder):
    """One alert per event that finds its window over the limit."""
    updates = rules.spend_updates(tables.deliveries(spark, folder))
    return rules.rapid_large_rows(updates, SPEND_LIMIT)


@query
def enriched_transactions(spark, folder):
    return as_double(
        rules.enrich(tables.transactions(spark, folder),
                     tables.accounts(spark, folder))
        .select("event_id", "account_id", "amount", "occurred_at", "owner_name",
                "tier"), "amount")


@query
def enriched_as_of(spark, folder):
    """Purchases and clicks with what their account last did before; errors end it."""
    events = tables.transactions(spark, folder)
    paid = F.col("description").isin("purchase", "click")
    versions = events.filter(~paid).select(
        "account_id", F.col("occurred_at").alias("since"),
        F.col("event_id").alias("version"), F.col("description").alias("status"))
    return as_double(asof.current_versions(
        events.filter(paid).select("event_id", "account_id", "amount", "occurred_at"),
        versions, order_by=["version"], deleted=F.col("status") == "error"), "amount")


@query
def alert_rows_json(spark, folder):
    return rules.alert_rows(high_value_alerts(spark, folder))


# Reference table and data quality

@query
def latest_account_state(spark, folder):
    orders = tables.load_tables(spark, folder, ["orders"])["orders"]
    return (reference.latest_per_key(
        orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"),
        "o_custkey", ["o_orderdate", "o_orderkey"],
        tombstone=F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("account_id"),
                F.col("o_orderkey").alias("version"),
                F.col("o_orderstatus").alias("status")))


@query
def constraint_violations(spark, folder):
    rows = tables.transactions(spark, folder).withColumn(
        "status", F.when(F.col("description") == "view", F.lit("PENDING"))
        .otherwise(F.lit("INITIATED")))
    found = quality.violations(rows, quality.transaction_rules())
    return found.select("event_id", F.concat_ws(",", "violations").alias("violations"))


@query
def orphan_transactions(spark, folder):
    return quality.orphans(
        tables.transactions(spark, folder), tables.accounts(spark, folder),
        "account_id").select("event_id", "account_id")


@query
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(tables.deliveries(spark, folder), "event_id")


# Consumer

@query
def dedupe_first_delivery(spark, folder):
    return (consume.first_delivery(tables.deliveries(spark, folder))
            .select("event_id", "offset", "account_id", "description"))


@query
def new_vs_processed(spark, folder):
    raw, done = tables.deliveries(spark, folder), tables.ledger(spark, folder)
    new = consume.new_events(raw, done).withColumn("state", F.lit("new"))
    old = consume.processed_events(raw, done).withColumn("state", F.lit("processed"))
    return new.unionByName(old).select("event_id", "offset", "state")


@query
def consume_outcomes(spark, folder):
    return outcomes(spark, folder).select(
        "event_id", "offset", "status", "attempts", "backoff_ms", "reason")


@query
def dead_letters(spark, folder):
    return consume.dead_letters(outcomes(spark, folder).select(
        "event_id", "account_id", "offset", "status", "attempts", "backoff_ms",
        "reason"))


@query
def notification_lines(spark, folder):
    return consume.notification_lines(outcomes(spark, folder))


@query
def ledger_additions(spark, folder):
    return (consume.ledger_rows(outcomes(spark, folder))
            .select("event_id", "consumer_group"))


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of failing amounts as failed attempts."""
    return (tables.deliveries(spark, folder)
            .filter(texts.simulated_failure(F.col("amount")).isNotNull())
            .select("event_id", F.col("delivery").alias("attempt"),
                    F.col("occurred_at").alias("last_attempt_at"), "description"))


@query
def retry_schedule(spark, folder):
    return consume.retry_due(attempts(spark, folder).drop("description"),
                             moment("2024-01-20"))


@query
def retry_step(spark, folder):
    """One pass in which the handler still fails for purchases."""
    failure = F.when(F.col("description") == "purchase", F.lit("down"))
    return consume.retry_step(attempts(spark, folder), moment("2024-01-20"), failure)


@query
def frame_triage(spark, folder):
    rows = tables.transactions(spark, folder)
    body = F.col("description").cast("binary")
    version = F.when(F.col("type") == "DEBIT", 1).otherwise(2)
    value = (F.when(F.col("description") == "error", F.encode(F.lit('{"a":1}'), "UTF-8"))
             .when(F.col("description") == "signup", body.substr(1, 3))
             .otherwise(wire.frame(body, version)))
    frames = consume.split_frames(rows.select(value.alias("value")))
    return consume.frame_counts(frames)


@query
def frame_bodies(spark, folder):
    rows = tables.transactions(spark, folder)
    value = wire.frame(F.col("description").cast("binary"), F.col("account_id"))
    frames = consume.split_frames(rows.select("event_id", value.alias("value")))
    return frames.select("event_id", "schema_id",
                         F.col("body").cast("string").alias("body"))


@query
def schema_v1_v2_union(spark, folder):
    rows = tables.transactions(spark, folder)
    old = rows.filter(F.col("type") == "DEBIT").select("event_id", "description")
    new = (rows.filter(F.col("type") != "DEBIT")
           .select("event_id", "description",
                   F.concat(F.lit("M"), F.col("account_id").cast("string"))
                   .alias("merchant_id")))
    return codecs.with_all_fields(old, new)


@query
def requests_from_json(spark, folder):
    events = tables.load_tables(spark, folder, ["events"])["events"]
    parsed = codecs.decode_json(events.select("event_id", "props"), "k INT", "props")
    return parsed.select("event_id", "k")


@query
def json_roundtrip(spark, folder):
    rows = tables.transactions(spark, folder).select(
        "event_id", F.col("amount").cast("double").alias("amount"), "description")
    encoded = codecs.encode_events(rows, "json")
    return (codecs.decode_events(
        encoded, "json", "event_id BIGINT, amount DOUBLE, description STRING")
        .select("event_id", "amount", "description"))


@query
def payload_roundtrip(spark, folder):
    payload = wire.quote_base64(F.col("description").cast("binary"))
    return (tables.transactions(spark, folder)
            .select("event_id", payload.alias("payload"))
            .withColumn("text", wire.unquote_base64(F.col("payload")).cast("string")))


# Write path and outbox

def requests(spark: SparkSession, folder: str) -> DataFrame:
    return tables.transactions(spark, folder).select(
        "event_id", "account_id", "amount", "type", "description",
        F.col("occurred_at").alias("created_at"))


def accepted(spark: SparkSession, folder: str) -> ob.Accepted:
    return ob.accept(requests(spark, folder), tables.accounts(spark, folder),
                     "event_id", now=F.col("created_at"))


@query
def accept_transactions(spark, folder):
    return as_double(accepted(spark, folder).transactions, "amount")


@query
def accept_outbox(spark, folder):
    return accepted(spark, folder).outbox.select(
        "id", "topic", "partition_key", "payload", "published", "retry_count")


@query
def rejected_requests(spark, folder):
    return accepted(spark, folder).rejected.select(
        "event_id", F.concat_ws(",", "violations").alias("violations"))


@query
def outbox_pending(spark, folder):
    return ob.outbox_pending(tables.outbox(spark, folder)).select(
        "id", "payload", "created_at")


@query
def outbox_apply(spark, folder):
    box = tables.outbox(spark, folder)
    results = ob.publish_results(ob.publishable(ob.outbox_pending(box)))
    return ob.outbox_apply(box, results, moment("2024-02-01")).select(
        "id", "published", "published_at", "retry_count", "last_error",
        "needs_manual")


@query
def outbox_recent(spark, folder):
    return ob.recent(tables.outbox(spark, folder)).select("id", "created_at")


@query
def outbox_retention(spark, folder):
    return ob.outbox_retain(tables.outbox(spark, folder),
                            moment("2024-01-30")).select("id", "published_at")


# Lateness

@query
def late_drops(spark, folder):
    return lateness.late_audit(tables.arrivals(spark, folder)).select(
        "event_id", "partition", "stream_time", "window_end", "dropped")


@query
def hourly_spend_on_time(spark, folder):
    kept = lateness.on_time(tables.arrivals(spark, folder))
    return as_double(rules.tumbling_spend(kept), "total")


# Metrics

@query
def delivery_audit(spark, folder):
    return metrics.copies_histogram(tables.deliveries(spark, folder))


@query
def velocity_inflated(spark, folder):
    """Alerting windows per account on all copies and on distinct events."""
    raw = tables.deliveries(spark, folder)

    def per_account(df: DataFrame, name: str) -> DataFrame:
        return (velocity.sliding_windows(df).filter(F.col("n") >= 3)
                .groupBy("account_id").agg(F.count(F.lit(1)).alias(name)))

    on_copies = per_account(raw, "on_copies")
    on_events = per_account(rules.distinct_events(raw), "on_events")
    return (on_copies.join(on_events, "account_id", "left")
            .select("account_id", "on_copies",
                    F.coalesce("on_events", F.lit(0)).alias("on_events")))


@query
def event_counters(spark, folder):
    return metrics.counters(tables.transactions(spark, folder), ["description", "type"])


@query
def consumer_counters(spark, folder):
    return metrics.consumer_counters(outcomes(spark, folder))


@query
def write_counters(spark, folder):
    """Accepted requests, and results of publishing the whole backlog."""
    backlog = ob.outbox_pending(tables.outbox(spark, folder), None)
    return (metrics.accept_counters(accepted(spark, folder).transactions)
            .unionByName(metrics.outbox_counters(
                ob.publish_results(ob.publishable(backlog)))))


@query
def rate_per_minute(spark, folder):
    return metrics.rate_per_second(tables.transactions(spark, folder),
                                   "occurred_at", ["description"])


@query
def counter_rate(spark, folder):
    """Amounts read as samples of one counter per type, with many resets."""
    return metrics.rate_per_second(tables.transactions(spark, folder),
                                   "occurred_at", ["description"],
                                   window="1 hour", value="amount")


def _by_day(spark: SparkSession, folder: str) -> DataFrame:
    return tables.transactions(spark, folder).select(
        F.date_trunc("day", "occurred_at").cast("timestamp_ntz").alias("day"),
        "description", "amount")


@query
def duration_quantiles(spark, folder):
    out = metrics.quantiles(_by_day(spark, folder), "amount", ["day"])
    return out.select("day", *[F.round(c, 4).alias(c) for c in ("p50", "p95", "p99")])


@query
def duration_quantiles_by_type(spark, folder):
    out = metrics.quantiles(_by_day(spark, folder), "amount", ["description"])
    return out.select("description",
                      *[F.round(c, 4).alias(c) for c in ("p50", "p95", "p99")])


@query
def histogram_quantiles(spark, folder):
    rows = tables.transactions(spark, folder)
    edge = F.ceil(F.col("amount") / 50) * 50
    edges = F.when(edge > 300, F.lit(float("inf"))).otherwise(edge.cast("double"))
    buckets = metrics.histogram(rows, "amount", edges, ["description"])
    return (metrics.histogram_quantile(buckets, by=["description"])
            .withColumn("value", F.round("value", 6)))


def _lags(spark: SparkSession, folder: str) -> DataFrame:
    records = tables.arrivals(spark, folder)
    committed = (records.filter(F.col("occurred_at") < moment("2024-01-28"))
                 .groupBy("partition").agg((F.max("offset") + 1).alias("offset")))
    return metrics.lag(records.select("partition", "offset"), committed)


@query
def consumer_lag(spark, folder):
    return _lags(spark, folder)


@query
def total_lag(spark, folder):
    return metrics.total_lag(_lags(spark, folder))


@query
def health_status(spark, folder):
    counts = metrics.consumer_counters(outcomes(spark, folder)).select(
        "name", F.col("total").alias("value"))
    behind = metrics.total_lag(_lags(spark, folder)).select(
        F.lit("lag").alias("name"), F.col("lag").alias("value"))
    failed = (tables.outbox(spark, folder).agg(F.sum("retry_count").alias("value"))
              .select(F.lit("outbox_failed").alias("name"), "value"))
    return metrics.health(counts.unionByName(behind).unionByName(failed))
