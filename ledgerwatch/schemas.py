"""Row layouts of the events, tables and requests."""

from __future__ import annotations

# Field names and order of the wire records.
EVENT_V1 = (
    "eventId STRING, transactionId STRING, accountId STRING, amount DOUBLE, "
    "currency STRING, type STRING, description STRING, occurredAt BIGINT"
)
EVENT_V2 = EVENT_V1 + ", merchantId STRING"

EVENT = (
    "event_id STRING, transaction_id STRING, account_id STRING, "
    "amount DECIMAL(15,2), currency STRING, type STRING, description STRING, "
    "occurred_at TIMESTAMP, merchant_id STRING"
)

ACCOUNT_EVENT = (
    "account_id STRING, account_number STRING, owner_name STRING, "
    "tier STRING, status STRING"
)

ACCOUNT_WIRE = (
    "accountId STRING, accountNumber STRING, ownerName STRING, tier STRING, "
    "status STRING"
)

FRAUD_ALERT = (
    "alert_id STRING, account_id STRING, transaction_id STRING, "
    "alert_type STRING, reason STRING, amount DOUBLE, account_tier STRING, "
    "detected_at BIGINT"
)

ACCOUNTS = (
    "id STRING, account_number STRING, owner_name STRING, account_type STRING, "
    "tier STRING, balance DECIMAL(15,2), status STRING, created_at TIMESTAMP"
)
TRANSACTIONS = (
    "id STRING, account_id STRING, amount DECIMAL(15,2), currency STRING, "
    "type STRING, status STRING, description STRING, created_at TIMESTAMP, "
    "updated_at TIMESTAMP"
)
OUTBOX = (
    "id STRING, topic STRING, partition_key STRING, payload STRING, "
    "published BOOLEAN, published_at TIMESTAMP, retry_count INT, "
    "last_error STRING, created_at TIMESTAMP"
)
PROCESSED_EVENTS = "event_id STRING, consumer_group STRING, processed_at TIMESTAMP"
FRAUD_ALERTS = (
    "id STRING, account_id STRING, alert_type STRING, details STRING, "
    "created_at TIMESTAMP"
)

# The request amount stays text until it is checked, so that a bad number is
# reported instead of lost.
REQUEST = "accountId STRING, amount STRING, type STRING, description STRING"

KAFKA_RECORD = (
    "key STRING, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP"
)


def avro_record(name: str, fields: list[tuple[str, object]]) -> dict:
    """Avro record schema; a field whose type is a union gets a null default."""
    out = []
    for field, kind in fields:
        spec: dict = {"name": field, "type": kind}
        if isinstance(kind, list):
            spec["default"] = None
        out.append(spec)
    return {"type": "record", "name": name, "fields": out}


_OPTIONAL = ["null", "string"]

EVENT_V2_AVRO = avro_record("TransactionInitiatedEvent", [
    ("eventId", "string"), ("transactionId", "string"),
    ("accountId", "string"), ("amount", "double"), ("currency", "string"),
    ("type", "string"), ("description", _OPTIONAL), ("occurredAt", "long"),
    ("merchantId", _OPTIONAL),
])
ACCOUNT_AVRO = avro_record("AccountEvent", [
    ("accountId", "string"), ("accountNumber", "string"),
    ("ownerName", "string"), ("tier", "string"), ("status", "string"),
])
ALERT_AVRO = avro_record("FraudAlertEvent", [
    ("alertId", "string"), ("accountId", "string"),
    ("transactionId", "string"), ("alertType", "string"),
    ("reason", "string"), ("amount", "double"), ("accountTier", "string"),
    ("detectedAt", "long"),
])

# The first version of the event had no merchant.
EVENT_V1_AVRO = {**EVENT_V2_AVRO, "fields": [
    f for f in EVENT_V2_AVRO["fields"] if f["name"] != "merchantId"]}
