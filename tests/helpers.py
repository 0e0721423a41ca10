"""Small inputs for tests."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

A1, A2, A3 = (f"a0000001-0000-0000-0000-00000000000{i}" for i in (1, 2, 3))
DAY = datetime(2024, 3, 5)

TX = ("event_id STRING, transaction_id STRING, account_id STRING, "
      "amount DECIMAL(15,2), currency STRING, type STRING, description STRING, "
      "occurred_at TIMESTAMP_NTZ")


def at(text: str) -> datetime:
    """``"10:05:00.001"`` on the test day."""
    h, m, s = text.split(":")
    return DAY + timedelta(hours=int(h), minutes=int(m), seconds=float(s))


def uid(n: int) -> str:
    return f"00000000-0000-0000-0000-{n:012d}"


def tx(spark, rows):
    """Rows are ``(account, amount, time)`` with an optional type and event id."""
    full = []
    for i, row in enumerate(rows):
        account, amount, time = row[:3]
        kind = row[3] if len(row) > 3 else "DEBIT"
        event = row[4] if len(row) > 4 else uid(i)
        when = at(time) if isinstance(time, str) else time
        full.append((event, "t-" + event, account, Decimal(str(amount)), "INR",
                     kind, None, when))
    return spark.createDataFrame(full, TX)


def accounts(spark, tiers=None):
    tiers = tiers or {A1: "PREMIUM", A2: "STANDARD", A3: "ELITE"}
    return spark.createDataFrame(list(tiers.items()), "account_id STRING, tier STRING")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
