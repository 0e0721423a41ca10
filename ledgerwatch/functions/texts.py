"""Rendered texts: alert reasons and notification lines (FN3, FN4, PRJ11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .durations import label

# Message formats.
HIGH_VALUE_REASON = "Amount %.2f exceeds tier threshold"
VELOCITY_REASON = " transactions in {label} window"
RAPID_LARGE_REASON = "Total spend %.2f exceeds limit"
NOTIFICATION_LINE = "Notification sent: Account %s transaction for amount %s %s"
HANDLER_FAILURE = "Simulated notification failure for amount: "


def high_value_reason(amount: Column) -> Column:
    return F.format_string(HIGH_VALUE_REASON, amount.cast("double"))


def velocity_reason(count: Column, window: str) -> Column:
    return F.concat(count.cast("string"),
                    F.lit(VELOCITY_REASON.format(label=label(window))))


def rapid_large_reason(total: Column) -> Column:
    return F.format_string(RAPID_LARGE_REASON, total.cast("double"))


def amount_text(amount: Column) -> Column:
    """An amount as the text of its double value."""
    return amount.cast("double").cast("string")


def notification_line(account: Column, currency: Column, amount: Column) -> Column:
    return F.format_string(NOTIFICATION_LINE, account.cast("string"), currency,
                           amount_text(amount))


def simulated_failure(amount: Column) -> Column:
    """Error message of the notification handler, null when it succeeds (FLT6)."""
    text = amount_text(amount)
    return F.when(text.endswith(".99"), F.concat(F.lit(HANDLER_FAILURE), text))
