"""Constraint, referential and uniqueness reports (FLT8-FLT10, JN3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import is_uuid
from .joins import lookup_join

APART = "_apart"

# The allowed words of each column.
ACCOUNT_TYPES = ("SAVINGS", "CURRENT")
TIERS = ("STANDARD", "PREMIUM", "ELITE")
ACCOUNT_STATUS = ("ACTIVE", "SUSPENDED", "CLOSED")
TRANSACTION_TYPES = ("DEBIT", "CREDIT")
TRANSACTION_STATUS = ("INITIATED", "COMPLETED", "FAILED")

_MONEY_END = 10 ** 13  # 15 digits, two of them after the point


def _present(*columns: str) -> dict[str, Column]:
    return {f"{c}_missing": F.col(c).isNotNull() for c in columns}


def _at_most(column: str, length: int) -> dict[str, Column]:
    return {f"{column}_length": F.length(column) <= length}


def _money(column: str) -> dict[str, Column]:
    return {f"{column}_range": F.abs(column) < _MONEY_END}


def _one_of(column: str, words) -> dict[str, Column]:
    return {f"{column}_domain": F.col(column).isin(*words)}


def account_rules() -> dict[str, Column]:
    return {
        **_present("account_number", "owner_name", "account_type", "tier",
                   "balance", "status"),
        **_at_most("account_number", 20), **_at_most("owner_name", 255),
        **_one_of("account_type", ACCOUNT_TYPES), **_one_of("tier", TIERS),
        **_one_of("status", ACCOUNT_STATUS), **_money("balance"),
    }


def transaction_rules() -> dict[str, Column]:
    return {
        **_present("account_id", "amount", "currency", "type", "status"),
        **_at_most("currency", 3), **_one_of("type", TRANSACTION_TYPES),
        **_one_of("status", TRANSACTION_STATUS), **_money("amount"),
    }


def outbox_rules() -> dict[str, Column]:
    return {
        **_present("topic", "payload", "published", "retry_count"),
        **_at_most("topic", 255), **_at_most("partition_key", 255),
    }


def processed_event_rules() -> dict[str, Column]:
    return {
        **_present("event_id", "consumer_group"),
        "event_id_uuid": is_uuid(F.col("event_id")),
        **_at_most("consumer_group", 255),
    }


def holds(rules: Mapping[str, Column]) -> Column:
    """Whether a row breaks no rule. As with an SQL check, a condition that is null
    is not broken."""
    met = F.lit(True)
    for condition in rules.values():
        met = met & F.coalesce(condition, F.lit(True))
    return met


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, with the names of all they break, in rule order."""
    broken = F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()])
    return (df.filter(~holds(rules))
            .withColumn("violations", F.array_compact(broken)))


def orphans(df: DataFrame, parent: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not in ``parent``."""
    keys = [on] if isinstance(on, str) else list(on)
    return lookup_join(df, parent.select(*keys), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def apart_without(df: DataFrame, id: str) -> DataFrame:
    """``df`` with a column ``APART`` that is different for each row without an id and
    null for the others, so that a grouping by both never folds rows without one."""
    return df.withColumn(APART, F.when(F.col(id).isNull(),
                                       F.monotonically_increasing_id()))
