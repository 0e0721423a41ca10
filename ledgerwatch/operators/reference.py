"""Table view of a changelog and seed accounts (AGG3, SRC3, SRC7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# The three seed accounts (owner names are invented).
SEED_ACCOUNTS = [
    ("a0000001-0000-0000-0000-000000000001", "ACC001", "Owner One", "SAVINGS",
     "PREMIUM", "50000.00", "ACTIVE"),
    ("a0000001-0000-0000-0000-000000000002", "ACC002", "Owner Two", "CURRENT",
     "STANDARD", "10000.00", "ACTIVE"),
    ("a0000001-0000-0000-0000-000000000003", "ACC003", "Owner Three", "SAVINGS",
     "ELITE", "200000.00", "ACTIVE"),
]


def latest_per_key(df: DataFrame, key: str | list[str],
                   order_by: str | list[str],
                   tombstone: Column | None = None) -> DataFrame:
    """Last version of each key; a key whose last version is a tombstone is gone,
    and rows without a key are no versions of anything.

    Versions are folded map-side, so a key with very many of them costs one row
    per task. Rows equal in ``order_by`` are ranked by their other columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in order and c not in keys]
    last = (df.dropna(subset=keys).groupBy(*keys)
            .agg(F.max(F.struct(*order, *rest)).alias("_last"))
            .select(*keys, "_last.*").select(*df.columns))
    return last if tombstone is None else last.filter(~tombstone)


def seed_accounts(spark: SparkSession) -> DataFrame:
    text = spark.createDataFrame(
        SEED_ACCOUNTS, "id STRING, account_number STRING, owner_name STRING, "
                       "account_type STRING, tier STRING, balance STRING, "
                       "status STRING")
    return (text.withColumn("balance", F.col("balance").cast("decimal(15,2)"))
            .withColumn("created_at", F.current_timestamp())
            .to(_schema(schemas.ACCOUNTS)))


def account_events(accounts: DataFrame) -> DataFrame:
    """Account rows as the records of the account changelog."""
    return accounts.select(
        F.col("id").alias("account_id"), "account_number", "owner_name",
        "tier", "status")


def _schema(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)
