"""Named tables of a folder, and the test tables seen as this engine's inputs.

The views below only rename, cast and derive columns; each covers its whole
table. Event times are cut to milliseconds, the precision of the wire format.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wire
from ..session import use_utc

# How the stand-in columns map to the contract's words.
TYPE_OF_EVENT = {"purchase": "DEBIT", "signup": "CREDIT", "click": "DEBIT",
                 "view": "CREDIT"}
TIER_OF_SEGMENT = {"BUILDING": "elite", "MACHINERY": "Premium",
                   "HOUSEHOLD": "gold", "AUTOMOBILE": "STANDARD"}
COPIES_OF_EVENT = {"purchase": 3, "click": 2}


def load_tables(spark: SparkSession, folder: str,
                names: Iterable[str]) -> dict[str, DataFrame]:
    use_utc(spark)
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def jdbc_table(spark: SparkSession, url: str, table: str, *, split_by: str,
               first: str, last: str, tasks: int, **options: str) -> DataFrame:
    """A relational table read by ``tasks`` ranges of ``split_by`` (SRC6). Filters
    and column choices go to the database; its driver must be on the classpath."""
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=split_by,
                     lowerBound=first, upperBound=last, numPartitions=tasks,
                     **options).load())


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_tables(spark, folder, [name])[name]


def _map(column: str, mapping: dict, default: Column) -> Column:
    out = F
    for key, value in mapping.items():
        out = out.when(F.col(column) == key, F.lit(value))
    return out.otherwise(default)


def millis(ts: Column) -> Column:
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def uuid_of(number: Column) -> Column:
    """A number as UUID text."""
    return F.concat(F.lit("00000000-0000-0000-0000-"),
                    F.lpad(number.cast("string"), 12, "0"))


def event_transactions(events: DataFrame) -> DataFrame:
    """``events`` as transactions."""
    return events.select(
        "event_id", F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("value").cast("decimal(15,2)").alias("amount"),
        F.lit("INR").alias("currency"),
        _map("event_type", TYPE_OF_EVENT, F.lit("REFUND")).alias("type"),
        F.col("event_type").alias("description"),
        millis(F.col("ts")).alias("occurred_at"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions(_table(spark, folder, "events"))


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return order_rows(_table(spark, folder, "orders"))


def order_rows(orders: DataFrame) -> DataFrame:
    """``orders`` as transactions of larger amounts."""
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("amount"),
        F.lit("INR").alias("currency"), F.lit("DEBIT").alias("type"),
        F.col("o_orderpriority").alias("description"),
        millis(F.col("o_orderdate")).alias("occurred_at"))


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Both transaction tables as one stream with text ids."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        key = F.concat(F.lit(tag), F.col("event_id").cast("string"))
        return df.withColumns({"event_id": key, "transaction_id": key})

    return (tagged(transactions(spark, folder), "E")
            .unionByName(tagged(order_transactions(spark, folder), "O")))


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers that are not overdrawn, as accounts. The others' transactions
    have no account. Tiers come in mixed case, unknown and null."""
    return (_table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
            .select(F.col("c_custkey").alias("account_id"),
                    F.col("c_name").alias("owner_name"),
                    _map("c_mktsegment", TIER_OF_SEGMENT, F.lit(None))
                    .alias("tier")))


def with_copies(tx: DataFrame) -> DataFrame:
    """Each event as often as it is delivered, with the delivery's offset."""
    copies = _map("description", COPIES_OF_EVENT, F.lit(1))
    return (tx.withColumn("delivery", F.explode(F.sequence(F.lit(1), copies)))
            .withColumn("offset", F.col("event_id") * 3 + F.col("delivery") - 1))


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    return with_copies(transactions(spark, folder))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events processed in an earlier run: those of the first week."""
    return (transactions(spark, folder)
            .filter(F.col("occurred_at") < F.lit("2024-01-08").cast("timestamp_ntz"))
            .select("event_id"))


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions that arrive up to two hours late: records of three partitions,
    with the event id as offset."""
    delay = F.make_dt_interval(secs=F.pmod(F.col("event_id") * 7919, F.lit(7200)))
    return (transactions(spark, folder)
            .withColumn("occurred_at", F.col("occurred_at") - delay)
            .withColumn("offset", F.col("event_id"))
            .withColumn("partition", F.pmod(F.col("account_id"), F.lit(3))))


def outbox(spark: SparkSession, folder: str) -> DataFrame:
    """Events as outbox rows: purchases are published, errors do not decode."""
    published = F.col("description") == "purchase"
    broken = F.col("description") == "error"
    payload = wire.quote_base64(F.col("description").cast("binary"))
    return transactions(spark, folder).select(
        uuid_of(F.col("event_id")).alias("id"),
        F.lit("transaction.initiated").alias("topic"),
        F.col("account_id").cast("string").alias("partition_key"),
        F.when(broken, F.lit('"*"')).otherwise(payload).alias("payload"),
        published.alias("published"),
        F.when(published, F.col("occurred_at") + F.expr("interval 1 second"))
        .alias("published_at"),
        F.when(broken, F.floor(F.col("amount") / 50)).otherwise(F.lit(0))
        .cast("int").alias("retry_count"),
        F.lit(None).cast("string").alias("last_error"),
        F.col("occurred_at").alias("created_at"))
