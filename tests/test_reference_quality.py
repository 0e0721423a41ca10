from decimal import Decimal

from pyspark.sql import functions as F

from helpers import A1, A2, accounts, rows, tx, uid
from ledgerwatch.operators import quality, reference


def test_latest_version_wins(spark):
    log = spark.createDataFrame(
        [("a", 1, "STANDARD"), ("a", 2, "ELITE"), ("b", 3, "PREMIUM"), ("b", 4, None),
         ("c", 5, "STANDARD"), (None, 6, "ELITE")], "account_id STRING, offset LONG, tier STRING")
    assert rows(reference.latest_per_key(log, "account_id", "offset"),
                "account_id", "tier") == [
        ("a", "ELITE"), ("b", None), ("c", "STANDARD")]
    live = reference.latest_per_key(log, "account_id", "offset",
                                    tombstone=F.col("tier").isNull())
    assert rows(live, "account_id") == [("a",), ("c",)]


def test_seeds(spark):
    seeds = reference.seed_accounts(spark)
    assert rows(seeds, "account_number", "account_type", "tier", "balance",
                "status") == [
        ("ACC001", "SAVINGS", "PREMIUM", Decimal("50000.00"), "ACTIVE"),
        ("ACC002", "CURRENT", "STANDARD", Decimal("10000.00"), "ACTIVE"),
        ("ACC003", "SAVINGS", "ELITE", Decimal("200000.00"), "ACTIVE")]
    assert quality.violations(seeds, quality.account_rules()).count() == 0
    assert reference.account_events(seeds).columns == [
        "account_id", "account_number", "owner_name", "tier", "status"]


def test_transaction_checks(spark):
    data = tx(spark, [(A1, 1, "10:00:00"), (A1, 2, "10:00:00", "REFUND"),
                      (None, 3, "10:00:00")]).withColumn("status", F.lit("INITIATED"))
    found = quality.violations(data, quality.transaction_rules())
    assert rows(found, "event_id", "violations") == [
        (uid(1), ["type_domain"]), (uid(2), ["account_id_missing"])]


def test_account_checks(spark):
    seeds = reference.seed_accounts(spark)
    bad = (seeds.withColumn("tier", F.lit("GOLD"))
           .withColumn("account_number", F.repeat(F.lit("9"), F.lit(21)))
           .withColumn("owner_name", F.lit(None).cast("string")))
    assert quality.violations(bad, quality.account_rules()).first().violations == [
        "owner_name_missing", "account_number_length", "tier_domain"]


def test_ledger_and_outbox_checks(spark):
    done = spark.createDataFrame([("x", "g"), (uid(1), None)],
                                 "event_id STRING, consumer_group STRING")
    found = quality.violations(done, quality.processed_event_rules())
    assert rows(found, "violations") == [(["consumer_group_missing"],),
                                         (["event_id_uuid"],)]
    box = spark.createDataFrame([(None, "k", "p", False, 0)],
                                "topic STRING, partition_key STRING, payload STRING, "
                                "published BOOLEAN, retry_count INT")
    assert quality.violations(box, quality.outbox_rules()).first().violations == [
        "topic_missing"]


def test_orphans_and_duplicates(spark):
    data = tx(spark, [(A1, 1, "10:00:00"), ("nobody", 2, "10:00:00"),
                      (A2, 3, "10:00:00", "DEBIT", uid(0))])
    assert rows(quality.orphans(data, accounts(spark), "account_id"),
                "account_id") == [("nobody",)]
    assert rows(quality.duplicate_keys(data, "event_id"), "event_id", "copies") == [
        (uid(0), 2)]
