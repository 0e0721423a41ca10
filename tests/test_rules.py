from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import A1, A2, A3, accounts, rows, tx
from ledgerwatch.functions.tiers import normalise_tier, tier_threshold
from ledgerwatch.operators import rules


def high_value(spark, data, acc=None):
    return rules.high_value_alerts(tx(spark, data), acc or accounts(spark))


def test_normal_amount_raises_nothing(spark):
    assert rules.fraud_alerts(tx(spark, [(A1, 1500, "10:00:00")]),
                              accounts(spark)).count() == 0


def test_large_amount_raises_high_value_and_rapid_large(spark):
    alerts = rules.fraud_alerts(tx(spark, [(A1, 150000, "10:00:00")]), accounts(spark))
    assert rows(alerts, "alert_type", "transaction_id", "reason", "amount",
                "account_tier") == [
        ("HIGH_VALUE", "t-00000000-0000-0000-0000-000000000000",
         "Amount 150000.00 exceeds tier threshold", 150000.0, "PREMIUM"),
        ("RAPID_LARGE", "MULTIPLE", "Total spend 150000.00 exceeds limit",
         150000.0, "UNKNOWN")]


def test_limits_are_strict(spark):
    data = [(A1, 100000, "10:00:00"), (A2, 50000, "11:00:00"), (A3, 500000, "12:00:00")]
    alerts = rules.fraud_alerts(tx(spark, data), accounts(spark))
    assert rows(alerts, "alert_type", "account_id") == [("RAPID_LARGE", A3)]
    over = [(A1, "100000.01", "10:00:00"), (A2, "50000.01", "11:00:00"),
            (A3, "500000.01", "12:00:00")]
    assert high_value(spark, over).count() == 3


def test_tumbling_windows_split_at_the_hour(spark):
    data = [(A1, 60000, "10:59:59.999"), (A1, 60000, "11:00:00")]
    assert rules.rapid_large_alerts(tx(spark, data)).count() == 0


def test_spend_ignores_type(spark):
    data = [(A1, 60000, "10:10:00", "DEBIT"), (A1, 60000, "10:20:00", "CREDIT")]
    assert rows(rules.rapid_large_alerts(tx(spark, data)), "amount") == [(120000.0,)]


def test_unknown_account(spark):
    alerts = rules.fraud_alerts(tx(spark, [("nobody", 900000, "10:00:00")]),
                                accounts(spark))
    assert rows(alerts, "alert_type", "account_tier") == [("RAPID_LARGE", "UNKNOWN")]


def test_tier_text(spark):
    tiers = {"a": "elite", "b": "Premium", "c": "gold", "d": None, "e": " ELITE "}
    data = [(a, 60000, "10:00:00") for a in tiers]
    alerts = high_value(spark, data, accounts(spark, tiers))
    assert rows(alerts, "account_id", "account_tier") == [
        ("c", "gold"), ("d", None), ("e", " ELITE ")]
    df = accounts(spark, tiers).select(
        "account_id", normalise_tier(F.col("tier")).alias("tier"),
        tier_threshold(F.col("tier")).alias("limit"))
    assert rows(df, "account_id", "tier", "limit") == [
        ("a", "ELITE", Decimal("500000.00")), ("b", "PREMIUM", Decimal("100000.00")),
        ("c", "STANDARD", Decimal("50000.00")), ("d", "STANDARD", Decimal("50000.00")),
        ("e", "STANDARD", Decimal("50000.00"))]


def test_copies_count_only_without_dedupe(spark):
    event = [(A1, 40000, "10:00:00", "DEBIT", "same")] * 3
    once = rules.fraud_alerts(tx(spark, event), accounts(spark))
    thrice = rules.fraud_alerts(tx(spark, event), accounts(spark), dedupe=False)
    assert once.count() == 0
    assert rows(thrice, "alert_type", "reason") == [
        ("RAPID_LARGE", "Total spend 120000.00 exceeds limit"),
        ("VELOCITY", "3 transactions in 5-minute window")]


def test_alert_ids_are_stable_and_distinct(spark):
    data = [(A1, 150000, "10:00:00"), (A1, 150001, "10:01:00"), (A1, 2, "10:02:00")]
    first = rules.fraud_alerts(tx(spark, data), accounts(spark))
    second = rules.fraud_alerts(tx(spark, data).repartition(3), accounts(spark))
    assert rows(first, "alert_id") == rows(second, "alert_id")
    assert first.select("alert_id").distinct().count() == first.count() == 4


def test_input_order_does_not_matter(spark):
    data = [(A1 if i % 3 else A2, 30000 + i, f"10:{i % 60:02d}:00") for i in range(90)]
    one = rules.fraud_alerts(tx(spark, data), accounts(spark))
    other = rules.fraud_alerts(tx(spark, data).orderBy(F.rand(3)), accounts(spark))
    assert rows(one, *one.columns) == rows(other, *one.columns)


def test_high_value_filter_reaches_the_scan(spark, tmp_path, capsys):
    tx(spark, [(A1, 150000, "10:00:00")]).write.parquet(str(tmp_path / "tx"))
    alerts = rules.high_value_alerts(spark.read.parquet(str(tmp_path / "tx")),
                                     accounts(spark))
    alerts.explain()
    plan = capsys.readouterr().out
    assert "GreaterThan(amount,50000.00)" in plan
    assert "description" not in plan.split("ReadSchema")[1]


def test_alert_layouts(spark):
    alerts = high_value(spark, [(A1, 150000, "10:00:00")])
    table = rules.alert_rows(alerts).first()
    assert table.details == (
        '{"transaction_id":"t-00000000-0000-0000-0000-000000000000",'
        '"reason":"Amount 150000.00 exceeds tier threshold","amount":150000.0,'
        '"account_tier":"PREMIUM"}')
    wire = rules.stamped(alerts)
    assert wire.columns == ["alert_id", "account_id", "transaction_id", "alert_type",
                            "reason", "amount", "account_tier", "detected_at"]
    assert wire.first().detected_at > 1_700_000_000_000


@pytest.mark.parametrize("limit,fires", [(100, False), ("99.99", True)])
def test_custom_spend_limit(spark, limit, fires):
    alerts = rules.rapid_large_alerts(tx(spark, [(A1, 100, "10:00:00")]), limit=limit)
    assert (alerts.count() == 1) is fires


@pytest.mark.parametrize("slice_len", [1, 3, None])
def test_every_update_over_the_limit(spark, slice_len):
    """Three copies of one event: the second and third update each raise an alert."""
    data = tx(spark, [(A1, 60000, "10:00:00"), (A1, 60000, "10:00:00"),
                      (A2, 1, "10:00:00"), (A1, 60000, "10:00:00"),
                      (A1, 60000, "11:00:00")]).withColumn(
        "offset", F.col("event_id").substr(25, 12).cast("bigint"))
    updates = rules.spend_updates(data, slice_len=slice_len)
    assert updates.count() == 5
    alerts = rules.rapid_large_rows(updates)
    assert rows(alerts, "amount") == [(120000.0,), (180000.0,)]
    final = rules.rapid_large_alerts(data)
    assert rows(final, "alert_id") == rows(alerts.select("alert_id").distinct(),
                                           "alert_id")


def test_events_without_account_raise_nothing(spark):
    data = tx(spark, [(None, 900000, "10:00:00")] * 3)
    assert rules.fraud_alerts(data, accounts(spark), dedupe=False).count() == 0


def test_ids_tell_nulls_and_separators_apart(spark):
    from ledgerwatch.functions.ids import alert_id, stable_uuid
    data = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("a", "b", ""), ("a|b", "c", ""), ("a", "b|c", ""),
         ("1:a", None, None), ("", "1:a", None), (None, None, None), ("-", None, None)],
        "x STRING, y STRING, z STRING")
    for made in (alert_id, stable_uuid):
        ids = data.select(made(F.col("x"), F.col("y"), F.col("z")).alias("id"))
        assert ids.distinct().count() == data.count()


def test_events_without_an_id_are_not_folded(spark):
    data = tx(spark, [(A1, 60000, "10:00:00"), (A2, 70000, "11:00:00"), (A2, 70000, "11:00:00")])
    nameless = data.withColumn("event_id", F.lit(None).cast("string"))
    assert rules.distinct_events(nameless).count() == 3
    assert rules.distinct_events(nameless.unionByName(data).unionByName(data)).count() == 6
