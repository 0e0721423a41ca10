"""The jobs on file input, end to end."""

from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import A1, A2, DAY, accounts, rows, tx, uid
from ledgerwatch import jobs, schemas
from ledgerwatch.operators import rules
from ledgerwatch.streaming import consumer, retries, runner
from ledgerwatch.streaming import outbox as outbox_job


@pytest.fixture
def work(spark, tmp_path):
    accounts(spark).write.parquet(str(tmp_path / "accounts"))
    return str(tmp_path)


def events(spark, work):
    data = [(A2, 500, DAY + timedelta(minutes=n)) for n in range(3)]
    data += [(A1, 150000, DAY + timedelta(hours=5)), (A1, "7.99", DAY)]
    whole = (tx(spark, data).withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))
             .withColumn("merchant_id", F.lit(None).cast("string")))
    whole.write.parquet(f"{work}/tx")
    return whole


def run(spark, *argv):
    jobs.main(list(argv), spark)


def test_alerts(spark, work):
    whole = events(spark, work)
    run(spark, "alerts", "--transactions", f"{work}/tx", "--accounts",
        f"{work}/accounts", "--out", f"{work}/out")
    out = spark.read.parquet(f"{work}/out")
    assert rows(out, "alert_type", "account_id") == [
        ("HIGH_VALUE", A1), ("RAPID_LARGE", A1), ("VELOCITY", A2)]
    assert rows(out, "alert_id") == rows(rules.fraud_alerts(whole, accounts(spark)),
                                         "alert_id")


def test_fraud_streams(spark, work):
    whole = events(spark, work)
    run(spark, "fraud", "--files", f"{work}/tx", "--accounts", f"{work}/accounts",
        "--out", f"{work}/out", "--once")
    found = [r for name in ("high_value", "velocity", "rapid_large")
             for r in rows(runner.latest_alerts(spark, f"{work}/out/{name}"), "alert_id")]
    assert sorted(found) == rows(rules.fraud_alerts(whole, accounts(spark)), "alert_id")


def test_account_table_feeds_the_rules(spark, work):
    events(spark, work)
    spark.createDataFrame(
        [(A1, "ACC001", "One", "STANDARD", "ACTIVE", 1),
         (A1, "ACC001", "One", "ELITE", "ACTIVE", 2)],
        f"{schemas.ACCOUNT_EVENT}, offset BIGINT").write.parquet(f"{work}/changes")
    run(spark, "accounts", "--files", f"{work}/changes", "--out", f"{work}/table",
        "--checkpoint", f"{work}/cp", "--once")
    run(spark, "alerts", "--transactions", f"{work}/tx", "--accounts",
        f"{work}/table", "--out", f"{work}/out")
    assert rows(spark.read.parquet(f"{work}/out"), "alert_type", "account_id") == [
        ("RAPID_LARGE", A1), ("VELOCITY", A2)]


def test_consume(spark, work):
    whole = events(spark, work)
    whole.write.mode("append").parquet(f"{work}/tx")
    run(spark, "consume", "--files", f"{work}/tx", "--out", f"{work}/out", "--once")
    outcomes = spark.read.parquet(f"{work}/out/{consumer.OUTCOMES}")
    assert rows(outcomes.groupBy("event_id", "status").count(), "event_id", "status",
                "count") == sorted(
        [(uid(n), s, 1) for n in range(4) for s in ("SENT", "DUPLICATE")]
        + [(uid(4), "DLQ", 2)], key=str)


def test_consume_with_retries(spark, work):
    """Records that fail are no outcome until their attempts are used up."""
    whole = events(spark, work)
    whole.write.mode("append").parquet(f"{work}/tx")
    run(spark, "consume", "--files", f"{work}/tx", "--out", f"{work}/out", "--once", "--retry")
    outcomes = spark.read.parquet(f"{work}/out/{consumer.OUTCOMES}")
    assert outcomes.count() == 8 and outcomes.filter("status = 'DLQ'").isEmpty()
    waiting = spark.read.parquet(f"{work}/out/{retries.WAITING}/batch_id=0")
    assert rows(waiting, "event_id", "tries") == [(uid(4), 1)] * 2


def test_accept_and_relay(spark, work):
    line = f'{{"accountId":"{A1}","amount":"5.00","type":"DEBIT"}}'
    spark.createDataFrame([(line,)] * 3 + [("junk",)], "value STRING").coalesce(1) \
        .write.text(f"{work}/requests")
    run(spark, "accept", "--files", f"{work}/requests", "--accounts",
        f"{work}/accounts", "--out", f"{work}/out", "--once", "--format", "confluent_json")
    made = spark.read.parquet(f"{work}/out/{outbox_job.TRANSACTIONS}")
    assert made.count() == made.select("id").distinct().count() == 3
    run(spark, "relay", "--tables", f"{work}/out", "--topics", f"{work}/topics",
        "--limit", "2", "--once")
    sent = spark.read.parquet(f"{work}/topics")
    assert rows(sent.groupBy("topic", "batch_id").count(), "topic", "count") == [
        ("transaction.initiated", 1), ("transaction.initiated", 2)]
    assert outbox_job.current_outbox(spark, f"{work}/out").filter("published").count() == 3


def test_schemas_parse():
    from pyspark.sql.types import StructType
    for ddl in (schemas.EVENT_V1, schemas.EVENT_V2, schemas.EVENT, schemas.ACCOUNT_EVENT,
                schemas.FRAUD_ALERT, schemas.ACCOUNTS, schemas.TRANSACTIONS,
                schemas.OUTBOX, schemas.PROCESSED_EVENTS, schemas.FRAUD_ALERTS,
                schemas.REQUEST, schemas.KAFKA_RECORD):
        assert StructType.fromDDL(ddl).fields
    assert [f["name"] for f in schemas.EVENT_V2_AVRO["fields"]] == [
        f.name for f in StructType.fromDDL(schemas.EVENT_V2)]


def test_accept_relay_consume_and_fraud_are_one_pipeline(spark, work):
    """By jobs alone: what is accepted is sent once, and the rules see the same events."""
    amounts = ["5.00", "7.99", "150000.00", "2.50", "5.00"]
    lines = [f'{{"accountId":"{A1 if i % 2 else A2}","amount":"{a}","type":"DEBIT"}}'
             for i, a in enumerate(amounts)] + ["junk"]
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1) \
        .write.text(f"{work}/requests")
    form = ("--format", "confluent_json")
    run(spark, "accept", "--files", f"{work}/requests", "--accounts", f"{work}/accounts",
        "--out", f"{work}/out", "--once", *form)
    run(spark, "relay", "--tables", f"{work}/out", "--topics", f"{work}/topics",
        "--limit", "2", "--once")
    run(spark, "consume", "--records", f"{work}/topics", "--out", f"{work}/sent", "--once", *form)
    made = spark.read.parquet(f"{work}/out/{outbox_job.TRANSACTIONS}")
    outcomes = spark.read.parquet(f"{work}/sent/{consumer.OUTCOMES}")
    assert rows(outcomes, "transaction_id", "status") == sorted(
        (r.id, "DLQ" if str(r.amount).endswith(".99") else "SENT") for r in made.collect())
    assert made.count() == 5
    dead = spark.read.parquet(f"{work}/sent/{consumer.DEAD_LETTERS}").collect()
    assert [r.key for r in dead] == [A1]
    run(spark, "fraud", "--records", f"{work}/topics", "--accounts", f"{work}/accounts",
        "--out", f"{work}/fraud", "--once", *form)
    high = runner.latest_alerts(spark, f"{work}/fraud/high_value")
    big = made.filter("amount = 150000").first()
    assert rows(high, "transaction_id", "account_id") == [(big.id, A2)]


def test_a_dead_query_stops_the_job(spark, work):
    def broken(batch, number):
        raise RuntimeError("rule lost")

    spark.range(3).write.parquet(f"{work}/in")
    source = spark.readStream.schema("id LONG").parquet(f"{work}/in")
    lasting = runner.run_stream(source, lambda b, n: None, f"{work}/c1", every="1 second")
    dying = runner.run_stream(source, broken, f"{work}/c2", every="1 second")
    with pytest.raises(StreamingQueryException):
        jobs.await_all(spark, [lasting, dying])
    assert not lasting.isActive
