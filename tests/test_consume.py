import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import A1, rows, uid
from ledgerwatch import schemas
from ledgerwatch.functions import backoff, texts, wire
from ledgerwatch.operators import consume, metrics
from ledgerwatch.sources import codecs

SCHEMA = "event_id STRING, offset LONG, account_id STRING, currency STRING, amount DOUBLE"


def deliveries(spark, items):
    return spark.createDataFrame(
        [(e, i, A1, "INR", float(a)) for i, (e, a) in enumerate(items)], SCHEMA)


def judge(spark, items, ledger=None, **kw):
    return consume.classify(deliveries(spark, items), ledger,
                            texts.simulated_failure(F.col("amount")), **kw)


def test_good_event_is_sent_once(spark):
    out = judge(spark, [(uid(1), 1500)] * 3)
    assert rows(out, "offset", "status", "attempts", "backoff_ms") == [
        (0, "SENT", 1, 0), (1, "DUPLICATE", 0, 0), (2, "DUPLICATE", 0, 0)]
    assert rows(consume.notification_lines(out), "line") == [
        (f"Notification sent: Account {A1} transaction for amount INR 1500.0",)]
    assert rows(consume.ledger_rows(out), "event_id", "consumer_group") == [
        (uid(1), "notification-service")]


def test_failing_event_is_dead_lettered_each_time(spark):
    out = judge(spark, [(uid(1), 999.99)] * 3)
    assert {(r.status, r.attempts, r.backoff_ms, r.reason) for r in out.collect()} == {
        ("DLQ", 3, 3000, "Simulated notification failure for amount: 999.99")}
    assert consume.ledger_rows(out).count() == 0
    assert consume.dead_letters(out).count() == 3


def test_text_of_large_doubles(spark):
    assert rows(judge(spark, [(uid(1), 10000000.99), (uid(2), 9999999.99)]),
                "status") == [("DLQ",), ("SENT",)]


def test_bad_ids_and_undecoded_values(spark):
    out = consume.classify(
        deliveries(spark, [("not-a-uuid", 1), (None, 1), (uid(3), 1)]), None,
        texts.simulated_failure(F.col("amount")),
        decoded=F.col("offset") != 2)
    assert rows(out, "offset", "status", "attempts", "reason") == [
        (0, "DLQ", 0, "bad event id"), (1, "DLQ", 0, "bad event id"),
        (2, "DLQ", 0, "Unexpected message type")]


def test_ledger_comes_before_the_handler(spark):
    ledger = spark.createDataFrame([(uid(1).upper(),), (uid(2),)], "event_id STRING")
    out = judge(spark, [(uid(1), 5), (uid(2), 5.99), (uid(3), 5)], ledger)
    assert rows(out, "offset", "status") == [
        (0, "DUPLICATE"), (1, "DUPLICATE"), (2, "SENT")]


def one_by_one(items, done):
    done, out = set(done), []
    for e, a in items:
        if e in done:
            out.append("DUPLICATE")
        elif str(float(a)).endswith(".99"):
            out.append("DLQ")
        else:
            done.add(e)
            out.append("SENT")
    return out


@pytest.mark.parametrize("seed,broadcast", [(1, True), (2, False)])
def test_equals_sequential_consumer(spark, seed, broadcast, request):
    """Also with copies that differ, and with one event in a third of all rows."""
    rnd = random.Random(seed)
    items = [(uid(0) if rnd.random() < 0.34 else uid(rnd.randrange(40)),
              rnd.choice([5, 6.99, 7.5])) for _ in range(400)]
    done = [uid(n) for n in range(30, 40)]
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        request.addfinalizer(
            lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    out = judge(spark, items, spark.createDataFrame([(d,) for d in done],
                                                    "event_id STRING"))
    assert [r.status for r in out.orderBy("offset").collect()] == one_by_one(items, done)


def test_dedupe_of_copies_is_identity(spark):
    base = deliveries(spark, [(uid(n), n) for n in range(50)])
    copies = base.unionByName(base.withColumn("offset", F.col("offset") + 1000))
    first = consume.first_delivery(copies)
    assert rows(first, *base.columns) == rows(base, *base.columns)


def test_new_and_processed(spark):
    data = deliveries(spark, [(uid(1), 1), (uid(2), 1), (uid(2), 1)])
    ledger = spark.createDataFrame([(uid(2),), (uid(2),)], "event_id STRING")
    assert rows(consume.new_events(data, ledger), "offset") == [(0,)]
    assert rows(consume.processed_events(data, ledger), "offset") == [(1,), (2,)]


def test_backoff(spark):
    df = spark.range(1, 5).select(
        backoff.delay_ms(F.col("id")).alias("wait"),
        backoff.total_ms(F.col("id")).alias("total"))
    assert rows(df.orderBy("wait"), "wait", "total") == [
        (1000, 0), (2000, 1000), (4000, 3000), (8000, 7000)]


def test_retry_schedule(spark):
    t = datetime(2024, 3, 5, 10)
    data = spark.createDataFrame([(1, t), (2, t), (3, t)],
                                 "attempt INT, last_attempt_at TIMESTAMP_NTZ")
    now = F.lit("2024-03-05 10:00:01").cast("timestamp_ntz")
    assert rows(consume.retry_due(data, now), "attempt", "state") == [
        (1, "DUE"), (2, "WAITING"), (3, "EXHAUSTED")]


def test_frames(spark):
    body = F.encode(F.lit("body"), "UTF-8")
    values = spark.range(1).select(F.explode(F.array(
        wire.frame(body, F.lit(258)), F.encode(F.lit('{"a":1}'), "UTF-8"),
        F.unhex(F.lit("0001")), F.lit(None).cast("binary"))).alias("value"))
    split = consume.split_frames(values)
    assert rows(split.withColumn("body", F.col("body").cast("string")), "schema_id",
                "body", "bad_reason") == sorted([
        (258, "body", None), (None, None, "unknown magic byte"),
        (None, None, "frame too short"), (None, None, "null value")], key=str)
    assert rows(consume.frame_counts(split), "frames") == [(1,)] * 4


def test_payload_quotes(spark):
    df = spark.createDataFrame([('"AAECAw=="',), ("AAECAw==",), ('"*"',)], "p STRING")
    got = df.select("p", wire.unquote_base64(F.col("p")).alias("b"))
    assert {r.p: r.b for r in got.collect()} == {
        '"AAECAw=="': b"\x00\x01\x02\x03", "AAECAw==": b"\x00\x01\x02\x03", '"*"': None}


def test_long_payload_is_one_line(spark):
    df = spark.range(1).select(F.encode(F.repeat(F.lit("x"), F.lit(500)), "UTF-8").alias("v"))
    text = df.select(wire.quote_base64(F.col("v"))).first()[0]
    assert "\n" not in text and "\r" not in text
    back = df.select(wire.unquote_base64(wire.quote_base64(F.col("v"))) == F.col("v"))
    assert back.first()[0]


def test_counters(spark):
    out = judge(spark, [(uid(1), 5), (uid(1), 5), (uid(2), 5.99)])
    assert rows(metrics.consumer_counters(out), "name", "total") == [
        ("dlq", 1), ("duplicates", 1), ("sent", 1)]


def test_json_records(spark):
    values = spark.createDataFrame(
        [('{"eventId":"e","amount":1.5,"occurredAt":1000}',), ("not json",), (None,)],
        "value STRING")
    out = codecs.decode_events(values, "json", "eventId STRING, amount DOUBLE, "
                               "occurredAt BIGINT, merchantId STRING")
    assert rows(out, "decoded", "eventId", "amount", "merchantId") == [
        (False, None, None, None), (False, None, None, None), (True, "e", 1.5, None)]
    event = codecs.to_event(out.filter("decoded"))
    assert event.first().occurred_at == datetime(1970, 1, 1, 0, 0, 1)


def test_old_records_read_as_new(spark):
    old = spark.createDataFrame([("a",)], "event_id STRING")
    new = spark.createDataFrame([("b", "m")], "event_id STRING, merchant_id STRING")
    assert rows(codecs.with_all_fields(old, new), "event_id", "merchant_id") == [
        ("a", None), ("b", "m")]


def test_avro_records(spark):
    if not codecs.has_avro(spark):
        pytest.skip("Spark's Avro module is not on the classpath")
    from ledgerwatch.schemas import EVENT_V2_AVRO
    df = spark.sql("select 'e' eventId, 't' transactionId, 'a' accountId, 1.5D amount, "
                   "'INR' currency, 'DEBIT' type, null description, 1000L occurredAt, "
                   "null merchantId")
    for fmt in ("avro", "confluent_avro"):
        back = codecs.decode_events(codecs.encode_events(df, fmt, EVENT_V2_AVRO), fmt,
                                    EVENT_V2_AVRO)
        assert back.first().amount == 1.5


def test_pass_through_records(spark):
    df = spark.createDataFrame([("k", b"ab")], "account_id STRING, value BINARY")
    raw = codecs.encode_events(df, "raw", key="account_id").first()
    text = codecs.encode_events(df, "text", key="account_id").first()
    assert (raw.key, raw.value, text.value) == ("k", b"ab", "ab")


def test_retry_steps_end_in_dead_letters(spark):
    start = datetime(2024, 3, 5, 10)
    table = spark.createDataFrame(
        [("bad", 1, start), ("good", 1, start)],
        "event_id STRING, attempt INT, last_attempt_at TIMESTAMP_NTZ")
    fails = F.when(F.col("event_id") == "bad", F.lit("down"))

    def step(df, second):
        now = F.lit(datetime(2024, 3, 5, 10, 0, second)).cast("timestamp_ntz")
        return consume.retry_step(df, now, fails)

    assert rows(step(table, 0), "status") == [("RETRY",), ("RETRY",)]
    one = step(table, 1)
    assert rows(one, "event_id", "attempt", "status") == [
        ("bad", 2, "RETRY"), ("good", 2, "SENT")]
    left = one.filter("status = 'RETRY'").drop("status")
    assert rows(step(left, 2), "attempt", "status") == [(2, "RETRY")]
    assert rows(step(left, 3), "attempt", "status") == [(3, "DLQ")]


def test_rows_without_an_id_are_never_folded(spark):
    data = spark.createDataFrame(
        [(None, 1, A1, "INR", 5.0), (None, 2, A1, "INR", 7.0), (uid(1), 3, A1, "INR", 1.0),
         (uid(1), 4, A1, "INR", 1.0)], SCHEMA)
    assert rows(consume.first_delivery(data), "offset") == [(1,), (2,), (3,)]


def test_many_copies_are_made_in_steps(spark, monkeypatch):
    monkeypatch.setattr(consume, "COPIES", 7)
    data = spark.createDataFrame([("a",)] * 50 + [("b",)] + [(None,)] * 14, "x STRING")
    got = consume.numbered_copies(data)
    assert sorted(map(str, got.collect())) == sorted(
        map(str, [*(type(r)(x=v, copy=n) for r in got.take(1) for v, top in
                    (("a", 50), ("b", 1), (None, 14)) for n in range(1, top + 1))]))


def test_dead_letters_keep_key_and_bytes(spark):
    judged = spark.createDataFrame(
        [("ACC-1", bytearray(b"junk"), None, None, "DLQ", 0, 0, consume.UNEXPECTED_TYPE),
         ("ACC-2", bytearray(b"{}"), "e", "ACC-2", "DLQ", 3, 3000, "handler"),
         ("ACC-3", bytearray(b"{}"), "f", "ACC-3", "SENT", 1, 0, None)],
        "key STRING, value BINARY, event_id STRING, account_id STRING, status STRING, "
        "attempts INT, backoff_ms LONG, reason STRING")
    got = consume.dead_letters(judged, envelope=("key", "value"))
    assert sorted((r.key, bytes(r.value)) for r in got.collect()) == [
        ("ACC-1", b"junk"), ("ACC-2", b'{"event_id":"e","account_id":"ACC-2"}')]


def test_bodies_are_read_by_the_schema_of_their_frame(spark):
    """Two versions, an unknown id, a broken body and no frame in one batch."""
    v1, v2 = schemas.EVENT_V1, schemas.EVENT_V2
    body = '{"eventId":"e","amount":1.5,"occurredAt":7,"merchantId":"M"}'
    data = spark.createDataFrame(
        [(1, body, 1), (2, body, 2), (3, body, 9), (4, "junk", 2), (5, body, None)],
        "n INT, body STRING, id INT").select("n", F.when(
            F.col("id").isNull(), F.col("body").cast("binary")).otherwise(
            wire.frame(F.col("body").cast("binary"), F.col("id"))).alias("value"))
    got = codecs.decode_events(data, "confluent_json", v2, writers={1: v1, 2: v2})
    assert rows(got, "n", "decoded", "eventId", "amount", "merchantId") == [
        (1, True, "e", 1.5, None), (2, True, "e", 1.5, "M"), (3, False, None, None, None),
        (4, False, None, None, None), (5, False, None, None, None)]
    assert [f["name"] for f in schemas.EVENT_V1_AVRO["fields"]] == [
        f["name"] for f in schemas.EVENT_V2_AVRO["fields"]][:-1]
