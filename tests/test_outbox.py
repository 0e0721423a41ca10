import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from helpers import A1, DAY, accounts, rows, uid
from ledgerwatch import schemas
from ledgerwatch.functions import wire
from ledgerwatch.operators import outbox as ob
from ledgerwatch.sources import codecs
from ledgerwatch.streaming import outbox as job
from ledgerwatch.streaming import manifest, runner

def now():
    return F.lit(datetime(2024, 3, 20)).cast("timestamp")

PAYLOAD = '"AAECAw=="'


def box(spark, items):
    """Items: ``(n, published, published_at, retries, payload)``."""
    return spark.createDataFrame(
        [(uid(n), "topic-a", "k", payload, pub, at, retries, None,
          DAY + timedelta(seconds=n)) for n, pub, at, retries, payload in items],
        schemas.OUTBOX)


def pending(n, retries=0, payload=PAYLOAD):
    return (n, False, None, retries, payload)


def test_oldest_hundred_pending(spark):
    data = box(spark, [pending(n) for n in reversed(range(250))]
               + [(n, True, DAY, 0, PAYLOAD) for n in range(250, 260)])
    got = ob.outbox_pending(data)
    assert rows(got, "id") == [(uid(n),) for n in range(100)]
    assert ob.outbox_pending(data, None).count() == 250


def test_publish_and_fail(spark):
    data = box(spark, [pending(1), pending(2, 4, '"*"'), pending(3, 9, '"*"'),
                       (4, True, DAY, 0, PAYLOAD)])
    records = ob.publishable(ob.outbox_pending(data))
    assert records.filter(F.col("id") == uid(1)).first().value == b"\x00\x01\x02\x03"
    after = ob.outbox_apply(data, ob.publish_results(records), now())
    assert rows(after, "id", "published", "retry_count", "last_error",
                "needs_manual") == [
        (uid(1), True, 0, None, False),
        (uid(2), False, 5, "payload is not base64", True),
        (uid(3), False, 10, "payload is not base64", True),
        (uid(4), True, 0, None, False)]
    again = ob.outbox_pending(after)
    assert rows(again, "id") == [(uid(2),), (uid(3),)]


def test_whole_publish_fails(spark):
    data = box(spark, [pending(1), pending(2)])
    results = ob.publish_results(ob.publishable(data), F.lit("timeout"))
    after = ob.outbox_apply(data, results, now())
    assert rows(after, "published", "retry_count", "last_error") == [
        (False, 1, "timeout")] * 2


def test_retention_and_recent(spark):
    old, new = datetime(2024, 3, 12), datetime(2024, 3, 13)
    data = box(spark, [(1, True, old, 0, PAYLOAD), (2, True, new, 0, PAYLOAD), pending(3)])
    assert rows(ob.outbox_retain(data, now()), "id") == [(uid(2),), (uid(3),)]
    assert [r.id for r in ob.recent(data, n=2).collect()] == [uid(3), uid(2)]


REQUEST = "request STRING, account_id STRING, amount STRING, type STRING, description STRING"


def accept(spark, items):
    return ob.accept(spark.createDataFrame(items, REQUEST), accounts(spark), "request",
                     now=F.lit(datetime(2024, 3, 5, 10)).cast("timestamp"))


def test_accept_good_request(spark):
    done = accept(spark, [("r1", A1, "12.345", "DEBIT", "rent")])
    row = done.transactions.first()
    assert (row.amount, row.currency, row.status) == (Decimal("12.35"), "INR", "INITIATED")
    assert row.created_at == row.updated_at == datetime(2024, 3, 5, 10)
    out = done.outbox.first()
    assert (out.topic, out.partition_key, out.published, out.retry_count) == (
        "transaction.initiated", A1, False, 0)
    frame = done.outbox.select(wire.unquote_base64(F.col("payload")).alias("v"))
    body = frame.select(wire.schema_id(F.col("v")).alias("sid"),
                        wire.body(F.col("v")).alias("value"))
    assert body.first().sid == 1
    event = codecs.decode_events(body, "json", schemas.EVENT_V2).first()
    assert (event.transactionId, event.amount, event.occurredAt) == (
        row.id, 12.35, 1709632800000)
    assert done.rejected.count() == 0


def test_reject_reasons(spark):
    done = accept(spark, [
        ("r1", "nobody", "1", "DEBIT", None), ("r2", A1, "abc", "DEBIT", None),
        ("r3", A1, "1", "REFUND", None), ("r4", A1, "1e14", "CREDIT", None),
        ("r5", A1, "9999999999999.999", "CREDIT", None)])
    assert done.transactions.count() == 0
    assert rows(done.rejected, "request", "violations") == [
        ("r1", ["account_exists"]), ("r2", ["amount_missing"]),
        ("r3", ["type_domain"]), ("r4", ["amount_range"]), ("r5", ["amount_range"])]


def test_ids_repeat(spark):
    items = [(f"r{i}", A1, "1", "DEBIT", None) for i in range(20)]
    one, two = accept(spark, items), accept(spark, list(reversed(items)))
    assert rows(one.transactions, "id") == rows(two.transactions, "id")
    assert one.transactions.select("id").distinct().count() == 20


def test_touch(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY)], "n INT, updated_at TIMESTAMP")
    assert rows(ob.touch(df, F.col("n") == 2, now()), "n", "updated_at") == [
        (1, DAY), (2, datetime(2024, 3, 20))]


def test_relay_through_an_outage(spark, tmp_path):
    work = str(tmp_path)
    published = []

    def down(records, number):
        raise RuntimeError("broker down")

    def up(records, number):
        published.extend(r.id for r in records.collect())

    assert job.relay(spark, work, up) is None
    first = box(spark, [pending(n) for n in range(150)] + [pending(999, 0, '"*"')])
    runner.write_batch(first, f"{work}/{job.OUTBOX}", 0)
    tried = job.relay(spark, work, down, now=now())
    assert tried.count() == 100
    assert rows(tried.select("retry_count", "last_error").distinct(),
                "retry_count", "last_error") == [(1, "broker down")]
    # rows accepted between two passes are taken up
    runner.write_batch(box(spark, [pending(n) for n in range(200, 230)]),
                       f"{work}/{job.OUTBOX}", 1)
    for _ in range(3):
        assert job.relay(spark, work, up, now=now()) is not None
    good = [uid(n) for n in (*range(150), *range(200, 230))]
    assert sorted(published) == good
    table = job.current_outbox(spark, work)
    assert table.count() == len(good) + 1
    assert rows(table.filter("published"), "id") == [(g,) for g in good]
    assert table.filter("published and retry_count = 1").count() == 100
    for _ in range(5):
        last = job.relay(spark, work, up, now=now())
    assert rows(last, "id", "published", "needs_manual") == [(uid(999), False, True)]
    # a pass writes what it tried, and its retry goes on with the row's own count
    for n in runner.versions(spark, f"{work}/{job.RESULTS}"):
        assert runner.read_batch(spark, f"{work}/{job.RESULTS}", n).count() <= 100
    job.retain(spark, work, now())
    state = manifest.latest(spark, work)[1]
    assert state["passes"] == [] and state["folded"] == 8
    assert runner.versions(spark, f"{work}/{job.RESULTS}") == []
    assert len(runner.children(spark, f"{work}/{job.FOLDED}")) == 1
    assert runner.versions(spark, f"{work}/{job.OUTBOX}") == [1]
    assert rows(job.current_outbox(spark, work).filter("published"), "id") == [
        (g,) for g in good]
    assert job.relay(spark, work, up, now=now()).count() == 1


def test_records_of_a_key_are_published_in_order(spark, tmp_path):
    work, sent = str(tmp_path), []
    for batch in range(3):  # later rows in earlier batches, several files each
        items = [pending(n) for n in range(batch, 300, 3)]
        runner.write_batch(box(spark, items).withColumn(
            "partition_key", F.concat(F.lit("k"), F.substring("id", -1, 1)))
            .repartition(4), f"{work}/{job.OUTBOX}", batch)

    def publish(records, number):
        for part in records.rdd.glom().collect():
            sent.append([(r.key, r.created_at, r.id) for r in part])

    job.relay(spark, work, publish, limit=None, now=now())
    assert sum(map(len, sent)) == 300
    homes = {}
    for number, part in enumerate(sent):
        assert part == sorted(part)
        for key, _, _ in part:
            assert homes.setdefault(key, number) == number


def test_rows_that_failed_too_often_go_last(spark, tmp_path):
    work, published = str(tmp_path), []
    broken = [pending(n, 0, '"*"') for n in range(20)]
    fine = [pending(100 + n) for n in range(5)]
    runner.write_batch(box(spark, broken + fine), f"{work}/{job.OUTBOX}", 0)
    for _ in range(12):
        job.relay(spark, work, lambda r, n: published.extend(x.id for x in r.collect()),
                  limit=20, now=now(), manual_last=True)
        if not job.untried_left(spark, work):
            break
    assert sorted(published) == [uid(100 + n) for n in range(5)]


def test_unfinished_pass_runs_again(spark, tmp_path, monkeypatch):
    work, published = str(tmp_path), []
    runner.write_batch(box(spark, [pending(n) for n in range(5)]), f"{work}/{job.OUTBOX}", 0)

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(manifest, "commit", dies)
    with pytest.raises(RuntimeError):
        job.relay(spark, work, lambda r, n: published.append(r.count()), now=now())
    monkeypatch.undo()
    assert job.current_outbox(spark, work).count() == 5
    job.relay(spark, work, lambda r, n: published.append(r.count()), now=now())
    assert published == [5, 5]
    assert job.current_outbox(spark, work).filter("published").count() == 5


def test_pending_filter_reaches_the_scan(spark, tmp_path, capsys):
    box(spark, [pending(1), (2, True, DAY, 0, PAYLOAD)]).write.parquet(str(tmp_path / "o"))
    ob.outbox_pending(spark.read.parquet(str(tmp_path / "o"))).explain()
    plan = capsys.readouterr().out
    assert "published" in plan.split("PushedFilters: ")[1].split("]")[0]
    assert "TakeOrderedAndProject" in plan


class Killed(RuntimeError):
    pass


def killed_at(monkeypatch, step):
    """Let the process die in its ``step``-th write, commit or removal: a write that
    replaces something has already removed it by then."""
    left = [step]

    def dying(real, before=lambda *a: None):
        def call(*args, **kwargs):
            left[0] -= 1
            if left[0] == 0:
                before(*args)
                raise Killed
            return real(*args, **kwargs)
        return call

    monkeypatch.setattr(DataFrameWriter, "parquet", dying(
        DataFrameWriter.parquet, lambda writer, path: shutil.rmtree(path, ignore_errors=True)))
    monkeypatch.setattr(runner, "write_text", dying(runner.write_text))
    monkeypatch.setattr(runner, "rename", dying(runner.rename))
    monkeypatch.setattr(runner, "remove", dying(runner.remove))


def test_no_row_is_lost_wherever_a_job_dies(spark, tmp_path, monkeypatch):
    """Relay, fold and retention killed at each of their steps in turn: every row is found
    again, and after another run the state is that of jobs which never died."""
    def down(records, number):
        raise RuntimeError("broker down")

    def start(work):
        runner.write_batch(box(spark, [pending(n) for n in range(6)]), f"{work}/{job.OUTBOX}", 0)
        job.relay(spark, work, down, limit=4, now=now())
        runner.write_batch(box(spark, [pending(n) for n in range(6, 9)]),
                           f"{work}/{job.OUTBOX}", 1)

    def everything(work):
        return rows(job.current_outbox(spark, work), "id", "published", "retry_count")

    jobs = {"relay": lambda w: job.relay(spark, w, lambda r, n: r.count(), limit=4, now=now(),
                                         fold_every=2),
            "retain": lambda w: job.retain(spark, w, now())}
    fresh = str(tmp_path / "fresh")
    start(fresh)
    for name, run in jobs.items():
        calm = shutil.copytree(fresh, str(tmp_path / f"{name}-calm"))
        before = everything(calm)
        run(calm)
        after = everything(calm)
        assert [r[0] for r in before] == [r[0] for r in after] == [uid(n) for n in range(9)]
        for step in range(1, 30):
            work = shutil.copytree(fresh, str(tmp_path / f"{name}-{step}"))
            with monkeypatch.context() as patch:
                killed_at(patch, step)
                try:
                    run(work)
                    break
                except Killed:
                    pass
            found = everything(work)
            assert found in (before, after)
            if found == before:
                run(work)
            else:
                job.retain(spark, work, now())
            assert everything(work) == after
        assert 3 < step < 29


def test_of_two_writers_one_fails(spark, tmp_path):
    manifest.commit(spark, str(tmp_path), 1, {"a": 1})
    with pytest.raises(ValueError):
        manifest.commit(spark, str(tmp_path), 1, {"a": 2})
    for n in range(2, 6):
        manifest.commit(spark, str(tmp_path), n, {"a": n})
    assert manifest.latest(spark, str(tmp_path)) == (5, {"a": 5})
    assert len([x for x in runner.children(spark, f"{tmp_path}/manifest")
                if x.endswith(".json")]) == 2
    assert manifest.latest(spark, f"{tmp_path}/none") == (0, {})


def test_large_passes_are_cut_by_ranges(spark, tmp_path, monkeypatch):
    """As sorting in one task, also with nulls and equal times; nothing is merged in one task."""
    rows = [(f"id{i:03d}", i % 9 == 0, f"2024-01-0{i % 3 + 1} 00:00:00" if i % 7 else None, i % 2 == 0)
            for i in range(200)]
    data = (spark.createDataFrame(rows, "id string, published boolean, created_at string, late boolean")
            .withColumn("created_at", F.col("created_at").cast("timestamp"))).repartition(5)
    for limit in (2, 50, 177, 178, 500):
        expected = {r.id for r in ob.outbox_pending(data, limit, ["late"]).collect()}
        monkeypatch.setattr(job, "MERGED", 1)
        got = job._oldest(data, limit, ["late"], str(tmp_path / "order"), limit)
        assert sorted(r.id for r in got.collect()) == sorted(expected)
        assert got.columns == data.columns
        plan = got._jdf.queryExecution().toString()
        assert "GlobalLimit" not in plan and "TakeOrdered" not in plan
