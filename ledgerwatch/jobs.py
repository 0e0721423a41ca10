"""Entry points of the services as Spark jobs.

    python -m ledgerwatch.jobs alerts --transactions T --accounts A --out O
    python -m ledgerwatch.jobs accounts --kafka host:9092 --out A --checkpoint C
    python -m ledgerwatch.jobs fraud --files T --accounts A --out O [--once]
    python -m ledgerwatch.jobs consume --kafka host:9092 --out O
    python -m ledgerwatch.jobs accept --files R --accounts A --out O
    python -m ledgerwatch.jobs relay --tables O --topics P
    python -m ledgerwatch.jobs consume --records P --out O
    python -m ledgerwatch.jobs retain --tables O

Streams read a folder of files (``--files``), a topic (``--kafka``) or the files of
topics that ``relay --topics`` wrote (``--records``). ``--once``
processes what is there and stops. All folders must be reachable from every
executor.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from . import schemas
from .functions import texts
from .operators import consume, outbox, rules
from .session import build_session, use_utc
from .sources import codecs, streams
from .streaming import accounts, consumer, fraud, retries, runner
from .streaming import outbox as outbox_job

RELAY_DELAY_SECONDS = 1.0
#: How every job writes and reads records unless told otherwise.
WIRE_FORMAT = "confluent_avro"


def _accounts(path: str):
    """Reader of a plain account table, or of one kept by the ``accounts`` job."""
    def read(spark: SparkSession) -> DataFrame:
        if runner.versions(spark, path):
            return accounts.current_accounts(spark, path)
        return spark.read.parquet(path)
    return read


def start_accounts(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    if args.files:
        changes = streams.file_stream(
            spark, args.files, f"{schemas.ACCOUNT_EVENT}, offset BIGINT",
            max_files=args.max_files)
    else:
        records = streams.kafka_stream(spark, args.kafka, streams.ACCOUNT_TOPIC,
                                       max_offsets=args.max_offsets)
        schema = (schemas.ACCOUNT_AVRO if args.format.endswith("avro")
                  else schemas.ACCOUNT_WIRE)
        changes = accounts.read_changes(records, args.format, schema)
    return [accounts.start_account_table(
        changes, args.out, args.checkpoint,
        every=None if args.once else "1 minute")]


def _events(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Event columns from files, or from framed records of the transaction topic (in
    Kafka, or in the files of ``relay --topics``)."""
    if args.files:
        return streams.file_stream(spark, args.files, schemas.EVENT,
                                   max_files=args.max_files)
    if args.records:
        records = streams.record_files(spark, args.records, streams.TRANSACTION_TOPIC,
                                       args.max_files)
    else:
        records = streams.kafka_stream(spark, args.kafka, streams.TRANSACTION_TOPIC,
                                       max_offsets=args.max_offsets)
    schema = (schemas.EVENT_V2_AVRO if args.format.endswith("avro")
              else schemas.EVENT_V2)
    return consumer.read_events(records, args.format, schema)


def _every(args: argparse.Namespace) -> str | None:
    return None if args.once else runner.ONE_SECOND


def _sink(args: argparse.Namespace, name: str) -> runner.Handler:
    if args.alert_servers:
        return runner.publish_alerts(args.alert_servers, args.format)
    return runner.write_alerts(f"{args.out}/{name}")


def alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    found = rules.fraud_alerts(spark.read.parquet(args.transactions),
                               _accounts(args.accounts)(spark),
                               dedupe=not args.keep_copies)
    found.write.mode("overwrite").parquet(args.out)


def start_fraud(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """The three rules, each with its own checkpoint."""
    tx, every = _events(spark, args), _every(args)
    if "decoded" in tx.columns:  # what cannot be read is the consumer's to report
        tx = tx.filter("decoded")

    def checkpoint(name: str) -> str:
        return f"{args.out}/checkpoints/{name}"

    return [
        fraud.start_high_value(tx, _accounts(args.accounts), _sink(args, "high_value"),
                               checkpoint("high_value"), every=every,
                               work=f"{args.out}/state/high_value"),
        fraud.start_velocity(tx, _sink(args, "velocity"), checkpoint("velocity"),
                             f"{args.out}/state/velocity", every=every),
        fraud.start_rapid_large(tx, _sink(args, "rapid_large"),
                                checkpoint("rapid_large"), every=every),
    ]


def start_consume(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Topic records are ordered by offset, rows of files by time and copy. Within
    a topic the copies of an event share its account's partition. With ``--retry``,
    failed records wait for their next attempt; ``--once`` leaves them to the next run."""
    events, every = _events(spark, args), _every(args)
    checkpoint = f"{args.out}/checkpoint"
    queue = retries.RetryQueue() if args.retry else None

    def failure(attempt=None):
        return texts.simulated_failure(F.col("amount"))

    def ticking(rows):
        return retries.with_ticks(rows) if args.retry and not args.once else rows

    if args.files:
        return [consumer.start_consumer(
            ticking(events), args.out, checkpoint, failure,
            order_by=["occurred_at", *_other_columns(events), "copy"],
            prepare=consume.numbered_copies, queue=queue, every=every)]
    if args.records:
        return [consumer.start_consumer(
            ticking(events), args.out, checkpoint, failure,
            order_by=["batch_id", "occurred_at", *sorted(
                set(events.columns) - {"batch_id", "occurred_at"}), "copy"],
            decoded="decoded", prepare=consume.numbered_copies, queue=queue, every=every)]
    return [consumer.start_consumer(
        ticking(events), args.out, checkpoint, failure, order_by=["partition", "offset"],
        decoded="decoded", on_dead_letters=consumer.publish_dead_letters(args.kafka),
        queue=queue, every=every)]


def _other_columns(events: DataFrame) -> list[str]:
    return [c for c in events.columns if c != "occurred_at"]


def start_accept(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Requests as JSON lines. A request is known by its file, its text, and its
    number among equal lines there."""
    lines = streams.file_stream(spark, args.files, "value STRING", "text",
                                max_files=args.max_files)
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"))
    requests = (codecs.decode_events(placed, "json", schemas.REQUEST)
                .withColumnRenamed("accountId", "account_id"))
    return [outbox_job.start_accept(
        requests, _accounts(args.accounts), args.out, f"{args.out}/checkpoint",
        ["file", "value", "copy"], prepare=consume.numbered_copies,
        body=lambda: codecs.event_body(
            [f["name"] for f in schemas.EVENT_V2_AVRO["fields"]],
            args.format.removeprefix(codecs.FRAMED), schemas.EVENT_V2_AVRO),
        every=_every(args))]


def relay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Passes with a fixed delay after each; ``--once`` runs until a pass published
    nothing and every pending row was tried. Rows that failed too often go last unless
    ``--oldest-first`` is given."""
    def publish(records: DataFrame, number: int) -> None:
        if args.kafka:
            streams.write_kafka(records.select("topic", "key", "value"), args.kafka)
        else:
            streams.write_topics(records, args.topics, number)

    limit = args.limit if args.limit > 0 else None
    while True:
        tried = outbox_job.relay(spark, args.tables, publish, limit,
                                 manual_last=not args.oldest_first)
        if args.once and (tried is None or (
                tried.filter("published").isEmpty()
                and not outbox_job.untried_left(spark, args.tables))):
            return
        if not args.once:
            time.sleep(RELAY_DELAY_SECONDS)


def retain(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold relay results and drop what was published longer than ``--keep`` ago."""
    outbox_job.retain(spark, args.tables, F.current_timestamp(), args.keep)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerwatch")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def stream(sub: argparse.ArgumentParser, records: bool = False) -> None:
        source = sub.add_mutually_exclusive_group(required=True)
        source.add_argument("--files")
        source.add_argument("--kafka")
        if records:
            source.add_argument("--records")
        sub.add_argument("--format", default=WIRE_FORMAT)
        sub.add_argument("--max-files", type=int)
        sub.add_argument("--max-offsets", type=int)
        sub.add_argument("--once", action="store_true")

    job("alerts", "transactions", "accounts", "out").add_argument(
        "--keep-copies", action="store_true")
    stream(job("accounts", "out", "checkpoint"))
    rules_job = job("fraud", "accounts", "out")
    rules_job.add_argument("--alert-servers")
    stream(rules_job, records=True)
    consume_job = job("consume", "out")
    consume_job.add_argument("--retry", action="store_true")
    stream(consume_job, records=True)
    accept_job = job("accept", "files", "accounts", "out")
    accept_job.add_argument("--format", default=WIRE_FORMAT)
    accept_job.add_argument("--max-files", type=int)
    accept_job.add_argument("--once", action="store_true")
    relay_job = job("relay", "tables")
    target = relay_job.add_mutually_exclusive_group(required=True)
    target.add_argument("--topics")
    target.add_argument("--kafka")
    relay_job.add_argument("--limit", type=int, default=outbox.BATCH)
    relay_job.add_argument("--oldest-first", action="store_true")
    relay_job.add_argument("--once", action="store_true")
    job("retain", "tables").add_argument("--keep", default=outbox.KEEP)
    return top


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended; where one fails, stop the others and raise."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
            for query in queries:
                if query.exception() is not None:
                    raise query.exception()
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = use_utc(spark or build_session())
    batch = {"alerts": alerts, "relay": relay, "retain": retain}
    if args.job in batch:
        batch[args.job](spark, args)
        return
    start = {"accounts": start_accounts, "fraud": start_fraud,
             "consume": start_consume, "accept": start_accept}
    await_all(spark, start[args.job](spark, args))


if __name__ == "__main__":
    main()
