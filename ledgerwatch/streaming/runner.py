"""Starting queries and writing their batches so that a replay changes nothing."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.reference import latest_per_key
from ..operators.rules import stamped
from ..schemas import ALERT_AVRO
from ..sources import codecs, streams

BATCH = "batch_id"
ONE_SECOND = "1 second"

Handler = Callable[[DataFrame, int], None]


def run_stream(source: DataFrame, handle: Handler, checkpoint: str,
               mode: str = "append", every: str | None = ONE_SECOND,
               name: str | None = None) -> StreamingQuery:
    """Start a query that gives each micro-batch to ``handle`` (OP11, OP14).

    ``every=None`` processes what is there and stops. Offsets are committed after
    ``handle`` returns; a batch that failed comes again with the same number.
    """
    writer = (source.writeStream.foreachBatch(handle).outputMode(mode)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def drain(query: StreamingQuery) -> None:
    """Wait for a query started with ``every=None``."""
    query.awaitTermination()


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _files(spark, path)
    return system.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, target = _files(spark, path)
    return system.getFileStatus(target).isDirectory()


def written_at(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since the epoch."""
    system, target = _files(spark, path)
    return system.getFileStatus(target).getModificationTime() / 1000


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    system, target = _files(spark, path)
    return system.getContentSummary(target).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it does not exist."""
    system, target = _files(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder of expired state."""
    system, target = _files(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    system, target = _files(spark, path)
    stream = system.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _files(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> bool:
    system, source = _files(spark, old)
    return system.rename(source, _files(spark, new)[1])


def write_batch(df: DataFrame, folder: str, batch_id: int, by: str | None = None) -> None:
    """Write a micro-batch as its own part of a table, replacing an earlier try. With
    ``by``, the part has a folder for each value of that column."""
    df.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}", partitionBy=by)


def write_all(batch_id: int, outputs: Mapping[str, DataFrame]) -> None:
    """Write independent outputs (folder → rows) of a micro-batch side by side; each
    is a small job that would leave most of a cluster idle on its own."""
    # The threads keep the job group of the query, so stopping it stops their jobs.
    with ThreadPoolExecutor(len(outputs)) as pool:
        writes = [pool.submit(inheritable_thread_target(rows.sparkSession)(
            partial(write_batch, rows, folder, batch_id))) for folder, rows in outputs.items()]
        wait(writes, return_when=FIRST_EXCEPTION)
        for write in writes:
            write.cancel()
    for write in writes:
        if not write.cancelled():
            write.result()


def read_batch(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/{BATCH}={batch_id}")


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Completely written batches of a table, oldest first; one listing."""
    system, pattern = _files(spark, f"{folder}/{BATCH}=*/_SUCCESS")
    found = system.globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().partition("=")[2])
                  for status in found)


def read_batches(spark: SparkSession, folder: str, numbers: Sequence[int]) -> DataFrame | None:
    """Some batches of a table with their number, nothing else of it listed or read."""
    if not numbers:
        return None
    return (spark.read.option("basePath", folder)
            .parquet(*[f"{folder}/{BATCH}={n}" for n in numbers]))


def remove_before(spark: SparkSession, folder: str, batch_id: int,
                  older_than: float = 0) -> None:
    """Remove versions before ``batch_id`` that were replaced more than ``older_than``
    seconds ago: one is current until the next is written."""
    known = versions(spark, folder)
    for old, after in zip(known, known[1:], strict=False):
        if old < batch_id and (not older_than or time.time() - older_than > written_at(
                spark, f"{folder}/{BATCH}={after}/_SUCCESS")):
            remove(spark, f"{folder}/{BATCH}={old}")


def stored(df: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """A micro-batch written and read back: what follows does not compute it again,
    knows its size, and does not replay it when an executor is lost."""
    write_batch(df, folder, batch_id)
    return read_batch(df.sparkSession, folder, batch_id)


def staged(df: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """``stored`` for the run of one micro-batch: those of finished ones go."""
    rows = stored(df, folder, batch_id)
    remove_before(df.sparkSession, folder, batch_id - 1)
    return rows


def write_alerts(folder: str) -> Handler:
    def handle(alerts: DataFrame, batch_id: int) -> None:
        write_batch(alerts, folder, batch_id)
    return handle


def alert_records(alerts: DataFrame, fmt: str = "json", schema_id: int = 1) -> DataFrame:
    """Alerts as ``key, value`` records of the alert topic, keyed by account (SNK1)."""
    record = codecs.wire_names(stamped(alerts))
    avro = ALERT_AVRO if fmt.endswith("avro") else None
    return codecs.encode_events(record, fmt, avro, key="accountId", schema_id=schema_id)


def publish_alerts(servers: str, fmt: str = "confluent_avro",
                   schema_id: int = 1) -> Handler:
    """Handler that sends alerts to Kafka. A replayed batch is sent again; readers
    keep the last record per alert id."""
    def handle(alerts: DataFrame, batch_id: int) -> None:
        streams.write_kafka(alert_records(alerts, fmt, schema_id), servers,
                            streams.ALERT_TOPIC)
    return handle


def latest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Last version of each alert; update mode may write several (OP4, OP12)."""
    rows = spark.read.parquet(folder)
    return latest_per_key(rows, "alert_id", BATCH).drop(BATCH)


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Counters summed over all micro-batches of a counter table."""
    return (spark.read.parquet(folder)
            .groupBy("name").agg(F.sum("total").alias("total")))


def source_lag(progress: Mapping) -> dict[str, int]:
    """Records per ``topic/partition`` that a Kafka source has not read yet, from a
    query's progress (AGG8)."""
    behind = {}
    for source in progress["sources"]:
        read, latest = source["endOffset"] or {}, source["latestOffset"] or {}
        for topic, partitions in latest.items():
            for partition, offset in partitions.items():
                done = read.get(topic, {}).get(partition, 0)
                behind[f"{topic}/{partition}"] = offset - done
    return behind


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keyed state of a stopped query as ``key, value`` rows (OP13)."""
    return (spark.read.format("statestore").option("operatorId", operator)
            .load(checkpoint).select("key", "value"))


def counted(df: DataFrame, name: str, *counters) -> DataFrame:
    """Attach live counters to a stream; they appear in the query's progress
    under ``name`` (AGG4)."""
    return df.observe(name, *counters)
