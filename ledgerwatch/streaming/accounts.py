"""The account table kept up to date from its changelog (SRC3, AGG3).

Each micro-batch folds its changes into the previous version of the table and
writes the result as the next version. Readers take the newest complete one, so
the rules look accounts up without reading the changelog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.reference import latest_per_key
from ..schemas import ACCOUNT_AVRO
from ..sources import codecs
from . import runner

KEEP_VERSIONS = 3
#: Seconds for which readers may still use a version after the next was written.
KEEP_SECONDS = 6 * 3600


def read_changes(records: DataFrame, fmt: str = "confluent_avro",
                 schema=ACCOUNT_AVRO, since: str | None = None) -> DataFrame:
    """Records of the account topic as changes. A record without a value deletes
    the account of its key; one whose value cannot be read is left out. ``since`` names
    the record's column, such as ``timestamp``, to keep as the time of the change."""
    decoded = codecs.decode_events(records, fmt, schema)
    return (decoded.filter(F.col("decoded") | F.col("value").isNull())
            .select(F.coalesce("accountId", F.col("key").cast("string"))
                    .alias("account_id"),
                    F.col("accountNumber").alias("account_number"),
                    F.col("ownerName").alias("owner_name"), "tier", "status",
                    "offset", *([F.col(since).alias("since")] if since else [])))


def start_account_table(changes: DataFrame, folder: str, checkpoint: str,
                        key: str = "account_id",
                        order_by: str | list[str] = "offset",
                        keep: int = KEEP_VERSIONS, keep_seconds: float = KEEP_SECONDS,
                        every: str | None = "1 minute") -> StreamingQuery:
    """Fold ``changes`` into versions of the table under ``folder``.

    A change whose other columns are all null deletes its key. The deletion stays
    in the table as a row, so that an older change arriving later does not revive
    it; ``current_accounts`` leaves it out. The ``keep`` newest versions remain, and any
    replaced less than ``keep_seconds`` ago, which no micro-batch of a reader outlives.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in runner.versions(spark, folder) if v < batch_id]
        rows = batch
        if before:
            rows = runner.read_batch(spark, folder, before[-1]).unionByName(batch)
        runner.write_batch(latest_per_key(rows, key, order_by), folder, batch_id)
        runner.remove_before(spark, folder, batch_id - keep + 1, keep_seconds)

    return runner.run_stream(changes, handle, checkpoint, every=every)


def current_accounts(spark: SparkSession, folder: str, key: str = "account_id",
                     order_by: str | list[str] = "offset") -> DataFrame:
    """Newest version of the table, one row per live account."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    table = runner.read_batch(spark, folder, runner.versions(spark, folder)[-1])
    values = [F.col(c) for c in table.columns if c != key and c not in order]
    return table.filter(F.coalesce(*values).isNotNull()).drop(*order)


def start_version_log(changes: DataFrame, folder: str, checkpoint: str,
                      every: str | None = "1 minute") -> StreamingQuery:
    """Keep every change, which rules need that look up what was current at a time. A
    micro-batch writes its own changes and nothing else."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        runner.write_batch(batch, folder, batch_id)

    return runner.run_stream(changes, handle, checkpoint, every=every)


def account_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All changes of a version log; deletions are rows whose values are null."""
    found = runner.read_batches(spark, folder, runner.versions(spark, folder))
    if found is None:
        raise ValueError(f"{folder} has no changes yet")
    return found.drop(runner.BATCH)
